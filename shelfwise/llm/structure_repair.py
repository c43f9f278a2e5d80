"""Cheapest repair of the order of roles in conversations."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.support import Scratch
from shelfwise.operators.ranks import running_totals

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3  # costs
SPACES = " \t\n\x0b\x0c\r"
LETTERS = "-DIKR"  # of edits, in ASCII order; the first stands for the end
BLOCK = 1 << 15  # rows that are ranked together, unless one conversation is longer

# Nodes of a conversation of n rows: for each place between rows (0 to n) what the roles so far
# read: nothing, a system turn, up to a user turn, up to an assistant turn.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
# A user turn follows all but a user turn, an assistant turn follows that; a system turn stands first.
NEXT = np.array([USER, USER, ASSISTANT, USER])


@dataclass
class Repair:
    """``conversations``: id, gaps, blank, duplicate, truncated, illegal, cost, audit, one row for each with rows;
    ``rows``: id, place, role, text of the repaired conversations."""

    conversations: DataFrame
    rows: DataFrame


def damaged(turns: DataFrame, id_col: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Rows (id, turn, role, text) damaged by crc32 of ``id:turn`` modulo 20.

    0 drops the row, 1 empties its text, 2 removes its ``. ! ?``, 3 repeats it, 4 makes it a
    user's. Nulls are one space, in the hash as well.
    """
    space = F.lit(" ")
    name = [F.coalesce(F.col(c).cast("string"), space) for c in (id_col, turn)]
    fate = F.crc32(F.concat(name[0], F.lit(":"), name[1]).cast("binary")) % 20
    rows = turns.select(id_col, turn, *[F.coalesce(F.col(c), space).alias(c) for c in ("role", "text")], fate.alias("_fate"))
    text = F.when(F.col("_fate") == 1, "").when(F.col("_fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_fate") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("_fate") == 3, 2).otherwise(1)))
    left = rows.where("_fate <> 0").select(id_col, turn, role.alias("role"), text.alias("text"), times.alias("_copy"))
    return left.drop("_copy")


def _costs(kind: np.ndarray, initial: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Least cost from each node to the end; conversation c has the rows first[c] to first[c + 1] - 1.

    ``kind`` of a row: 0 sound, 1 truncated, 2 to delete. ``initial`` of its role: 0 s, 1 u, 2 a, 3 other.
    Conversations advance together, from their last rows on.
    """
    counts = np.diff(first)
    layers = first[1:] + np.arange(len(counts))  # the last layer of each conversation
    cost = np.zeros((first[-1] + len(counts), 4), np.int64)
    cost[layers] = [0, 2 * INSERT, INSERT, 0]
    by_length = np.argsort(-counts, kind="stable")
    for back in range(1, int(counts.max(initial=0)) + 1):
        live = by_length[: np.searchsorted(-counts[by_length], -back, "right")]
        row, then = first[live + 1] - back, cost[layers[live] - back + 1]
        way = np.where(kind[row, None] < 2, _arcs(then, kind[row], initial[row]).min(axis=0), DELETE + then)
        user, assistant = way[:, USER].copy(), way[:, ASSISTANT].copy()
        way[:, USER] = np.minimum(user, INSERT + assistant)
        way[:, ASSISTANT] = np.minimum(assistant, INSERT + user)
        way[:, :USER] = np.minimum(way[:, :USER], INSERT + way[:, USER, None])
        cost[layers[live] - back] = way
    return cost


def _kept_to(initial: np.ndarray) -> np.ndarray:
    """Where each row, kept as it is, leads from each node; -1 where it must not be kept."""
    to = np.full((len(initial), 4), -1)
    to[initial == 0, NOTHING] = SYSTEM
    for state in (NOTHING, SYSTEM, ASSISTANT):
        to[initial == 1, state] = USER
    to[initial == 2, USER] = ASSISTANT
    return to


def _arcs(then: np.ndarray, kind: np.ndarray, initial: np.ndarray) -> np.ndarray:
    """Costs by way of deleting, keeping and reroling a row, from the costs behind it."""
    many = np.iinfo(np.int64).max // 4
    more, to = (kind == 1)[:, None] * TRUNCATED, _kept_to(initial)
    kept = np.where(to >= 0, KEEP + more + np.take_along_axis(then, np.maximum(to, 0), 1), many)
    return np.stack([DELETE + then, kept, REROLE + more + then[:, NEXT]])


def _optimal_arcs(cost: np.ndarray, kind: np.ndarray, initial: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(there, target): for each node and letter whether that edit lies on a cheapest path, and where it leads.

    No node has two arcs of one letter: its state says which role an insertion or rerole gives.
    """
    convs = np.repeat(np.arange(len(first) - 1), np.diff(first))
    layer = np.arange(len(kind)) + convs  # of the place before each row
    nodes = len(cost) * 4
    there, target = np.zeros((len(cost), 4, 5), bool), np.tile(np.arange(nodes).reshape(-1, 4, 1), (1, 1, 5))
    here, then = cost[layer], cost[layer + 1]
    ways, to = _arcs(then, kind, initial), _kept_to(initial)
    usable = (kind < 2)[:, None]
    there[layer, :, 1] = ways[0] == here
    there[layer, :, 3] = (ways[1] == here) & usable
    there[layer, :, 4] = (ways[2] == here) & usable
    behind = ((layer + 1) * 4)[:, None]
    target[layer, :, 1] = behind + np.arange(4)
    target[layer, :, 3] = behind + np.maximum(to, 0)
    target[layer, :, 4] = behind + NEXT
    there[:, :, 2] = cost == INSERT + cost[:, NEXT]
    target[:, :, 2] = (np.arange(len(cost)) * 4)[:, None] + NEXT
    ends = first[1:] + np.arange(len(first) - 1)
    there[ends, :, 0] = cost[ends] == 0
    there[ends, :, 2] &= cost[ends] > 0
    return there.reshape(nodes, 5), target.reshape(nodes, 5)


def _least_paths(there: np.ndarray, target: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nodes, letters, lengths): the ASCII-least path of each start, one after the other.

    Prefix doubling: nodes are ranked by the first letter of their least path, then by the
    first 2, 4, 8, … letters, each rank from the ranks of the node and of the node which that
    many letters lead to; an ended path comes before one that goes on. Ranks choose each
    node's arc, and the doubled pointers list all nodes of a path at once, by the bits of
    their place in it.
    """
    letter = there.argmax(axis=1)
    nodes = np.arange(len(letter))
    to = target[nodes, letter].astype(np.int32)
    rank, steps, pointers = letter.astype(np.int64), (letter > 0).astype(np.int64), [to]
    while (letter[pointers[-1]] > 0).any():
        far = pointers[-1]
        rank = np.unique(rank * (len(rank) + 5) + rank[far], return_inverse=True)[1]
        steps = steps + steps[far]
        pointers.append(far[far])
    key = np.where(there, np.arange(5) * (len(rank) + 5) + rank[target], np.iinfo(np.int64).max)
    if not (key.argmin(axis=1) == letter).all():
        raise AssertionError("two arcs of one letter")
    lengths = steps[starts]
    ends = np.cumsum(lengths)
    place = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)
    node = np.repeat(starts, lengths)
    for k, far in enumerate(pointers):
        node = np.where(place >> k & 1, far[node], node)
    return node, letter[node], lengths


_EDITS = "cost long, illegal long, audit string, edits array<struct<at:int,letter:string,role:string>>"


def _repaired(kind: np.ndarray, initial: np.ndarray, first: np.ndarray) -> tuple[list, list, list, pa.Array]:
    """(costs, illegal neighbours, audits, edits) of conversations."""
    cost = _costs(kind, initial, first)
    there, target = _optimal_arcs(cost, kind, initial, first)
    starts = (first[:-1] + np.arange(len(first) - 1)) * 4
    node, letter, lengths = _least_paths(there, target, starts)
    fine = np.isin(initial[:-1] * 4 + initial[1:], [0 * 4 + 1, 1 * 4 + 2, 2 * 4 + 1])
    wrong = np.append(0, np.cumsum(np.append(~fine, False)))
    illegal = np.where(np.diff(first) > 1, wrong[np.maximum(first[1:] - 1, 0)] - wrong[first[:-1]], 0)
    ends = np.append(0, np.cumsum(lengths))
    text = np.frombuffer(LETTERS.encode(), np.uint8)[letter].tobytes().decode()
    audits = [text[a:b] for a, b in zip(ends[:-1], ends[1:])]
    role = np.where(np.isin(letter, [2, 4]), np.where(NEXT[node % 4] == USER, 0, 1), 2)
    at = node // 4 - np.repeat(first[:-1] + np.arange(len(first) - 1), lengths) + 1
    names = pa.array(["user", "assistant", None]).take(pa.array(role))
    marks = pa.array(list(LETTERS)).take(pa.array(letter))
    edits = pa.StructArray.from_arrays([pa.array(at, pa.int32()), marks, names], ["at", "letter", "role"])
    return cost.reshape(-1)[starts].tolist(), illegal.tolist(), audits, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), edits)


def _repairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from its rows (id, place, kind, initial), which come in order."""
    ids, first, kinds, initials, held, kind_of = [], [], [], [], 0, None

    def flush() -> pa.RecordBatch:
        kind, initial = np.concatenate(kinds), np.concatenate(initials)
        costs, illegal, audits, edits = _repaired(kind, initial, np.array([*first, len(kind)]))
        columns = [pa.array(ids, kind_of), pa.array(costs, pa.int64()), pa.array(illegal, pa.int64()), pa.array(audits, pa.string()), edits]
        return pa.RecordBatch.from_arrays(columns, ["id", "cost", "illegal", "audit", "edits"])

    for batch in batches:
        kind_of, column = batch.column(0).type, batch.column(0).to_pylist()
        edges = [k for k in range(len(column)) if (k == 0 and (not ids or column[0] != ids[-1])) or (k and column[k] != column[k - 1])]
        kind, initial = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (2, 3))
        low = 0
        for k in [*edges, len(column)]:
            kinds.append(kind[low:k]), initials.append(initial[low:k])
            held, low = held + k - low, k
            if k == len(column):
                break
            if held >= BLOCK:
                yield flush()
                ids, first, kinds, initials, held = [], [], [], [], 0
            ids.append(column[k]), first.append(held)
    if ids:
        yield flush()


def repair_structure(turns: DataFrame, id_col: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repair:
    """Faults of each conversation, its cheapest repair and the repaired rows.

    Rows go by turn, null first; rows of one turn by a hash of role and text, so that copies
    are neighbours. A row's first fault counts: ``blank`` (white space only), ``duplicate``
    (role and text seen earlier), ``truncated`` (does not end with ``. ! ?``). ``illegal``
    counts neighbours whose role initials are not su, ua or au, ``gaps`` the turn numbers
    missing between the smallest and the largest.

    Keep is free, rerole to user or assistant costs 3, delete 4 (a must for blank and duplicate
    rows), inserting an empty user or assistant turn 3; a truncated row that stays costs 3 more.
    The initials left must read ``(s?(ua)+)?``. Of the cheapest edits ``audit`` has the initials
    (K R D I) that come first in ASCII order.

    1. Places in a conversation come from running totals over range partitions, and
       duplicates from the first place of each text, so a conversation with a third of
       all rows is spread as any other.
    2. Of a row two small numbers go on. Tasks get whole conversations of these, many at
       a time: the cost to the end of each node (``_costs``), then the least of the cheapest
       paths by prefix doubling (``_least_paths``). A conversation of a million turns takes some
       0.5 GB there; its texts are not there.
    3. The edits go back to the rows by id and place.

    Nulls in role or text count as empty; a null id is a conversation of its own. Empty
    table: no rows. Other columns are not read. A conversation whose rows are all deleted
    has an audit of D only and no repaired rows.
    """
    scratch = Scratch(turns.sparkSession, "repair")
    clean = [F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((role, "role"), (text, "text"))]
    rows = turns.select(F.col(id_col).alias("id"), F.col(turn).alias("turn"), *clean)
    key = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    order = F.struct(F.col("turn").isNotNull().alias("t"), F.col("turn").alias("n"), key.alias("key"), F.monotonically_increasing_id().alias("r"))
    keyed = rows.select("*", order.alias("_at"), F.lit(1).cast("long").alias("_one"))
    ended = F.rtrim("text", F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    placed = running_totals(keyed, ["id"], "_at", ["_one"]).select(
        "id", "turn", "role", "text", F.col("_at.key").alias("key"), F.col("cum__one").alias("place"), code.cast("byte").alias("initial"),
        (ended == "").alias("blank"), (~F.substring(ended, -1, 1).isin(".", "!", "?")).alias("open"),
    )
    placed = scratch.keep(placed, "placed")
    lean = placed.where(~F.col("blank")).select("id", "key", "place")
    seen = scratch.keep(lean.groupBy("id", "key").agg(F.min("place").alias("earliest")), "seen")
    same = F.col("p.id").eqNullSafe(F.col("s.id")) & (F.col("p.key") == F.col("s.key"))
    told = placed.select("id", "turn", "key", "place", "initial", "blank", "open").alias("p").join(seen.alias("s"), same, "left")
    again = ~F.col("blank") & (F.col("place") > F.col("earliest"))
    fault = F.when(F.col("blank"), 1).when(again, 2).when(F.col("open"), 3).otherwise(0)
    told = scratch.keep(told.select("p.id", "turn", "place", "initial", fault.cast("byte").alias("fault")), "told")

    counted = [F.sum((F.col("fault") == k).cast("long")).alias(n) for k, n in ((1, "blank"), (2, "duplicate"), (3, "truncated"))]
    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    faults = told.groupBy("id").agg(F.coalesce(span, F.lit(0)).cast("long").alias("gaps"), *counted)

    kind = F.when(F.col("fault") == 3, 1).when(F.col("fault") > 0, 2).otherwise(0).cast("byte")
    tasks = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = told.select("id", "place", kind.alias("kind"), "initial").repartition(tasks, "id").sortWithinPartitions("id", "place")
    schema = f"id {rows.schema['id'].dataType.simpleString()}, {_EDITS}"
    repairs = scratch.keep(dealt.mapInArrow(_repairs, schema), "repairs")

    same = F.col("f.id").eqNullSafe(F.col("r.id"))
    joined = faults.alias("f").join(repairs.alias("r"), same)
    columns = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    conversations = scratch.keep(joined.select(F.col("f.id").alias(id_col), *columns), "conversations")

    edits = repairs.select(F.col("id").alias("e_id"), F.posexplode("edits").alias("nth", "edit")).select("e_id", "nth", "edit.at", "edit.letter", F.col("edit.role").alias("new"))
    edits = scratch.keep(edits.where("letter <> 'D'"), "edits")
    stay = edits.where("letter <> 'I'").join(placed, F.col("e_id").eqNullSafe(F.col("id")) & (F.col("at") == F.col("place")))
    stay = stay.select("e_id", "nth", F.coalesce("new", "role").alias("role"), "text")
    added = edits.where("letter = 'I'").select("e_id", "nth", F.col("new").alias("role"), F.lit("").alias("text"))
    repaired = stay.unionByName(added).select(F.col("e_id").alias(id_col), F.col("nth").alias("place"), "role", "text")
    scratch.drop("seen", "told", "repairs")
    return Repair(conversations, repaired)


def _line_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of ``role:text`` lines of each conversation, whose rows come in order."""
    ids, digests, digest, kind_of, now = [], [], None, None, None
    for batch in batches:
        kind_of = batch.column(0).type
        for id_, _, role, text in zip(*[c.to_pylist() for c in batch.columns]):
            if digest is None or id_ != now:
                if digest is not None:
                    ids.append(now), digests.append(digest.hexdigest())
                now, digest = id_, hashlib.sha256(f"{role}:{text}".encode())
            else:
                digest.update(f"\n{role}:{text}".encode())
        if len(ids) > 4096:
            yield pa.RecordBatch.from_arrays([pa.array(ids, kind_of), pa.array(digests)], ["id", "repaired_sha256"])
            ids, digests = [], []
    if digest is not None:
        ids.append(now), digests.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([pa.array(ids, kind_of), pa.array(digests)], ["id", "repaired_sha256"])


def repaired_digests(rows: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(id, repaired_sha256) of repaired rows. SHA-256 goes byte after byte, so the rows of a
    conversation pass one task, as a stream of which it holds one batch."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select(id_col, "place", "role", "text").repartition(tasks, id_col).sortWithinPartitions(id_col, "place")
    return dealt.mapInArrow(_line_digests, f"id {rows.schema[id_col].dataType.simpleString()}, repaired_sha256 string")
