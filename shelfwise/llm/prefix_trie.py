"""Prefix trie of conversations, grown in batches as a z-fast trie."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.llm.support import Scratch

MARK = 16  # bytes of the digest that stands for a prefix
ROOT = b""  # path of the root, which no conversation with turns has


@dataclass
class Trie:
    """``nodes``: path, depth, conv_id, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, turn_key;
    ``ends``: conv_id, path, depth of the node where each conversation ends."""

    nodes: DataFrame
    ends: DataFrame


def turn_sequences(turns: DataFrame, id_col: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: ``id_col``, turns (key, size) in order.

    ``key`` is the SHA-256 of role and text, ``size`` the text's code points; null roles and
    texts count as empty. Order: turn, null first, then key. Rows without an id belong to no
    conversation. A conversation is one value of 36 bytes a turn; its texts stay behind.
    """
    who, what = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    key = F.unhex(F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, what), 256))
    place = F.struct(F.col(turn).isNotNull().alias("a"), F.col(turn).alias("b"), key.alias("key"), F.length(what).alias("size"))
    listed = turns.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.array_sort(F.collect_list(place)).alias("_t"))
    return listed.select(id_col, F.transform("_t", lambda t: F.struct(t["key"].alias("key"), t["size"].alias("size"))).alias("turns"))


def spliced(sequences: DataFrame, id_col: str = "conv_id", group: int = 100, most: int = 6) -> DataFrame:
    """Sequences whose first h turns are those of the first conversation of their hundred.

    h is crc32 of the id as text, modulo ``most``; the conversation keeps its own turns after its
    first h. Where the hundred's first conversation is missing, nothing stands before them.
    """
    heads = sequences.select(F.col(id_col).alias("_first"), F.slice("turns", 1, most - 1).alias("_head"))
    h = (F.crc32(F.col(id_col).cast("string").cast("binary")) % most).cast("int")
    first = F.col(id_col) - F.col(id_col) % group
    none = F.array().cast(sequences.schema["turns"].dataType)
    own = F.slice("turns", h + 1, F.size("turns"))
    joined = sequences.withColumn("_first", first).join(heads, "_first", "left")
    return joined.select(id_col, F.concat(F.slice(F.coalesce("_head", none), F.lit(1), h), own).alias("turns"))


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds a digest of every prefix (chained, ``MARK`` bytes each), keys and running sizes."""
    for batch in batches:
        out: list[list] = [[], [], [], [], []]
        for turns in batch.column(1).to_pylist():
            mark, marks, total, sizes = b"", bytearray(), 0, []
            for t in turns:
                mark = hashlib.blake2b(mark + t["key"], digest_size=MARK).digest()
                marks += mark
                total += t["size"]
                sizes.append(total)
            for column, value in zip(out, (len(turns), mark, bytes(marks), b"".join(t["key"] for t in turns), sizes)):
                column.append(value)
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
        columns = [batch.column(0), *[pa.array(c, k) for c, k in zip(out, kinds)]]
        yield pa.RecordBatch.from_arrays(columns, ["id", "len", "path", "marks", "keys", "sizes"])


def _mark(marks: Column | str, depth: Column) -> Column:
    """The digest of the first ``depth`` turns."""
    return F.substring(marks, (depth - 1) * MARK + 1, F.lit(MARK))


def _fattest(a: Column, b: Column) -> Column:
    """The number in (a, b] that the largest power of two divides."""
    zeros = F.length(F.bin(a.bitwiseXOR(b).cast("long"))) - 1
    return F.call_function("shiftleft", F.call_function("shiftright", b, zeros), zeros)


def _named(edges: DataFrame) -> DataFrame:
    """Nodes (host, turn_from, lo, hi, edge) with the digest of handle, extent and first turn.

    The edge holds the digests of depths lo + 1 to hi of the path ``host`` that brought it in.
    """
    handle = _mark("edge", _fattest(F.col("lo"), F.col("hi")) - F.col("lo"))
    named = {"handle": handle, "extent": _mark("edge", F.col("hi") - F.col("lo")), "first": _mark("edge", F.lit(1))}
    return edges.withColumns(named)


def _meet(rows: DataFrame, nodes: DataFrame, key: Column, on: str) -> DataFrame:
    """Rows beside the node that their key names, if any; ``same`` says how many turns of its edge they share."""
    there = nodes.select(F.col(on).alias("_key"), *[F.col(c).alias(f"n_{c}") for c in ("host", "born", "lo", "hi", "edge", "extent")])
    met = rows.withColumn("_key", key).join(there, "_key", "left")
    shared = F.filter(
        F.sequence(F.lit(1), F.least("n_hi", "len") - F.col("n_lo")),
        lambda i: _mark("n_edge", i) == _mark("marks", F.col("n_lo") + i),
    )
    return met.withColumn("same", F.when(F.col("n_hi").isNotNull(), F.size(shared))).drop("_key", "n_edge")


def _locate(rows: DataFrame, nodes: DataFrame, steps: int) -> DataFrame:
    """Where each path leaves the trie: depth ``l`` on the edge (lo, hi] of ``host``.

    ``rows`` has path, len, marks and a, host, born: a node that the path is known to pass.
    Fat binary search: the 2-fattest depth of the open interval names the handle of a node, if
    there is one. A path that passes all of that node goes on below it; one that does not
    leaves on its edge; without such a node the interval ends before that depth. At the end
    the edge that begins with the path's next turn is the one that it leaves, if there is one.
    Every step is a join with the handles; a settled row carries a key that nothing has.
    """
    no_key = F.concat(F.col("path"), F.lit(b"-"))
    at = rows.withColumns({"b": F.col("len"), "l": F.lit(None).cast("int"), "lo": F.lit(None).cast("int"), "hi": F.lit(None).cast("int")})
    keep = ["path", "len", "marks", "a", "b", "host", "born", "l", "lo", "hi"]
    for _ in range(steps):
        seeks = F.col("l").isNull() & (F.col("a") < F.col("b"))
        depth = _fattest(F.col("a"), F.col("b"))
        met = _meet(at, nodes, F.when(seeks, _mark("marks", depth)).otherwise(no_key), "handle")
        met = met.withColumn("f", F.when(seeks, depth))
        found = F.col("same").isNotNull()
        through = found & (F.col("same") == F.col("n_hi") - F.col("n_lo"))
        leaves = found & ~through
        at = met.select(
            "path", "len", "marks",
            F.when(through, F.col("n_hi")).otherwise(F.col("a")).alias("a"),
            F.when(seeks & ~found, F.col("f") - 1).otherwise(F.col("b")).alias("b"),
            F.when(found, F.col("n_host")).otherwise(F.col("host")).alias("host"),
            F.when(found, F.col("n_born")).otherwise(F.col("born")).alias("born"),
            F.when(leaves, F.col("n_lo") + F.col("same")).otherwise(F.col("l")).alias("l"),
            F.when(leaves, F.col("n_lo")).otherwise(F.col("lo")).alias("lo"),
            F.when(leaves, F.col("n_hi")).otherwise(F.col("hi")).alias("hi"),
        ).select(*keep)
    seeks = F.col("l").isNull() & (F.col("a") < F.col("len"))
    met = _meet(at, nodes, F.when(seeks, _mark("marks", F.col("a") + 1)).otherwise(no_key), "first")
    found = F.col("same").isNotNull()
    return met.select(
        "path", "len", "marks",
        F.when(found, F.col("n_host")).otherwise(F.col("host")).alias("host"),
        F.when(found, F.col("n_born")).otherwise(F.col("born")).alias("born"),
        F.coalesce("l", F.col("n_lo") + F.col("same"), "a").alias("l"),
        F.coalesce("lo", "n_lo").alias("lo"),
        F.coalesce("hi", "n_hi").alias("hi"),
    )


def _grow(paths: DataFrame, scratch: Scratch) -> tuple[list[str], list[DataFrame]]:
    """Insert all paths; the batches inserted, each (path, host, born, l, own), and their names.

    Of all paths that leave the trie at one place with one next turn, a batch inserts one,
    chosen by a hash of the batch: it brings a node for what is left of it. Paths that end
    where they leave need none. The edges left are split. The others search on from there.
    With a hashed choice the paths below any place are about halved by each batch, so the
    number of batches grows with the logarithm of the number of paths.
    """
    rows = paths.select("path", "len", "marks", F.lit(0).alias("a"), F.lit(ROOT).alias("host"), F.lit(0).alias("born"))
    active, nodes, batches, names = rows, None, [], []
    while (longest := active.agg(F.max("len")).first()[0]) is not None:
        k = len(batches) + 1
        if nodes is None:
            none = F.lit(None).cast("int")
            placed = active.select("path", "len", "marks", "host", "born", F.col("a").alias("l"), none.alias("lo"), none.alias("hi"))
        else:
            placed = scratch.keep(_locate(active, nodes, longest.bit_length()), f"placed-{k}")
        own = F.col("l") < F.col("len")
        turn = F.when(own, _mark("marks", F.col("l") + 1))
        pick = F.min(F.struct(F.xxhash64("path", F.lit(k)).alias("h"), F.col("path")))["path"].alias("path")
        leaders = placed.where(own).groupBy(turn.alias("turn")).agg(pick)
        chosen = placed.where(own).join(leaders.select("path"), "path", "left_semi")
        batch = chosen.unionByName(placed.where(~own)).select("path", "host", "born", "l", own.alias("own"))
        batches.append(scratch.keep(batch, f"batch-{k}"))
        names.append(f"batch-{k}")

        edge = F.substring("marks", F.col("l") * MARK + 1, (F.col("len") - F.col("l")) * MARK)
        inserted = batches[-1].where("own").select("path", "l")
        fresh = placed.select("path", "len", "marks").join(inserted, "path").select(
            F.col("path").alias("host"), F.lit(k).alias("born"), F.col("l").alias("lo"), F.col("len").alias("hi"), edge.alias("edge")
        )
        if nodes is not None:
            inside = placed.where((F.col("lo") < F.col("l")) & (F.col("l") < F.col("hi")))
            cuts = inside.groupBy("host", "lo").agg(F.array_sort(F.collect_set("l")).alias("cuts"))
            ends = F.concat(F.array("lo"), F.coalesce("cuts", F.array().cast("array<int>")), F.array("hi"))
            split = nodes.select("host", "born", "lo", "hi", "edge").join(cuts, ["host", "lo"], "left")
            split = split.select("host", "born", "lo", "edge", ends.alias("ends")).select(
                "host", "born", "edge", F.col("lo").alias("_lo"), "ends", F.posexplode(F.slice("ends", F.lit(2), F.size("ends") - 1)).alias("_i", "hi")
            )
            low = F.get("ends", F.col("_i"))
            part = F.substring("edge", (low - F.col("_lo")) * MARK + 1, (F.col("hi") - low) * MARK)
            fresh = fresh.unionByName(split.select("host", "born", low.alias("lo"), "hi", part.alias("edge")))
        nodes = scratch.keep(_named(fresh), f"nodes-{k}")
        rest = placed.join(batches[-1].select("path"), "path", "left_anti")
        waiting = rest.select("path", "len", "marks", F.col("l").alias("a"), "host", "born")
        active = scratch.keep(waiting, f"active-{k}")
        old = [f"{n}-{k - 1}" for n in ("nodes", "active")] + [f"placed-{k}"]
        scratch.drop(*[n for n in old if n in scratch.paths])
    return names, batches


_SUMS = ("convs", "tokens", "fresh", "leaves")


def conversation_trie(sequences: DataFrame, id_col: str = "conv_id") -> Trie:
    """All prefixes of the sequences (``turn_sequences``) as a trie, and where each sequence ends.

    1. Equal sequences become one path, counted before they are shuffled. Every prefix has a
       chained 128-bit digest; digests stand for prefixes from here on.
    2. ``_grow`` inserts the paths batch by batch into a z-fast trie: compacted nodes, a table
       keyed by the digest at the two-fattest depth of each node's edge, searched by joins.
    3. Each path hangs on the one whose edge it left. Members, tokens, tokens of nodes
       that it brought and leaves are summed from the last batch to the first, one row for each
       place where something hangs, so a place with any number of paths is pre-aggregated.
    4. Edges are expanded into one row per depth, sums accumulating from a path's end upwards.

    Nodes: ``conv_id`` smallest member, ``depth``, ``parent_conv_id`` (root: null),
    ``n_convs`` members, ``n_children``, ``n_leaves`` (childless nodes of the subtree),
    ``saved_tokens`` (code points of repeats: every node of the subtree counts its last text for
    all members but one), ``turn_key`` (hash of the last role and text, null at the root).
    Sequences without turns belong to the root. No sequences: no nodes. A repeated
    id is two conversations.

    The table of paths is written once; a sequence is one row of some 60 bytes a turn. Each
    batch writes the trie as it stands. Only the longest remaining length comes to the driver.
    """
    scratch = Scratch(sequences.sparkSession, "trie")
    kinds = f"id {sequences.schema[id_col].dataType.simpleString()}, len int, path binary, marks binary, keys binary, sizes array<bigint>"
    marked = scratch.keep(sequences.select(id_col, "turns").mapInArrow(_marks, kinds), "marked")
    grouped = marked.where("len > 0").groupBy("path", "len")
    shape = [F.any_value(c).alias(c) for c in ("marks", "keys", "sizes")]
    paths = scratch.keep(grouped.agg(F.count("*").alias("n"), F.min("id").alias("m"), *shape), "paths")
    names, batches = _grow(paths, scratch)

    # what hangs on each path, from the last batch to the first
    def size_at(depth: Column) -> Column:
        return F.when(depth > 0, F.get("sizes", depth - 1)).otherwise(F.lit(0)).cast("long")

    plain = paths.select("path", "len", "n", "m", "sizes")
    hung: list[DataFrame] = []
    for k in range(len(batches), 0, -1):
        rows = batches[k - 1].join(plain, "path")
        rows = rows.select("path", "host", F.col("born").alias("host_born"), "l", "own", "len", "n", "m", size_at(F.col("len")).alias("full"), size_at(F.col("l")).alias("part"))
        below = [h.where(F.col("host_born") == k) for h in hung]
        if below:
            under = reduce(DataFrame.unionByName, below).groupBy(F.col("host").alias("path")).agg(
                *[F.sum(c).alias(f"u_{c}") for c in _SUMS], F.min("least").alias("u_least"), F.max("l").alias("u_l")
            )
            rows = rows.join(under, "path", "left")
        else:
            zero, none = F.lit(0).cast("long"), F.lit(None)
            rows = rows.withColumns({**{f"u_{c}": zero for c in _SUMS}, "u_least": none.cast(marked.schema["id"].dataType), "u_l": none.cast("int")})
        childless = F.col("own") & (F.coalesce("u_l", F.lit(-1)) < F.col("len"))
        extra = {c: F.coalesce(f"u_{c}", F.lit(0)) for c in _SUMS}
        total = rows.select(
            "host", "host_born", "l", "own",
            (F.col("n") + extra["convs"]).alias("convs"),
            (F.col("n") * F.col("full") + extra["tokens"]).alias("tokens"),
            (F.col("full") - F.col("part") + extra["fresh"]).alias("fresh"),
            (childless.cast("long") + extra["leaves"]).alias("leaves"),
            F.least("m", "u_least").alias("least"),
        )
        sums = total.groupBy("host", "host_born", "l").agg(
            *[F.sum(c).alias(c) for c in _SUMS], F.min("least").alias("least"), F.sum(F.col("own").cast("long")).alias("kids")
        )
        hung.append(scratch.keep(sums, f"hung-{k}"))
    attached = reduce(DataFrame.unionByName, batches) if batches else None
    idle = marked.where("len = 0")
    if attached is None:
        at_root = idle.agg(F.count("*").alias("convs"), F.min("id").alias("least")).where("convs > 0")
        counts = {c: F.lit(0).cast("long") for c in ("tokens", "fresh", "kids")}
        at_root = at_root.withColumns({**counts, "leaves": F.lit(1).cast("long")})
    else:
        sums = reduce(DataFrame.unionByName, hung)
        none = {c: F.lit(0).cast("long") for c in ("tokens", "fresh", "leaves", "kids")}
        alone = idle.groupBy().agg(F.count("*").alias("convs"), F.min("id").alias("least")).withColumns(none)
        tops = sums.where(F.col("host") == F.lit(ROOT)).select("convs", "least", *none)
        at_root = tops.unionByName(alone).agg(*[F.sum(c).alias(c) for c in ("convs", *none)], F.min("least").alias("least"))
    no_parent = F.lit(None).cast(marked.schema["id"].dataType)
    root = at_root.select(
        F.lit(ROOT).alias("path"), F.lit(0).alias("depth"), F.col("least").alias("conv_id"), no_parent.alias("parent_conv_id"),
        F.col("convs").alias("n_convs"), F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"),
        (F.col("tokens") - F.col("fresh")).alias("saved_tokens"), F.lit(None).cast("binary").alias("turn_key"),
    )
    ends = marked.select(F.col("id").alias(id_col), "path", "len")
    if attached is None:
        return Trie(scratch.keep(root, "root"), ends.select(id_col, "path", F.col("len").alias("depth")))

    # edges, one row per depth; sums accumulate from the end of a path upwards
    own = attached.where("own").select("path", "host", "l").join(paths, "path")
    rows = own.select(
        "path", "host", F.col("l").alias("top"), "len", "n", "m", size_at(F.col("len")).alias("full"), "keys",
        F.posexplode(F.slice(F.concat(F.array(F.lit(0).cast("long")), "sizes"), F.col("l") + 1, F.col("len") - F.col("l"))).alias("_i", "before"),
    ).withColumn("depth", F.col("top") + F.col("_i") + 1)
    rows = rows.withColumn("turn_key", F.substring("keys", (F.col("depth") - 1) * 32 + 1, F.lit(32))).drop("keys", "_i")
    here = sums.select(F.col("host").alias("path"), F.col("l").alias("depth"), "kids", "least", *_SUMS)
    line = W.partitionBy("path").orderBy(F.col("depth").desc())
    upto = line.rowsBetween(W.unboundedPreceding, 0)
    summed = rows.join(here, ["path", "depth"], "left").select(
        *rows.columns,
        F.coalesce("kids", F.lit(0)).alias("kids"),
        F.max("kids").over(upto).alias("_any"),
        F.min("least").over(upto).alias("_least"),
        *[F.coalesce(F.sum(c).over(upto), F.lit(0)).alias(f"_{c}") for c in _SUMS],
        F.max(F.when(F.col("depth") == F.col("len"), F.coalesce("kids", F.lit(0)))).over(upto).alias("_end_kids"),
    )
    members, since = F.col("n") + F.col("_convs"), F.col("full") - F.col("before")
    valued = summed.select(
        "path", "depth", "host", "top", F.least("m", "_least").alias("conv_id"),
        members.alias("n_convs"),
        ((F.col("depth") < F.col("len")).cast("long") + F.col("kids")).alias("n_children"),
        ((F.col("_end_kids") == 0).cast("long") + F.col("_leaves")).alias("n_leaves"),
        (F.col("n") * F.col("full") + F.col("_tokens") - members * F.col("before") - since - F.col("_fresh")).alias("saved_tokens"),
        "turn_key",
    ).withColumn("_above", F.lead("conv_id").over(line))
    valued = scratch.keep(valued, "valued")
    root = scratch.keep(root, "root")
    parents = valued.select(F.col("path").alias("host"), F.col("depth").alias("top"), F.col("conv_id").alias("_parent"))
    parents = parents.unionByName(root.select(F.col("path").alias("host"), F.lit(0).alias("top"), F.col("conv_id").alias("_parent")))
    firsts = valued.where(F.col("depth") == F.col("top") + 1).join(parents, ["host", "top"]).withColumn("_above", F.col("_parent"))
    deeper = valued.where(F.col("depth") > F.col("top") + 1)
    columns = ["path", "depth", "conv_id", F.col("_above").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", "turn_key"]
    nodes = scratch.keep(deeper.select(*columns).unionByName(firsts.select(*columns)).unionByName(root), "nodes")

    inner = attached.where(~F.col("own")).select("path", F.col("host").alias("_host"), F.col("l").alias("_l"))
    ends = ends.join(inner, "path", "left").select(id_col, F.coalesce("_host", "path").alias("path"), F.coalesce("_l", "len").alias("depth"))
    ends = scratch.keep(ends, "ends")
    scratch.drop_all_but("nodes", "ends")
    return Trie(nodes, ends)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the parts of each node, which come one after the other in order."""
    current, digest, paths, depths, digests = None, None, [], [], []

    def close():
        if current is not None:
            paths.append(current[0]), depths.append(current[1]), digests.append(digest.hexdigest())

    for batch in batches:
        for path, depth, _, part in zip(*[c.to_pylist() for c in batch.columns]):
            if (path, depth) != current:
                close()
                current, digest = (path, depth), hashlib.sha256(part.encode())
            else:
                digest.update(b"," + part.encode())
    close()
    yield pa.RecordBatch.from_arrays([pa.array(paths, pa.binary()), pa.array(depths, pa.int32()), pa.array(digests, pa.string())], ["path", "depth", "ends_sha256"])


def end_digests(ends: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(path, depth, ends_sha256): SHA-256 of the ids that end at a node, ascending, comma-joined.

    Ids are sorted by range, so a node where a third of all conversations end is cut into many
    parts, each joined where it lies. One task then hashes the parts of a node as a stream, as
    SHA-256 goes byte after byte; it holds one part.
    """
    scratch = Scratch(ends.sparkSession, "ends")
    ranged = ends.repartitionByRange("path", "depth", id_col).withColumn("_slice", F.spark_partition_id())
    ranged = scratch.keep(ranged, "ranged")
    part = F.array_join(F.transform(F.array_sort(F.collect_list(id_col)), lambda x: x.cast("string")), ",")
    parts = ranged.groupBy("path", "depth", "_slice").agg(part.alias("part"))
    tasks = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = parts.repartition(tasks, "path", "depth").sortWithinPartitions("path", "depth", "_slice")
    return laid.mapInArrow(_hashed, "path binary, depth int, ends_sha256 string")
