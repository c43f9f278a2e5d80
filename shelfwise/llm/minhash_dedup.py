"""Near-duplicate documents by SetSketch registers, banding and exact checks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.components import components
from shelfwise.llm.support import Scratch, Words, least_reached, mix, pieces, row_key, runs_of, spans

SHINGLE = 5
PERCENT = 75  # similarity of a link, at least
ROWS, BANDS = 4, 40  # a pair at 0.75 misses all bands with probability 2.5e-7
BASE, RATE, LIMIT = 1.001, 20.0, 2**16 - 2  # of the registers
DOUBT = 12.0  # log-likelihood by which the estimate must beat 0.75 to rule a pair out
BLOCK = 512  # sketches on either side of one comparison step
SET_BLOCK = 256  # full sets on either side of one comparison step

_random = np.random.default_rng(9)
_XOR = _random.integers(0, 2**63, ROWS * BANDS, dtype=np.uint64)
_MUL = _random.integers(0, 2**63, ROWS * BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, and where each text's begin (one entry more)."""
    words = Words(data, offsets, lower=True)
    found = words.windows(size)
    fits = words.fits(size)
    hashes, doc = found[fits[: len(found)]], words.doc[: len(found)][fits[: len(found)]]
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    own = words.hash if len(short) else hashes
    for t in short:  # the whole sequence is one shingle
        a, b = words.first[t], words.first[t + 1]
        whole = np.array([b - a], np.uint64)
        for h in own[a:b]:
            whole = mix(whole * np.uint64(31) + h)
        at = np.searchsorted(doc, t)
        hashes, doc = np.insert(hashes, at, whole[0]), np.insert(doc, at, t)
    first = np.searchsorted(doc, np.arange(len(offsets)))
    for a, b in zip(first[:-1], first[1:]):
        hashes[a:b].sort()
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    return hashes[new], np.searchsorted(doc[new], np.arange(len(offsets)))


def registers(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """SetSketch registers (texts x registers) of non-empty sets.

    Register i is floor(1 - log_b(x)) of the least of exponential variates (rate
    ``RATE``) that a hash function gives to the elements, cut to [0, LIMIT + 1].
    Registers of a union are the larger ones of its parts.
    """
    least = np.empty((len(first) - 1, len(_MUL)), np.uint64)
    for i, (x, m) in enumerate(zip(_XOR, _MUL)):
        least[:, i] = np.minimum.reduceat((hashes ^ x) * m, first[:-1])
    variate = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
    return np.clip(np.floor(1 - np.log(variate) / np.log(BASE)), 0, LIMIT + 1).astype(np.uint16)


def band_values(sketch: np.ndarray) -> np.ndarray:
    """One 64-bit value for the registers of each band, the band's number included."""
    rows = sketch.reshape(len(sketch), BANDS, ROWS).astype(np.uint64)
    value = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), rows.shape[:2]).copy()
    for r in range(ROWS):
        value = mix((value << np.uint64(16)) + rows[:, :, r] + np.uint64(1))
    return value.view(np.int64)


def estimate(n_a: np.ndarray, n_b: np.ndarray, over: np.ndarray, under: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(similarity, whether ``PERCENT`` can't be ruled out) of pairs of sets.

    ``over``/``under`` count registers where a is larger/smaller. Given both set
    sizes, the joint likelihood of (over, under, equal) depends on the similarity
    alone. Its maximum solves a quadratic equation (exact for a base near 1). A
    pair is ruled out if that maximum beats the likelihood at ``PERCENT`` by more
    than ``DOUBT``, about five standard deviations, or if the sizes alone do.
    """
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    m, t, top = len(_MUL), PERCENT / 100.0, np.minimum(u / v, v / u)
    equal = m - over - under
    half = (equal * (u * u + v * v) + over * v * v + under * u * u) / (2 * m * u * v)
    best = np.clip(half - np.sqrt(np.maximum(half * half - equal / m, 0)), 0, top)

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def fit(j: np.ndarray) -> np.ndarray:
        up, down = p(u - v * j), p(v - u * j)
        tiny = 1e-12
        return over * np.log(np.maximum(up, tiny)) + under * np.log(np.maximum(down, tiny)) + equal * np.log(np.maximum(1 - up - down, tiny))

    possible = np.minimum(n_a, n_b) * 100 >= np.maximum(n_a, n_b) * PERCENT
    return best, possible & ((best >= t) | (fit(best) - fit(np.minimum(t, top)) <= DOUBT))


_PROFILE = "n_shingles long, set_a long, set_b long, sketch binary, bands array<long>"


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high, data, offsets in pieces(batch.column(batch.num_columns - 1)):
            hashes, first = shingle_sets(data, offsets)
            n = np.diff(first)
            full = np.flatnonzero(n)
            sets = np.zeros((2, len(n)), np.uint64)
            sketch, bands = [None] * len(n), [None] * len(n)
            if len(full):
                starts = first[:-1][full]
                sets[0, full] = np.add.reduceat(mix(hashes), starts)
                sets[1, full] = np.add.reduceat(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), starts)
                made = registers(hashes, np.append(starts, len(hashes)))
                values = band_values(made)
                for i, t in enumerate(full):
                    sketch[t], bands[t] = made[i].tobytes(), values[i]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(i).slice(low, high - low) for i in range(batch.num_columns - 1)],
                    pa.array(n, pa.int64()),
                    pa.array(sets[0].view(np.int64)),
                    pa.array(sets[1].view(np.int64)),
                    pa.array(sketch, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                names=[*batch.schema.names[:-1], "n_shingles", "set_a", "set_b", "sketch", "bands"],
            )


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, n_a, n_b, sketch_a, sketch_b) to the pairs (a, b) that estimates allow."""
    for batch in batches:
        for low in range(0, batch.num_rows, 2048):
            part = batch.slice(low, 2048)
            a, b = (_matrix(part.column(i), len(_MUL), np.uint16) for i in (4, 5))
            n_a, n_b = (part.column(i).to_numpy().astype(float) for i in (2, 3))
            _, ok = estimate(n_a, n_b, (a > b).sum(1), (a < b).sum(1))
            yield part.select([0, 1]).filter(pa.array(ok))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high, data, offsets in pieces(batch.column(1)):
            hashes, first = shingle_sets(data, offsets)
            packed = [hashes[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), pa.array(packed, pa.binary())], names=["node", "elements"])


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, elements_a, elements_b) to the pairs whose full sets are similar enough."""
    for batch in batches:
        ok = np.zeros(batch.num_rows, bool)
        for i in range(batch.num_rows):
            x, y = batch.column(2)[i].as_buffer(), batch.column(3)[i].as_buffer()
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = np.concatenate([x, y])
            both.sort()
            common = int((both[1:] == both[:-1]).sum())
            ok[i] = 100 * common >= PERCENT * (len(both) - common)
        yield batch.select([0, 1]).filter(pa.array(ok))


def _reached(node: np.ndarray, a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch:
    """Pairs of one block as few edges: each node that has any, with the least it reaches."""
    none = np.zeros(0, np.int64)
    x, y = np.concatenate([none, *a]), np.concatenate([none, *b])
    least = least_reached(x, y, len(node))
    some = np.flatnonzero(least != np.arange(len(node)))
    return pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(node[least[some]])], names=["a", "b"])


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks (block, side, node, comp, n_shingles, sketch) to edges between possible partners:
    a stray (side 0) and any other member (side 1) of another component."""
    for t in runs_of(batches):
        side, node, comp, n = (t.column(c).to_numpy() for c in ("side", "node", "comp", "n_shingles"))
        sketch = _matrix(t.column("sketch"), len(_MUL), np.uint16)
        stray, other = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        a, b = [], []
        for s in stray:
            those = other[comp[other] != comp[s]]
            if len(those):
                over, under = (sketch[s] > sketch[those]).sum(1), (sketch[s] < sketch[those]).sum(1)
                those = those[estimate(np.full(len(those), float(n[s])), n[those].astype(float), over, under)[1]]
                a.append(np.full(len(those), s))
                b.append(those)
        yield _reached(node, a, b)


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks (block, side, node, comp, elements) to edges between linked ones, full sets compared.

    Elements are numbered within the block; a stray's are marked in a table, and
    the marks of each other member are counted.
    """
    for t in runs_of(batches):
        side, node, comp = (t.column(c).to_numpy() for c in ("side", "node", "comp"))
        packed = t.column("elements").to_pylist()
        size = np.array([len(x) // 8 for x in packed])
        every, number = np.unique(np.frombuffer(b"".join(packed), np.uint64), return_inverse=True)
        first = np.append(0, np.cumsum(size))
        stray, other = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        begin = np.append(0, np.cumsum(size[other]))[:-1]
        theirs = number[spans(first[other], size[other])]
        mark = np.zeros(len(every), bool)
        a, b = [], []
        for s in stray if len(other) else ():
            own = number[first[s] : first[s + 1]]
            mark[own] = True
            common = np.add.reduceat(mark[theirs], begin, dtype=np.int64)
            mark[own] = False
            those = other[(100 * common >= PERCENT * (size[s] + size[other] - common)) & (comp[other] != comp[s])]
            a.append(np.full(len(those), s))
            b.append(those)
        yield _reached(node, a, b)


def _verified(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Those of the distinct ``pairs`` (a, b) that link: estimated first, then compared in full."""
    sketched = (
        pairs.join(nodes.select(F.col("node").alias("a"), F.col("n_shingles").alias("n_a"), F.col("sketch").alias("s_a")), "a")
        .join(nodes.select(F.col("node").alias("b"), F.col("n_shingles").alias("n_b"), F.col("sketch").alias("s_b")), "b")
        .select("a", "b", "n_a", "n_b", "s_a", "s_b")
    )
    open_ = scratch.keep(sketched.mapInArrow(_possible, "a long, b long"), f"{name}-possible")
    full = (
        open_.join(sets.select(F.col("node").alias("a"), F.col("elements").alias("e_a")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("elements").alias("e_b")), "b")
        .select("a", "b", "e_a", "e_b")
    )
    linked = scratch.keep(full.mapInArrow(_confirmed, "a long, b long"), f"{name}-linked")
    scratch.drop(f"{name}-possible")
    return linked


def _blocks(members: DataFrame, group: str, held: DataFrame, block: int, scratch: Scratch) -> DataFrame:
    """Blocks to compare of groups (``group``, node, comp) that consist of several components.

    Each stray (member outside its group's largest component) meets each member
    once; a block has about ``block`` of either. ``held`` is what else a node needs.
    """
    parts = members.groupBy(group, "comp").agg(F.count("*").alias("n"))
    sizes = F.max_by("comp", F.struct("n", "comp")).alias("largest"), F.sum("n").alias("n"), F.max("n").alias("most"), F.count("*").alias("parts")
    cuts = F.ceil(F.col("n") / block).cast("int").alias("others"), F.ceil((F.col("n") - F.col("most")) / block).cast("int").alias("strays")
    open_ = parts.groupBy(group).agg(*sizes).where("parts > 1").select(group, "largest", *cuts)
    open_ = scratch.keep(open_, f"{group}-open")  # so that both sides of the join are plain shuffles, which Spark splits
    salted = members.join(open_, group).withColumn("_salt", F.abs(F.xxhash64("node", group) % (1 << 30)).cast("int"))
    i, j = F.col("_salt") % F.col("strays"), F.col("_salt") % F.col("others")
    every_i, every_j = (F.explode(F.sequence(F.lit(0), F.col(c) - 1)) for c in ("strays", "others"))
    as_stray = salted.where("comp <> largest").select(group, "node", "comp", F.lit(0).alias("side"), i.alias("i"), every_j.alias("j"))
    as_other = salted.select(group, "node", "comp", F.lit(1).alias("side"), every_i.alias("i"), j.alias("j"))
    laid = as_stray.union(as_other).withColumn("block", F.xxhash64(group, "i", "j"))
    laid = laid.join(held, "node").select("block", "side", "node", "comp", *[c for c in held.columns if c != "node"])
    tasks = int(held.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return laid.repartition(tasks, "block").sortWithinPartitions("block")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", carry: tuple = (), keys: bool = False) -> DataFrame:
    """One row per document: id, ``carry``, n_shingles, component_id, kept, first.

    With ``keys`` also k1, k2, the hash of id and text.

    Words are runs of anything but ASCII white space, A-Z in lower case. A
    document's set holds its distinct 5-word shingles (fewer words: the whole
    sequence). Documents link at similarity 0.75 or more; ``component_id`` is the
    smallest id that links reach, ``kept`` says whether it is the row's own id,
    ``first`` marks exactly one row of each component (least id, then row).

    1. One pass over the texts gives each set's size, a 128-bit digest and
       ``BANDS * ROWS`` SetSketch registers. Equal sets become one node.
    2. Nodes with an equal band share a bucket. Each member is paired with the
       bucket's first one, not with all others. Sizes and the registers'
       joint likelihood rule pairs out, full sets decide on the rest.
    3. Buckets whose members are not all connected by then are compared further:
       members outside the bucket's largest component, block by block, with all
       members of other components. Sketches come first; those that they cannot
       rule out form groups of alike documents. Within groups the full sets of what
       is not connected yet are compared, again in blocks. So no pair that shares a
       band is left undecided unless its ends are connected, and no step emits pairs:
       a block hands on at most one edge per member.

    Large buckets are pre-aggregated, then split by row; blocks have
    a bounded number of documents on either side. Texts are shuffled once, for
    those that share a band. Only counts and flags come to the driver.

    Null or empty text, or text without words: n_shingles 0, alone. Null id:
    comes last in the order of ids; a component of null ids only has a null
    component_id, and kept is true on its first row. Rows with one id and text are
    copies like any other (kept on all that bear the smallest id). Columns beside id,
    text and ``carry`` are not read.
    """
    scratch = Scratch(docs.sparkSession, "near")
    keyed = docs.select(F.col(id_col), *carry, *row_key(id_col, text), F.col(text).alias("_text"))
    fields = [keyed.schema[c].simpleString().split(":", 1) for c in keyed.columns[:-1]]
    schema = ", ".join(f"`{n}` {t}" for n, t in fields) + ", " + _PROFILE
    rows = keyed.mapInArrow(_profiles, schema).withColumn("_row", F.monotonically_increasing_id())
    rows = scratch.keep(rows, "rows")

    nodes = (
        rows.where("n_shingles > 0")
        .groupBy("set_a", "set_b", "n_shingles")
        .agg(F.min("_row").alias("node"))
        .join(rows.select(F.col("_row").alias("node"), "k1", "k2", "sketch", "bands"), "node")
    )
    nodes = scratch.keep(nodes, "nodes")
    banded = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.min("node").alias("head"), F.count("*").alias("n")).where("n > 1")
    shared = scratch.keep(shared, "shared")
    members = scratch.keep(banded.join(shared, "bucket").select("bucket", "node", "head"), "members")
    involved = members.select("node").distinct().join(nodes.select("node", "k1", "k2"), "node")
    texts_ = docs.select(*row_key(id_col, text), F.col(text).alias("_text"))
    sets = involved.join(texts_, ["k1", "k2"]).select("node", "_text").mapInArrow(_sets, "node long, elements binary")
    sets = scratch.keep(sets, "sets")

    star = members.where("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    linked = _verified(star, nodes, sets, scratch, "star")
    roots = components(linked, scratch, "star")
    comp = F.coalesce("root", "node").alias("comp")
    placed = members.join(roots, "node", "left").select("bucket", "node", comp)
    alike = _blocks(placed, "bucket", nodes.select("node", "n_shingles", "sketch"), BLOCK, scratch).mapInArrow(_alike, "a long, b long")
    groups = components(alike, scratch, "alike").withColumnRenamed("root", "group")
    placed = groups.join(roots, "node", "left").select("group", "node", comp)
    more = _blocks(placed, "group", sets, SET_BLOCK, scratch).mapInArrow(_linked, "a long, b long")
    roots = components(linked.union(more), scratch, "all")
    scratch.drop("members", "sets")

    tops = nodes.select("node", "set_a", "set_b", "n_shingles").join(roots, "node", "left")
    tops = tops.select("set_a", "set_b", "n_shingles", F.coalesce("root", "node").alias("comp"))
    there = rows.select(id_col, *carry, "k1", "k2", "n_shingles", "set_a", "set_b", "_row").join(tops, ["set_a", "set_b", "n_shingles"], "left")
    there = there.withColumn("comp", F.coalesce("comp", "_row"))
    order = F.struct(F.col(id_col).isNull().alias("absent"), F.col(id_col).alias("id"), F.col("_row").alias("row"))
    there = scratch.keep(there, "placed")
    least = scratch.keep(there.groupBy("comp").agg(F.min(order).alias("least")), "least")
    scratch.drop_all_but("placed", "least")
    return there.join(least, "comp").select(
        id_col,
        *carry,
        *[c for c in ("k1", "k2") if keys],
        "n_shingles",
        F.col("least.id").alias("component_id"),
        F.coalesce(F.col(id_col) == F.col("least.id"), F.col("least.row") == F.col("_row")).alias("kept"),
        (F.col("least.row") == F.col("_row")).alias("first"),
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each group of near copies left: the least id's.

    Decisions are found as in ``near_duplicates`` and joined back by a hash of id
    and text, so whole rows move once. Rows with equal id and text become one before
    that, in the task that reads them and again after the shuffle.
    """
    first = near_duplicates(docs.select(id_col, text), id_col, text, keys=True).where("first").select("k1", "k2")
    rows = docs.select(*row_key(id_col, text), F.struct("*").alias("_doc")).groupBy("k1", "k2").agg(F.any_value("_doc").alias("_doc"))
    return rows.join(Scratch(docs.sparkSession, "near").keep(first, "first"), ["k1", "k2"]).select("_doc.*")
