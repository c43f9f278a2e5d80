"""Near-duplicate vectors: PCA-ordered, tiled comparison with bounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.components import components
from shelfwise.llm.support import Scratch, least_reached, runs_of

THRESHOLD = 0.93
GRID = 2  # leading components that tiles are cut by
TILE = 1024  # vectors of a tile, about
LEAD = 8  # dimensions of the first comparison step; doubled at each further step
SLACK = 1e-9  # added to bounds, far above rounding


def _gram(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            x = _rows(batch.column(0), width)
            total += x.T @ x
        i, j = np.divmod(np.arange(width * width), width)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], names=["i", "j", "v"])

    return run


def _rows(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of length 1, shorter ones filled up with zeros."""
    length = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    out = np.zeros((len(length), width))
    out[np.repeat(np.arange(len(length)), length), np.concatenate([np.arange(n) for n in length] or [[]]).astype(int)] = values
    out /= np.abs(out).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


def _rotated(width: int, axes: np.ndarray, cell: float):
    """node, vec to node, rotated unit vector, cell of its leading components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 4096):
                part = batch.slice(low, 4096)
                x = _rows(part.column(1), width) @ axes
                cells = np.floor(x[:, :GRID] / cell).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([r.tobytes() for r in x], pa.binary()),
                        *[pa.array(cells[:, k] if k < cells.shape[1] else np.zeros(len(x), np.int32)) for k in range(GRID)],
                    ],
                    names=["node", "unit", *[f"c{k}" for k in range(GRID)]],
                )

    return run


def close_pairs(x: np.ndarray, y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of rows of ``x`` and ``y`` (unit vectors in PCA order) with cosine >= threshold.

    Leading dimensions are multiplied first. What the others can add is at most
    the product of the two suffix norms; pairs that cannot reach the threshold any
    more stop there, the rest go on with the next, twice as many dimensions.
    """
    width = x.shape[1]
    done = min(LEAD, width)
    product = x[:, :done] @ y[:, :done].T
    rest_x, rest_y = (np.sqrt(np.maximum((v[:, done:] ** 2).sum(1), 0)) for v in (x, y))
    i, j = np.nonzero(product + np.outer(rest_x, rest_y) >= threshold - SLACK)
    product = product[i, j]
    while done < width and len(i):
        upto = min(width, 2 * done)
        for low in range(0, len(i), 1 << 16):
            cut = slice(low, low + (1 << 16))
            product[cut] += np.einsum("ij,ij->i", x[i[cut], done:upto], y[j[cut], done:upto])
        rest_x, rest_y = (np.sqrt(np.maximum((v[:, upto:] ** 2).sum(1), 0)) for v in (x, y))
        alive = product + rest_x[i] * rest_y[j] >= threshold - SLACK
        i, j, product, done = i[alive], j[alive], product[alive], upto
    return i, j


def _compared(threshold: float):
    """Rows of one comparison after the other (task, side, node, copies, vec, unit) to
    (node, links, other): links counts other vectors linked, ``other`` is one that links reach."""

    def found(t: pa.Table) -> pa.RecordBatch:
        side, node, copies = (t.column(c).to_numpy() for c in ("side", "node", "copies"))
        width = len(t.column("unit")[0].as_py()) // 8
        unit = np.frombuffer(b"".join(t.column("unit").to_pylist()), float).reshape(-1, width)
        first, second = np.flatnonzero(side < 2), np.flatnonzero(side != 1)  # side 0: one tile with itself
        pairs_a, pairs_b = [], []
        for low in range(0, len(first), TILE):
            for at in range(0, len(second), TILE):
                i, j = close_pairs(unit[first[low : low + TILE]], unit[second[at : at + TILE]], threshold)
                pairs_a.append(first[low + i])
                pairs_b.append(second[at + j])
        a, b = np.concatenate(pairs_a or [first[:0]]), np.concatenate(pairs_b or [first[:0]])
        alone = (side[a] != 0) | (a < b)
        a, b = a[alone], b[alone]
        sure = exact(t.column("vec"), a, b)
        a, b = a[sure], b[sure]
        links = np.bincount(a, copies[b], len(node)) + np.bincount(b, copies[a], len(node))
        some, least = np.flatnonzero(links), least_reached(a, b, len(node))
        return pa.RecordBatch.from_arrays(
            [pa.array(node[some]), pa.array(links[some].astype(np.int64)), pa.array(node[least[some]])], names=["node", "links", "other"]
        )

    def exact(column: pa.ChunkedArray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Cosine of the vectors themselves, in double precision, not of the rotated ones."""
        if not len(a):
            return np.zeros(0, bool)
        vec = column.combine_chunks()
        width = int(vec.value_lengths()[0].as_py())
        unit = _rows(vec, width)
        out = np.zeros(len(a), bool)
        for low in range(0, len(a), 1 << 16):
            cut = slice(low, low + (1 << 16))
            out[cut] = np.einsum("ij,ij->i", unit[a[cut]], unit[b[cut]]) >= threshold
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in runs_of(batches):
            yield found(held)

    return run


def similar_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    tile: int = TILE,
    carry: tuple = (),
) -> DataFrame:
    """One row per vector: id, ``carry``, n_links, component_id, kept.

    Vectors of one label (not null) and one length link at cosine >= ``threshold``
    (above 0). ``n_links`` counts the other vectors linked, ``component_id`` is the
    smallest id that links reach, ``kept`` says whether it is the row's own.

    Equal vectors of a label become one node with a number of copies, counted
    before the shuffle. One pass sums products of all unit vectors; the principal
    axes follow on the driver (width squared numbers). Nodes are rotated, and cut
    into cells by their leading components: linked unit vectors differ by at most
    sqrt(2 - 2 * threshold) in each, so they lie in neighbouring cells of that
    width. Large cells are dealt into tiles of about ``tile`` nodes by a hash, and
    each pair of tiles is one small comparison: leading dimensions first, bounds by
    suffix norms, then the exact cosine of those that are left. A comparison hands
    on one row per linked node (count, least node reached), never all pairs. A label with most of
    the rows is many cells and tiles, so no group is handled as one.

    Null vectors, null or non-finite components, zero vectors, empty vectors and
    null labels: no links, component of their own. Null id: comes last; a
    component without any id has a null component_id and its first row is kept.
    Repeated rows are copies. No rows: no rows. Columns beside these are not read.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold between 0 and 1")
    spark = vectors.sparkSession
    scratch = Scratch(spark, "vectors")
    fine = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(vector, lambda v: v != 0)
    usable = F.coalesce(F.col(vector).isNotNull() & F.col(label).isNotNull() & fine, F.lit(False))
    doubles = F.transform(F.col(vector), lambda v: v.cast("double") + F.lit(0.0))
    rows = vectors.select(F.col(id_col), *carry, F.col(label).alias("_label"), F.when(usable, doubles).alias("vec"), F.monotonically_increasing_id().alias("_row"))
    rows = scratch.keep(rows, "rows")
    nodes = rows.where("vec is not null").groupBy("_label", "vec").agg(F.min("_row").alias("node"), F.count("*").alias("copies"))
    nodes = scratch.keep(nodes.withColumn("length", F.size("vec")), "nodes")
    width = nodes.agg(F.coalesce(F.max("length"), F.lit(0))).first()[0]
    cell = float(np.sqrt(2 - 2 * threshold)) + 1e-6
    axes = np.eye(width)
    if width:
        sums = nodes.select("vec").mapInArrow(_gram(width), "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
        gram = np.zeros((width, width))
        for r in sums.collect():
            gram[r["i"], r["j"]] = r["v"]
        axes = np.linalg.eigh(gram)[1][:, ::-1].copy()
    cells = [f"c{k}" for k in range(GRID)]
    schema = "node long, unit binary, " + ", ".join(f"{c} int" for c in cells)
    turned = nodes.select("node", "vec").mapInArrow(_rotated(width, axes, cell), schema)
    placed = scratch.keep(turned.join(nodes.select("node", "_label", "length", "copies", "vec"), "node"), "placed")

    where = ["_label", "length", *cells]
    sizes = placed.groupBy(*where).agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    steps = F.array(*[F.lit(k) for k in (-1, 0, 1)])
    near = sizes
    for c in cells:
        near = near.withColumn(f"_{c}", F.explode(steps))
    far = [(F.col(c) + F.col(f"_{c}")).alias(f"to_{c}") for c in cells]
    ahead = F.struct(*[f"_{c}" for c in cells]) >= F.struct(*[F.lit(0) for _ in cells])
    near = near.where(ahead).select(*where, "tiles", *far)
    there = sizes.select("_label", "length", *[F.col(c).alias(f"to_{c}") for c in cells], F.col("tiles").alias("to_tiles"))
    met = near.join(there, ["_label", "length", *[f"to_{c}" for c in cells]])
    itself = F.expr(" and ".join(f"{c} = to_{c}" for c in cells))
    tasks = (
        met.withColumn("itself", itself)
        .withColumn("t", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .withColumn("u", F.explode(F.sequence(F.when(F.col("itself"), F.col("t")).otherwise(0), F.col("to_tiles") - 1)))
        .withColumn("task", F.xxhash64(*where, *[f"to_{c}" for c in cells], "t", "u"))
    )
    tasks = scratch.keep(tasks, "tasks")
    same = F.col("itself") & (F.col("t") == F.col("u"))
    left = tasks.select(*where, F.col("t").alias("_tile"), "task", F.when(same, 0).otherwise(1).alias("side"))
    right = tasks.where(~same).select("_label", "length", *[F.col(f"to_{c}").alias(c) for c in cells], F.col("u").alias("_tile"), "task", F.lit(2).alias("side"))
    dealt = placed.join(sizes, where).withColumn("_tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    sides = dealt.join(left.union(right), [*where, "_tile"]).select("task", "side", "node", "copies", "vec", "unit")
    laid = sides.repartition("task").sortWithinPartitions("task")
    links = scratch.keep(laid.mapInArrow(_compared(threshold), "node long, links long, other long"), "links")
    scratch.drop("placed", "tasks")

    roots = components(links.where("node <> other").select(F.col("node").alias("a"), F.col("other").alias("b")), scratch, "vectors")
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    tops = nodes.join(counts, "node", "left").join(roots, "node", "left")
    tops = tops.select("_label", "vec", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("comp"))
    all_rows = rows.join(tops, ["_label", "vec"], "left").withColumn("comp", F.coalesce("comp", "_row"))
    order = F.struct(F.col(id_col).isNull().alias("absent"), F.col(id_col).alias("id"), F.col("_row").alias("row"))
    all_rows = scratch.keep(all_rows, "all")  # so that a hot component is a plain shuffle on both sides
    least = scratch.keep(all_rows.groupBy("comp").agg(F.min(order).alias("least")), "least")
    scratch.drop_all_but("all", "least")
    return all_rows.join(least, "comp").select(
        id_col,
        *carry,
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.col("least.id").alias("component_id"),
        F.coalesce(F.col(id_col) == F.col("least.id"), F.col("least.row") == F.col("_row")).alias("kept"),
    )
