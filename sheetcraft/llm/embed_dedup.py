"""Operator 9: near-duplicate embeddings by E8 lattice hashing.

Vectors are made unit length and projected, in each of ``TABLES`` tables, to
two blocks of eight random orthogonal directions.  A block falls into the cell
of its nearest E8 lattice point; the two next nearest of the point's 240
neighbours are probed too, so a vector is posted under 3 x 3 cells a table.
Two vectors at cosine 0.95 share a cell of one table with probability about
0.56, of seven tables with 0.997; at cosine 0.6 with 0.004.

All vectors of a cell are compared exactly, in blocks of bounded size, by
matrix products in double precision; links give components, and inside a
component all pairs are compared once more, in blocks, to count the links of
every vector, also those that no cell showed.  Equal vectors are one node with
a multiplicity throughout, so a hot vector costs one row.
"""

from __future__ import annotations

from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetcraft.llm.common import mix, prepare, written
from sheetcraft.llm.graph import components
from sheetcraft.llm.setjoin import sorted_runs

TABLES = 7
SCALE = 6.0  # cells for 64 dimensions; grows with the root of the dimensions
PROBES = 2
CHUNK = 1024  # vectors of a chunk; a block compares two chunks

_NEIGHBOURS = np.array(
    [
        [s if k == i else t if k == j else 0.0 for k in range(8)]
        for i, j in combinations(range(8), 2)
        for s in (1.0, -1.0)
        for t in (1.0, -1.0)
    ]
    + [s for s in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
)


def nearest_even(x: np.ndarray) -> np.ndarray:
    """Nearest points with whole coordinates of even sum."""
    point = np.rint(x)
    gap = x - point
    odd = np.flatnonzero(point.sum(axis=1) % 2)
    worst = np.abs(gap[odd]).argmax(axis=1)
    point[odd, worst] += np.where(gap[odd, worst] >= 0, 1.0, -1.0)
    return point


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points: even-sum points, or those moved by a half."""
    whole, half = nearest_even(x), nearest_even(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(closer[:, None], whole, half)


def block_cells(x: np.ndarray) -> np.ndarray:
    """Hashes of the cell of each row and of its ``PROBES`` next ones."""
    home = nearest_e8(x)
    # |x - home - m|^2 differs between neighbours m (of equal length) by x.m
    order = np.argpartition((home - x) @ _NEIGHBOURS.T, PROBES, axis=1)[:, :PROBES]
    points = np.concatenate((home[:, None, :], home[:, None, :] + _NEIGHBOURS[order]), axis=1)
    coded = np.rint(points * 2).astype(np.int64).view(np.uint64)
    factor = mix(np.arange(1, 9, dtype=np.uint64))
    return mix((coded * factor).sum(axis=2, dtype=np.uint64))


def projections(dims: int, table: int) -> np.ndarray:
    """Sixteen directions, orthonormal if there are that many dimensions."""
    random = np.random.default_rng([table, dims]).normal(size=(dims, 16))
    base = np.linalg.qr(random)[0] if dims >= 16 else random / np.sqrt(dims)
    return base * (SCALE * np.sqrt(dims / 64))


def cells(unit: np.ndarray) -> np.ndarray:
    """All cells of unit vectors (rows), TABLES * (PROBES + 1)**2 each."""
    out = []
    for table in range(TABLES):
        x = unit @ projections(unit.shape[1], table)
        a, b = block_cells(x[:, :8]), block_cells(x[:, 8:])
        pair = a[:, :, None] * np.uint64(0x9E3779B97F4A7C15) + b[:, None, :]
        out.append(mix(pair.reshape(len(unit), -1) + mix(np.array([table * 4096 + unit.shape[1]], dtype=np.uint64))))
    return np.concatenate(out, axis=1)


def unit_rows(column: pa.ListArray, dims: int) -> np.ndarray:
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # no overflow in the squares
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _post(batches):
    for batch in batches:
        lengths = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
        for dims in np.unique(lengths).tolist():
            own = batch.filter(pa.array(lengths == dims))
            found = cells(unit_rows(own.column(1), dims)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(own.column(0).to_numpy(), found.shape[1])),
                    pa.array(found.ravel()),
                ],
                ["node", "cell"],
            )


def in_blocks(rows: DataFrame, group: str, payload: list[str]) -> DataFrame:
    """Rows of each pair of chunks of a group, adjacent under ``block``."""
    sizes = rows.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    lo, hi = F.least("chunk", "other"), F.greatest("chunk", "other")
    return (
        rows.join(sizes, group)
        .withColumn("chunk", F.pmod(F.xxhash64("node", F.lit(5)), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(F.xxhash64(group, lo, hi).alias("block"), "chunk", (lo == hi).alias("same"), "node", *payload)
        .repartition("block")
        .sortWithinPartitions("block")
    )


def _block(rows: list[pa.RecordBatch]) -> pa.Table:
    return pa.Table.from_batches(rows).combine_chunks()


def cosines(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Cosines of all rows of one list column with all of another; vectors of
    unequal length have none."""
    la = a.value_lengths().to_numpy(zero_copy_only=False)
    lb = b.value_lengths().to_numpy(zero_copy_only=False)
    out = np.full((len(la), len(lb)), -2.0)
    for dims in np.intersect1d(la, lb).tolist():
        i, j = np.flatnonzero(la == dims), np.flatnonzero(lb == dims)
        out[np.ix_(i, j)] = unit_rows(a.take(pa.array(i)), dims) @ unit_rows(b.take(pa.array(j)), dims).T
    return out


def stars(near: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each node to the first node of its connected part."""
    label = np.arange(len(nodes))
    while True:
        lower = np.where(near, label[None, :], len(nodes)).min(axis=1, initial=len(nodes))
        lower = np.minimum(lower, label)
        lower = lower[lower]
        if (lower == label).all():
            break
        label = lower
    far = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[far], nodes[label[far]]


def _links(threshold: float):
    def run(batches):
        for rows in sorted_runs(batches, "block"):
            block = _block(rows)
            if block.num_rows < 2:
                continue
            vectors = block.column("vector").combine_chunks()
            a, b = stars(cosines(vectors, vectors) >= threshold, block.column("node").to_numpy())
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return run


def _counts(threshold: float):
    def run(batches):
        for rows in sorted_runs(batches, "block"):
            block = _block(rows)
            chunk = block.column("chunk").to_numpy()
            first = chunk == chunk.min()
            sides = [block.filter(pa.array(first)), block.filter(pa.array(~first))]
            same = block.column("same")[0].as_py()
            if same:
                sides[1] = sides[0]
            if not sides[1].num_rows:
                continue
            left, right = (s.column("vector").combine_chunks() for s in sides)
            near = cosines(left, right) >= threshold
            copies = [s.column("copies").to_numpy() for s in sides]
            if same:
                np.fill_diagonal(near, False)
            yield _tally(sides[0].column("node"), near @ copies[1])
            if not same:
                yield _tally(sides[1].column("node"), near.T @ copies[0])

    return run


def _tally(nodes: pa.ChunkedArray, links: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([nodes.combine_chunks(), pa.array(links.astype(np.int64))], ["node", "links"])


def embedding_components(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95
) -> DataFrame:
    """``(id_col, n_links, component_id, kept)``, a row a vector row.

    n_links counts the other rows at a cosine of at least ``threshold``;
    component_id is the smallest id reachable by links; kept marks that row.
    Null, empty and zero vectors and those with a null or non-finite component
    link with nothing, and so do vectors of unequal length.  Equal vectors are
    one node (a 64-bit hash of the vector); other columns are not read."""
    prepare(vectors.sparkSession)
    vector = F.col("vector")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.withColumn("node", F.when(usable, F.xxhash64("vector")))
    nodes = written(
        rows.where("node is not null")
        .groupBy("node")
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector")),
        "vectors",
    )
    postings = written(nodes.select("node", "vector").mapInArrow(_post, "node long, cell long"), "cells")
    shared = postings.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("cell")
    meeting = postings.join(shared, "cell").join(nodes.select("node", "vector"), "node")
    links = in_blocks(meeting, "cell", ["vector"]).mapInArrow(_links(threshold), "a long, b long")
    parts = components(links)
    members = nodes.join(parts, "node").select("root", "node", "copies", "vector")
    counts = (
        in_blocks(members, "root", ["vector", "copies"])
        .mapInArrow(_counts(threshold), "node long, links long")
        .groupBy("node")
        .agg(F.sum("links").alias("links"))
    )
    known = nodes.select("node", "first", "copies").join(parts, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = known.groupBy("root").agg(F.min("first").alias("component_id"))
    known = (
        known.join(smallest, "root")
        .join(counts, "node", "left")
        .select("node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    component = F.coalesce("component_id", "id")
    return rows.select("id", "node").join(known, "node", "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
