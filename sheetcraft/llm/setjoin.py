"""Verification of candidate groups of sets, in blocks.

Candidates arrive as clusters: sets joined by any shared signature.  Inside a
cluster, sets that could be similar at all lie in one size band or in two
neighbouring ones; each (cluster, band) is cut into chunks of bounded weight
and each pair of chunks is one block.  A block computes exact intersection
sizes from a 0/1 matrix of the items that at least two of its sets hold, and
returns a star for each connected part, never the pairs.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_ITEMS = 400_000  # items of a chunk
CHUNK_SETS = 1024  # sets of a chunk
COLUMNS = 4096  # columns of the 0/1 matrix at a time


def size_bands(num: int, den: int, top: int = 1 << 40) -> list[tuple[int, int]]:
    """Consecutive size ranges ``[lo, hi]``; two sets with Jaccard of at least
    num / den have sizes in one range or in two neighbouring ones."""
    bands, lo = [], 1
    while lo < top:
        hi = lo * den // num
        bands.append((lo, hi))
        lo = hi + 1
    return bands


def band_of(bands: list[tuple[int, int]], size: int) -> int:
    return bisect_left(bands, size, key=lambda b: b[1])


def parts(rows: list[pa.RecordBatch]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Nodes and item arrays of the rows of one block."""
    nodes, items = [], []
    for batch in rows:
        nodes.append(batch.column("node").to_numpy())
        column = batch.column("items")
        lengths = column.value_lengths().to_numpy(zero_copy_only=False)
        flat = column.flatten().to_numpy()
        items.extend(np.split(flat, np.cumsum(lengths)[:-1]))
    return np.concatenate(nodes), items


def sorted_runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[list[pa.RecordBatch]]:
    """Slices that share a key, from batches in which equal keys are adjacent."""
    pending: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        cuts = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]))
        for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if pending and keys[a] != current:
                yield pending
                pending = []
            current = keys[a]
            pending.append(batch.slice(a, z - a))
    if pending:
        yield pending


def intersections(items: list[np.ndarray]) -> np.ndarray:
    """Exact sizes of all intersections of the given sets (distinct items)."""
    n = len(items)
    if n == 2:
        shared = len(np.intersect1d(items[0], items[1], assume_unique=True))
        return np.array([[len(items[0]), shared], [shared, len(items[1])]], dtype=np.int64)
    flat = np.concatenate(items)
    owner = np.repeat(np.arange(n), [len(x) for x in items])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    first = np.concatenate(([True], flat[1:] != flat[:-1]))
    count = np.diff(np.concatenate((np.flatnonzero(first), [len(flat)])))
    shared = np.repeat(count > 1, count)
    owner, column = owner[shared], np.cumsum(first[shared]) - 1
    total = np.zeros((n, n), dtype=np.float64)
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, z = np.searchsorted(column, [lo, lo + COLUMNS])
        block = np.zeros((n, min(COLUMNS, int(column[-1]) + 1 - lo)), dtype=np.float32)
        block[owner[a:z], column[a:z] - lo] = 1
        total += block @ block.T
    return np.rint(total).astype(np.int64)


def block_stars(nodes: np.ndarray, items: list[np.ndarray], num: int, den: int) -> list[tuple[int, int]]:
    """Edges from each node to the smallest node of its connected part, where
    den * |intersection| >= num * |union| links two nodes."""
    nodes, first = np.unique(nodes, return_index=True)
    items = [items[i] for i in first]
    n = len(nodes)
    if n < 2:
        return []
    sizes = np.array([len(x) for x in items], dtype=np.int64)
    inter = intersections(items)
    near = den * inter >= num * (sizes[:, None] + sizes[None, :] - inter)
    edges, open_ = [], np.ones(n, dtype=bool)
    for i in range(n):
        if not open_[i]:
            continue
        part = np.zeros(n, dtype=bool)
        part[i] = True
        frontier = part
        while frontier.any():
            frontier = near[frontier].any(axis=0) & ~part
            part = part | frontier
        open_ &= ~part
        edges.extend((int(nodes[j]), int(nodes[i])) for j in np.flatnonzero(part) if j != i)
    return edges


def linked_sets(sets: DataFrame, num: int, den: int) -> DataFrame:
    """``(a, b)``: edges whose connected parts are those of "Jaccard of at
    least num / den" among sets of one cluster.

    ``sets``: node (long), root (long, its cluster), band (int) and items
    (array of distinct longs)."""
    spread = sets.select("node", "root", "items", F.explode(F.array("band", F.col("band") - 1)).alias("band"))
    weights = (
        sets.select("root", F.size("items").alias("n"), F.explode(F.array("band", F.col("band") - 1)).alias("band"))
        .groupBy("root", "band")
        .agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("weight"))
        .where("sets > 1")
        .select(
            "root",
            "band",
            F.greatest(F.ceil(F.col("weight") / CHUNK_ITEMS), F.ceil(F.col("sets") / CHUNK_SETS)).cast("int").alias("chunks"),
        )
    )
    chunk = F.pmod(F.xxhash64("node", F.lit(11)), F.col("chunks")).cast("int")
    rows = (
        spread.join(weights, ["root", "band"])
        .withColumn("chunk", chunk)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(
            F.xxhash64("root", "band", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("block"),
            "node",
            "items",
        )
        .repartition("block")
        .sortWithinPartitions("block")
    )

    def verify(batches):
        for rows in sorted_runs(batches, "block"):
            edges = block_stars(*parts(rows), num, den)
            if edges:
                a, b = zip(*edges)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return rows.mapInArrow(verify, "a long, b long").distinct()
