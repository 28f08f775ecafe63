"""Operator 3: n-gram Jaccard self-join by PartEnum signatures.

A document's set holds its distinct word k-gram hashes.  Sets whose sizes lie
in one band, or in two neighbouring ones, and whose Jaccard reaches num / den
differ in at most K items (K follows from the band).  The hash domain is split
into partitions by value range; with n2 = 3, groups of three partitions are
formed, enough that some group holds at most one differing item, and each
subset of two of its partitions is a signature; with n2 = 1 (large K) each
partition alone is one.  Similar sets therefore share a signature, whatever
the data.  Thin signatures (under ``THIN`` items) say little and are left out
where the partitioning has that many groups to spare, so no link is lost.

Sets with a common signature form candidate clusters, which are verified
exactly in blocks (``setjoin``); components follow from the verified links.
Identical sets are one node from the start, so copies are never compared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetcraft.llm.common import (
    FOLDED,
    joined,
    keyed_text,
    mix,
    prepare,
    release,
    shingle_hashes,
    text_groups,
    text_key,
    word_hashes,
    written,
)
from sheetcraft.llm.graph import components, star_edges
from sheetcraft.llm.setjoin import band_of, linked_sets, size_bands

SUBSETS_BELOW = 24  # K below which two of three partitions make a signature
THIN = 4  # items under which a signature is left out if it can be

_U = np.uint64


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Sorted distinct k-gram hashes of each text, A-Z lower-cased; a text of
    fewer words has one, of all its words; one without words has none."""
    data, offsets = joined(texts)
    words, starts, _ = word_hashes(data, FOLDED)
    bounds = np.searchsorted(starts, offsets)
    out = []
    for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        own = words[a:z]
        out.append(np.unique(shingle_hashes(own, min(k, len(own)))) if z > a else own[:0])
    return out


def set_hash(items: np.ndarray) -> int | None:
    """What identical sets have in common; none for the empty set."""
    if not len(items):
        return None
    return int(mix(np.array([items.sum(dtype=_U) + _U(len(items))], dtype=_U)).view(np.int64)[0])


def max_difference(band: tuple[int, int], num: int, den: int) -> int:
    """Most items in which two sets differ whose smaller one lies in ``band``."""
    return band[1] * (den - num) // num


def layout(differ: int) -> tuple[int, int, int]:
    """Groups, partitions a group, and groups to spare, for K = differ."""
    spare = (differ + 1) // 8
    if differ < SUBSETS_BELOW:
        return differ // 2 + 1 + spare, 3, spare
    return differ + 1 + spare, 1, spare


def signatures(items: np.ndarray, bands: list[tuple[int, int]], num: int, den: int) -> np.ndarray:
    """Signatures of a set (sorted distinct uniform hashes) as the smaller and
    as the larger member of a pair."""
    own = band_of(bands, len(items))
    sums = np.zeros(len(items) + 1, dtype=_U)
    np.cumsum(mix(items), out=sums[1:])
    out = []
    for instance in (own, own - 1):
        differ = max_difference(bands[instance], num, den) if instance >= 0 else 0
        if not differ:  # only identical sets, which are one node
            continue
        groups, width, spare = layout(differ)
        edges = np.linspace(0, 2.0**64, groups * width + 1)[1:-1].astype(_U)
        at = np.concatenate(([0], np.searchsorted(items, edges), [len(items)]))
        value, count = sums[at[1:]] - sums[at[:-1]], np.diff(at)
        if width == 3:
            value, count = value.reshape(-1, 3), count.reshape(-1, 3)
            value = value.sum(axis=1, keepdims=True, dtype=_U) - value
            count = count.sum(axis=1, keepdims=True) - count
        else:
            value, count = value.reshape(-1, 1), count.reshape(-1, 1)
        tag = np.arange(value.size, dtype=_U).reshape(value.shape) + _U(instance << 40)
        value = mix(value + mix(tag))
        thin = count < THIN
        if thin.any(axis=1).sum() <= spare:
            value = value[~thin]
        out.append(value.ravel())
    return np.concatenate(out) if out else np.empty(0, dtype=_U)


def _describe(num: int, den: int, k: int):
    bands = size_bands(num, den)

    def run(batches):
        for batch in batches:
            ids, texts = batch.select(["id", "key"]), batch.column("text").to_pylist()
            for positions, group in text_groups(range(len(texts)), texts):
                sets = shingle_sets(group, k)
                sigs = [signatures(s, bands, num, den) if len(s) else s for s in sets]
                lengths = np.concatenate(([0], np.cumsum([len(s) for s in sigs])))
                flat = np.concatenate(sigs).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        *ids.take(pa.array(positions)).columns,
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([set_hash(s) for s in sets], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(flat, pa.int64())),
                    ],
                    ["id", "key", "n_items", "set_id", "sigs"],
                )

    return run


def _members(num: int, den: int, k: int):
    bands = size_bands(num, den)

    def run(batches):
        for batch in batches:
            nodes, texts = batch.column("node").to_pylist(), batch.column("text").to_pylist()
            for positions, group in text_groups(range(len(texts)), texts):
                sets = shingle_sets(group, k)
                # Rows equal in id and text hash may still differ in text.
                own = [(p, s) for p, s in zip(positions, sets) if set_hash(s) == nodes[p]]
                if not own:
                    continue
                at, sets = zip(*own)
                lengths = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.select(["node", "root"]).take(pa.array(at)).columns,
                        pa.array([band_of(bands, len(s)) for s in sets], pa.int32()),
                        pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(np.concatenate(sets).view(np.int64))),
                    ],
                    ["node", "root", "band", "items"],
                )

    return run


def _linked(docs: DataFrame, id_col: str, text_col: str, k: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """``(id, key, n_items, set_id, sigs)``, a row a document row, and
    ``(node, first, root)``: each set, its smallest id and its component."""
    spark = docs.sparkSession
    prepare(spark)
    rows = keyed_text(docs, id_col, text_col).toDF("id", "text").select("id", text_key(F.col("text")).alias("key"), "text")
    described = written(
        rows.mapInArrow(_describe(num, den, k), "id long, key long, n_items long, set_id long, sigs array<long>"), "partenum"
    )
    postings = described.select(F.col("set_id").alias("node"), F.explode("sigs").alias("sig"))
    clusters = components(star_edges(postings, "sig", "node"))
    release(spark)
    # Copies collapse in the aggregate's map side before anything is joined.
    firsts = (
        described.where("set_id is not null")
        .groupBy(F.col("set_id").alias("node"))
        .agg(F.min("id").alias("first"), F.min(F.struct("id", "key")).alias("at"))
    )
    chosen = firsts.join(clusters, "node").select("node", "root", "at")
    holder = rows.join(chosen, rows["id"].eqNullSafe(chosen["at.id"]) & (rows["key"] == chosen["at.key"]))
    sets = written(
        holder.select("node", "root", "text").mapInArrow(
            _members(num, den, k), "node long, root long, band int, items array<long>"
        ),
        "sets",
    )
    parts = components(linked_sets(sets, num, den))
    grouped = firsts.select("node", "first").join(parts, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return described, grouped


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = 3,
    num: int = 90,
    den: int = 100,
) -> DataFrame:
    """``(id_col, n_shingles, component_id)``, a row a document row.

    Two documents link when den * |intersection| >= num * |union| of their
    k-gram sets; component_id is the smallest id reachable.  Null and wordless
    texts have an empty set and are their own component.  Repeated ids keep
    their rows; a null id is ignored by the minimum.  Other columns are not
    read.  An empty table gives an empty result."""
    described, grouped = _linked(docs, id_col, text_col, k, num, den)
    smallest = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    by_set = grouped.join(smallest, "root").select(F.col("node").alias("set_id"), "component_id")
    return (
        described.select("id", "n_items", "set_id")
        .join(by_set, "set_id", "left")
        .select(
            F.col("id").alias(id_col),
            F.col("n_items").alias("n_shingles"),
            F.coalesce("component_id", "id").alias("component_id"),
        )
    )


def one_a_component(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = 3,
    num: int = 90,
    den: int = 100,
) -> DataFrame:
    """Rows and columns of ``docs``, exactly one row of each component.

    The row of the smallest id stays, a null id only where no row of the
    component has one; of several rows of that id the one of the smallest text
    hash; of rows equal in id and text the smallest in its other columns.
    Null and wordless texts are no copies of anything: all their rows stay."""
    described, grouped = _linked(docs, id_col, text_col, k, num, den)
    held = described.where("set_id is not null").groupBy("set_id", "id", "key").agg(F.count(F.lit(1)).alias("rows"))
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key", "rows")).alias("at")
    by_set = held.groupBy(F.col("set_id").alias("node")).agg(least)
    chosen = by_set.join(grouped.select("node", "root"), "node").groupBy("root").agg(F.min("at").alias("at"))
    wordless = described.where("set_id is null").select("id", "key", F.lit(1).cast("long").alias("rows")).distinct()
    chosen = written(chosen.select("at.id", "at.key", "at.rows").union(wordless), "chosen").toDF("__id", "__key", "__rows")
    # The row as one value, so that its columns may have any name.
    own = lambda c: F.col("row").getField(c)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    same = own(id_col).cast("long").eqNullSafe(F.col("__id")) & (text_key(own(text_col).cast("string")) == F.col("__key"))
    alone = rows.join(chosen.where("__rows = 1"), same, "left_semi")
    # Only rows that are there several times are grouped.
    several = rows.join(chosen.where("__rows > 1"), same).groupBy("__id", "__key").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return alone.union(several.select("row")).select(*[own(c).alias(c) for c in docs.columns])
