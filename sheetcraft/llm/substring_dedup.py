"""Operator 2: repeated passages, by paragraph MinHash banding.

Paragraphs are lines; MinHash over five-word shingles, in bands, brings near
copies together.  Paragraphs that share a band form candidate clusters, which
are verified exactly (Jaccard of at least num / den) in blocks; of each
component of near copies those of the first document stay.

A passage may also sit inside longer paragraphs, or be wrapped otherwise.  So
whatever the lines, each run of ``MIN_RUN`` words that an earlier document
holds is found, by its hash.  Not all these hashes are compared: every run has
an anchor, the shingle of ``ANCHOR`` words with the smallest hash among those
it holds, so equal runs have equal anchors, and about one word in three starts
one.  Runs are compared only where their anchor is in several documents, each
with the first document that holds it; overlapping ones join, so what is
removed ends where the match ends.  Repeats inside one document are left alone.

What is removed is words: whole paragraphs that are near copies, whatever their
length, and those of such runs.  Paragraphs come first: a run with a word of a
paragraph that goes as a near, not equal, copy is no source of another, so
every word that is removed within a run has a copy, in the run's first holder
or in turn in that of a run or equal paragraph there, that stays.  "First" is by document id.
"""

from __future__ import annotations

import json
import math
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetcraft.llm.common import FOLDED, erase, joined, mix, powers, prepare, release, shingle_hashes, text_groups, text_key, word_hashes, written
from sheetcraft.llm.graph import components, star_edges
from sheetcraft.llm.setjoin import band_of, linked_sets, size_bands

SHINGLE = 5
MIN_RUN = 12  # words of a repeated run that is removed
ANCHOR = 8  # words of the shingles of which a run has the smallest as anchor
SLICES = 4  # parts in which anchors are compared, so that less lies on disk at a time
_U = np.uint64
_WIDE = 1 << 16
_UP: list[np.ndarray] = []


def tuned_bands(similarity: float, recall: float, rows: int = 2) -> tuple[int, int]:
    """Bands of ``rows`` hashes, the fewest that find a pair of the given
    similarity with the wanted probability."""
    bands = math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))
    return max(1, bands), rows


class Layout:
    """Words and paragraphs of a group of texts."""

    def __init__(self, texts: list[bytes]):
        self.data, self.offsets = joined(texts)
        self.words, self.starts, self.ends = word_hashes(self.data, FOLDED)
        n = len(self.words)
        breaks = np.flatnonzero(self.data == 10)
        line = np.searchsorted(breaks, self.starts)
        fresh = np.ones(n, dtype=bool)
        fresh[1:] = line[1:] != line[:-1]
        self.para_first = np.flatnonzero(fresh)
        self.para_words = np.diff(np.append(self.para_first, n))
        # By text: first word and first paragraph.
        self.text_words = np.searchsorted(self.starts, self.offsets)
        self.text_paras = np.searchsorted(self.para_first, self.text_words)

    def runs(self) -> tuple[np.ndarray, np.ndarray]:
        """First words of all runs of MIN_RUN words inside a text, and the
        hash of the anchor of each."""
        shingles = shingle_hashes(self.words, ANCHOR)
        n = len(self.words) - MIN_RUN + 1
        if n <= 0:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=_U)
        anchor = shingles[:n].copy()
        for d in range(1, MIN_RUN - ANCHOR + 1):
            np.minimum(anchor, shingles[d : d + n], out=anchor)
        text_of = np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.text_words))
        first = np.flatnonzero(text_of[:n] == text_of[MIN_RUN - 1 :])
        return first, anchor[first]

    def sequence_hashes(self, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """A hash of the words of each run, in order."""
        if not len(first):
            return np.empty(0, dtype=_U)
        if not _UP:
            _UP.append(powers(_WIDE)[0])
        place = np.arange(len(self.words)) - np.repeat(first, sizes)
        values = self.words * _UP[0].take(place % _WIDE)
        return mix(np.add.reduceat(values, first) + sizes.astype(_U))

    def shingles(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Paragraphs with at least SHINGLE words, their shingles one after
        another, and how many each has."""
        rows = np.flatnonzero(self.para_words >= SHINGLE)
        every = shingle_hashes(self.words, SHINGLE)
        sizes = self.para_words[rows] - (SHINGLE - 1)
        first = np.cumsum(sizes) - sizes
        at = np.arange(int(sizes.sum())) + np.repeat(self.para_first[rows] - first, sizes)
        return rows, every[at], sizes


def band_keys(shingles: np.ndarray, sizes: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band keys of each run of shingles, runs x bands."""
    out = np.empty((len(sizes), bands), dtype=_U)
    if not len(sizes):
        return out
    first = np.cumsum(sizes) - sizes
    for b in range(bands):
        key = np.full(len(sizes), b, dtype=_U)
        for r in range(rows):
            seed = mix(np.array([b * rows + r + 1], dtype=_U))
            key = mix(key * _U(31) + np.minimum.reduceat(mix(shingles ^ seed), first))
        out[:, b] = key
    return out


def _lists(values: np.ndarray, cuts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values, kind))


def _describe(bands: int, rows: int):
    def run(batches):
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for positions, group in text_groups(range(len(texts)), texts):
                own = Layout(group)
                first, anchor = own.runs()
                bounds = np.searchsorted(first, own.text_words)
                anchors = [np.unique(anchor[a:z]) for a, z in zip(bounds[:-1], bounds[1:])]
                anchor_cuts = np.concatenate(([0], np.cumsum([len(x) for x in anchors])))
                nodes = own.sequence_hashes(own.para_first, own.para_words).view(np.int64)
                paras, shingles, sizes = own.shingles()
                keys = band_keys(shingles, sizes, bands, rows).view(np.int64)
                cuts = np.searchsorted(paras, own.text_paras)
                from_word = own.para_first[paras] - np.repeat(own.text_words[:-1], np.diff(cuts))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(positions)),
                        batch.column(1).take(pa.array(positions)),
                        _lists(np.concatenate(anchors).view(np.int64), anchor_cuts, pa.int64()),
                        _lists(nodes[paras], cuts, pa.int64()),
                        _lists(from_word, cuts, pa.int64()),
                        _lists(from_word + own.para_words[paras], cuts, pa.int64()),
                        _lists(keys.ravel(), cuts * bands, pa.int64()),
                    ],
                    ["id", "key", "anchors", "para", "para_from", "para_to", "bands"],
                )

    return run


def _runs(batches):
    """Runs, as hash and first word, of which the anchor is wanted, but for
    those inside one paragraph that goes (the document where an equal one stays
    holds these runs too).  A run is a source only if none of its words is in
    a paragraph that goes as a near, not equal, copy."""
    for batch in batches:
        texts = batch.column("text").to_pylist()
        wanted, gone = batch.column("wanted"), batch.column("gone").to_pylist()
        for positions, group in text_groups(range(len(texts)), texts):
            own = Layout(group)
            first, anchor = own.runs()
            near = np.zeros(len(own.words) + 1, dtype=np.int64)
            paragraph = np.full(len(own.words), -1, dtype=np.int64)
            for t, p in enumerate(positions):
                for mark in gone[p] or ():
                    a, z = own.text_words[t] + mark["from"], own.text_words[t] + mark["to"]
                    paragraph[a:z] = a
                    near[a + 1 : z + 1] = not mark["equal"]
            near = np.cumsum(near)
            good = (paragraph[first] < 0) | (paragraph[first] != paragraph[first + MIN_RUN - 1])
            first, anchor = first[good], anchor[good]
            source = near[first + MIN_RUN] == near[first]
            bounds = np.searchsorted(first, own.text_words)
            every = shingle_hashes(own.words, MIN_RUN).view(np.int64)
            held = np.zeros(len(first), dtype=bool)
            for p, a, z in zip(positions, bounds[:-1], bounds[1:]):
                held[a:z] = np.isin(anchor[a:z].view(np.int64), wanted[p].values.to_numpy())
            first, source = first[held], source[held]
            text = np.searchsorted(own.text_words, first, side="right") - 1
            ids = batch.select(["id", "key"]).take(pa.array(np.array(positions, dtype=np.int64)[text]))
            columns = [*ids.columns, pa.array(every[first], pa.int64()), pa.array(first - own.text_words[text], pa.int64()), pa.array(source)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "key", "hash", "from", "source"])


def _members(num: int, den: int):
    ranges = size_bands(num, den)

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            wanted = batch.column("wanted").to_pylist()
            for positions, group in text_groups(range(len(texts)), texts):
                own = Layout(group)
                nodes = own.sequence_hashes(own.para_first, own.para_words).view(np.int64)
                paras, shingles, sizes = own.shingles()
                text_of = np.searchsorted(own.text_paras, paras, side="right") - 1
                out: tuple[list, ...] = ([], [], [], [])
                for p, t, items in zip(paras.tolist(), text_of.tolist(), np.split(shingles, np.cumsum(sizes)[:-1])):
                    root = {w["node"]: w["root"] for w in wanted[positions[t]]}.get(int(nodes[p]))
                    if root is not None:
                        distinct = np.unique(items).view(np.int64)
                        for column, value in zip(out, (int(nodes[p]), root, band_of(ranges, len(distinct)), distinct)):
                            column.append(value)
                if out[0]:
                    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, k) for x, k in zip(out, kinds)], ["node", "root", "band", "items"]
                    )

    return run


def near_paragraphs(rows: DataFrame, described: DataFrame, num: int, den: int) -> DataFrame:
    """``(node, root)``: paragraphs (as sequence hashes) of one component."""
    per_para = F.size("bands") / F.greatest(F.size("para"), F.lit(1))
    pairs = described.select("para", per_para.cast("int").alias("bands_each"), F.posexplode("bands").alias("at", "band"))
    postings = pairs.select(F.expr("para[at div bands_each]").alias("node"), "band")
    clusters = components(star_edges(postings, "band", "node"))
    release(rows.sparkSession)
    holders = (
        described.select("id", "key", F.explode("para").alias("node"))
        .join(clusters, "node")
        .groupBy("node", "root")
        .agg(F.min(F.struct("id", "key")).alias("at"))
        .groupBy("at")  # the paragraphs of one document
        .agg(F.collect_list(F.struct("node", "root")).alias("wanted"))
        .select(F.col("at.id").alias("id"), F.col("at.key").alias("key"), "wanted")
    )
    found = rows.join(holders, (rows["id"].eqNullSafe(holders["id"])) & (rows["key"] == holders["key"]))
    sets = found.select("text", "wanted").mapInArrow(_members(num, den), "node long, root long, band int, items array<long>")
    sets = written(sets.dropDuplicates(["node"]), "paragraph-sets")
    parts = written(components(linked_sets(sets, num, den)), "near-paragraphs")
    erase(sets)
    return parts


def _of_document(marks: DataFrame, out: str, *columns: str) -> DataFrame:
    return marks.groupBy("id", "key").agg(F.collect_list(F.struct(*columns)).alias(out))


def _beside(rows: DataFrame, more: DataFrame, how: str) -> DataFrame:
    """Rows with the columns that ``more`` has for their document."""
    more = more.withColumnsRenamed({"id": "__id", "key": "__key"})
    return rows.join(more, F.col("id").eqNullSafe(F.col("__id")) & (F.col("key") == F.col("__key")), how).drop("__id", "__key")


def shared_anchors(described: DataFrame) -> DataFrame:
    """``(id, key, wanted)``: the anchors of a document that others hold too."""
    anchors = described.select("id", "key", F.explode("anchors").alias("anchor"))
    slices = []
    for part in range(SLICES):
        own = anchors.where(F.pmod("anchor", F.lit(SLICES)) == part)
        shared = own.groupBy("anchor").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("anchor")
        wanted = own.join(shared, "anchor").groupBy("id", "key").agg(F.collect_set("anchor").alias("wanted"))
        slices.append(written(wanted, "anchors"))
        release(described.sparkSession)
    whole = reduce(DataFrame.union, slices).groupBy("id", "key").agg(F.flatten(F.collect_list("wanted")).alias("wanted"))
    whole = written(whole, "anchors")
    erase(*slices)
    return whole


def repeated_runs(rows: DataFrame, wanted: DataFrame, paragraphs: DataFrame) -> list[DataFrame]:
    """``(id, key, marks)``: the runs of MIN_RUN words, as word ranges, that an
    earlier document holds in words that may be a source; a table a slice.
    ``of`` is the id of the first that holds the run."""
    gone = _of_document(paragraphs, "gone", "from", "to", "equal")
    found = _beside(_beside(rows, wanted, "inner"), gone, "left")
    runs = written(found.select("id", "key", "text", "wanted", "gone").mapInArrow(_runs, "id long, key long, hash long, from long, source boolean"), "runs")
    release(rows.sparkSession)
    place, out = F.struct("id", "key"), []
    for part in range(SLICES):
        own = runs.where(F.pmod("hash", F.lit(SLICES)) == part)
        firsts = own.groupBy("hash").agg(F.min(F.when(F.col("source"), place)).alias("first"), F.max(place).alias("last")).where("first < last")
        later = own.join(firsts.select("hash", "first"), "hash").where(place > F.col("first"))
        later = later.select("id", "key", "from", (F.col("from") + MIN_RUN).alias("to"), F.col("first.id").alias("of"))
        spans = _of_document(later, "marks", "from", "to", "of").mapInArrow(_narrowed, f"id long, key long, marks {_MARKS}")
        out.append(written(spans, "run-marks"))
        release(rows.sparkSession)
    erase(runs)
    return out


def repeated_paragraphs(described: DataFrame, near: DataFrame) -> DataFrame:
    """``(id, key, from, to, of, equal)``: the paragraphs, as word ranges, that
    equal or nearly equal one of an earlier document, ``of``."""
    place = F.struct("id", "key")
    paras = described.select("id", "key", F.explode(F.arrays_zip("para", "para_from", "para_to")).alias("p")).select(
        "id", "key", F.col("p.para_from").alias("from"), F.col("p.para_to").alias("to"), F.col("p.para").alias("node")
    )
    ends = paras.groupBy("node").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    groups = ends.join(near, "node", "left").where("root is not null or first < last")
    groups = groups.select("node", "first", F.coalesce("root", "node").alias("root"))
    kept = groups.groupBy("root").agg(F.min("first").alias("kept"))
    nodes = groups.join(kept, "root").select("node", "kept", (F.col("first") == F.col("kept")).alias("equal"))
    copies = paras.join(nodes, "node").where(place > F.col("kept"))
    return copies.select("id", "key", "from", "to", F.col("kept.id").alias("of"), F.coalesce("equal", F.lit(False)).alias("equal"))


def joined_ranges(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The ranges in order, those that overlap or touch made one."""
    out: list[tuple[int, int]] = []
    for a, z in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


_MARK = pa.struct([("from", pa.int64()), ("to", pa.int64()), ("of", pa.int64())])
_MARKS = "array<struct<`from`: bigint, `to`: bigint, `of`: bigint>>"


def _narrowed(batches):
    """Marks of a document, those of one source that overlap made one."""
    for batch in batches:
        out = []
        for marks in batch.column("marks").to_pylist():
            sources: dict = {}
            for m in marks:
                sources.setdefault(m["of"], []).append((m["from"], m["to"]))
            out.append([{"from": a, "to": z, "of": of} for of, own in sources.items() for a, z in joined_ranges(own)])
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), pa.array(out, pa.list_(_MARK))], ["id", "key", "marks"])


def _spans(batches):
    for batch in batches:
        out, sources = [], []
        for marks in batch.column("marks").to_pylist():
            out.append([{"from_word": a, "to_word": z} for a, z in joined_ranges([(m["from"], m["to"]) for m in marks])])
            sources.append(sorted({m["of"] for m in marks if m["of"] is not None}))
        kind = pa.list_(pa.struct([("from_word", pa.int64()), ("to_word", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("key"), pa.array(out, kind), pa.array(sources, pa.list_(pa.int64()))],
            ["id", "key", "removed", "repeats_of"],
        )


def without_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the given ranges of words.  White space after a
    removed word goes with it; a line left without words goes whole."""
    own = Layout([text.encode("utf-8", "surrogatepass")])
    gone = np.zeros(len(own.words), dtype=bool)
    for a, z in spans:
        gone[a:z] = True
    out = []
    data = own.data.tobytes()[:-1]
    at = 0
    for line in data.split(b"\n"):
        a, z = np.searchsorted(own.starts, [at, at + len(line) + 1])
        if not gone[a:z].any():
            out.append(line)
        elif not gone[a:z].all():
            bounds = np.append(own.starts[a:z], at + len(line))
            kept = [data[bounds[i] : bounds[i + 1]] for i in range(z - a) if not gone[a + i]]
            out.append((data[at : bounds[0]] + b"".join(kept)).rstrip(b" \t\r\x0b\x0c") if gone[z - 1] else data[at : bounds[0]] + b"".join(kept))
        at += len(line) + 1
    return b"\n".join(out).decode("utf-8", "surrogatepass")


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", num: int = 80, den: int = 100, recall: float = 0.95
) -> DataFrame:
    """``(id, key, removed, repeats_of)`` for documents with something to
    remove: key is the hash of the text, removed an array of word ranges
    (from_word, to_word), repeats_of the ids of the documents where the
    removed passages stay.

    Rows equal in id and text count as one; null and wordless texts have
    nothing to remove; an empty table gives an empty result."""
    prepare(docs.sparkSession)
    bands, width = tuned_bands(num / den, recall)
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_key(text).alias("key"), text.alias("text"))
    described = written(
        rows.mapInArrow(
            _describe(bands, width),
            "id long, key long, anchors array<long>, para array<long>,"
            " para_from array<long>, para_to array<long>, bands array<long>",
        ),
        "paragraphs",
    )
    near = near_paragraphs(rows, described, num, den)
    release(docs.sparkSession)
    paragraphs = written(repeated_paragraphs(described, near), "paragraph-marks")
    wanted = shared_anchors(described)
    erase(described)
    marks = [_of_document(paragraphs, "marks", "from", "to", "of"), *repeated_runs(rows, wanted, paragraphs)]
    erase(wanted)
    together = reduce(DataFrame.union, marks).groupBy("id", "key").agg(F.flatten(F.collect_list("marks")).alias("marks"))
    spans = together.mapInArrow(
        _spans, "id long, key long, removed array<struct<from_word: bigint, to_word: bigint>>, repeats_of array<long>"
    )
    return spans


def dedup_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """All rows and columns of ``docs``, whatever their names; the text without
    its repeated words."""
    spans = repeated_spans(docs, id_col, text_col, **options).select("id", "key", "removed")
    own = lambda c: F.col("row").getField(c)
    text = own(text_col).cast("string")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.select("row", own(id_col).cast("long").alias("id"), text_key(text).alias("key"))
    cut = F.pandas_udf(_cut, "string")(text, F.to_json("removed"))
    return _beside(rows, spans, "left").select(*[(cut if c == text_col else own(c)).alias(c) for c in docs.columns])


def _cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series(
        [
            t if t is None or s is None else without_words(t, [(x["from_word"], x["to_word"]) for x in json.loads(s)])
            for t, s in zip(texts, spans)
        ],
        dtype=object,
    )
