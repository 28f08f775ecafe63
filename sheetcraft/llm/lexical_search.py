"""Operator 11: ranked lexical search with geometric blocking of postings.

A first pass over the documents counts terms: of each document the number of
its terms, and how often it holds terms that some item asks for.  Document
frequencies come from these rows by an aggregate, and give the weights.

A second pass searches.  Each task takes its documents in chunks and builds,
for each chunk and term, blocks of the posting list: documents of a list are
put to the most similar of some representatives of that list (cosine of random
projections of their term scores), so a block holds documents alike.  A block
stores the coordinatewise maximum of their scores, so the sum over an item's
terms bounds the score of all its documents.  Blocks are visited in descending
order of that bound, and skipped only if it is below the k-th best score that
the task knows for the item; everything is in integers, so bounds are exact.  A
document that may still be among the best is in a visited block of each of
its terms, so an item's blocks are those of a set of its terms that no such
document can do without (the other terms together stay below the k-th score).
Short lists are one block without a summary and are always scored.

Scores of at most k documents an item leave a task; they are ranked in two
steps, so no item's candidates meet in one task unreduced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheetcraft.llm.common import EXACT, joined, keyed_text, prepare, text_groups, word_hashes, written

BLOCK_DOCS = 48  # documents of a block, on average
SHORT_LIST = 64  # documents up to which a list is one block without summary
CHUNK_CELLS = 1 << 22  # cells (documents x terms) of a chunk
SLICE_TERMS = 1 << 18  # terms of the items that are searched in one pass
DIMENSIONS = 16
SALTS = 64

# Separators become blanks and A-Z become a-z; all else is part of a term.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = [c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(128)]


def terms_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms of the texts, and how many each text has."""
    data, offsets = joined(texts)
    found, starts, _ = word_hashes(_FOLD.take(data), EXACT)
    return found, np.diff(np.searchsorted(starts, offsets))


def _item_terms(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for positions, group in text_groups(range(batch.num_rows), batch.column(1).to_pylist()):
            found, counts = terms_of(group)
            sets = [np.unique(x).view(np.int64) for x in np.split(found, np.cumsum(counts)[:-1])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(positions)), pa.array(sets, pa.list_(pa.int64()))], ["item", "terms"]
            )


def _counted(vocabulary: np.ndarray):
    """Rows ``(doc, n, terms, counts)``: places in the sorted vocabulary."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for positions, group in text_groups(range(batch.num_rows), batch.column(1).to_pylist()):
                found, counts = terms_of(group)
                found = found.view(np.int64)
                at = np.minimum(np.searchsorted(vocabulary, found), len(vocabulary) - 1)
                hit = vocabulary[at] == found
                doc = np.repeat(np.arange(len(group)), counts)[hit]
                pairs, times = np.unique(doc * len(vocabulary) + at[hit], return_counts=True)
                cuts = np.searchsorted(pairs, np.arange(len(group) + 1) * len(vocabulary))
                lists = lambda x: pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(x, pa.int32()))
                columns = [
                    batch.column(0).take(pa.array(positions)),
                    pa.array(counts, pa.int64()),
                    lists(pairs % len(vocabulary)),
                    lists(times),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc", "n", "terms", "counts"])

    return run


class Chunk:
    """Documents of a task with their scores a term (documents x terms, as
    whole numbers in float64), and the blocks of their posting lists."""

    def __init__(self, scores: np.ndarray):
        self.scores = scores
        docs, terms = scores.shape
        norms = np.sqrt((scores**2).sum(axis=1))
        signs = np.random.default_rng(11).choice([-1.0, 1.0], size=(terms, DIMENSIONS))
        spots = (scores @ signs) / np.maximum(norms, 1.0)[:, None]
        spots /= np.maximum(np.sqrt((spots**2).sum(axis=1)), 1e-9)[:, None]
        held = scores > 0
        sizes = held.sum(axis=0)
        term, doc = np.nonzero(held.T)
        self.lists = np.split(doc, np.cumsum(sizes)[:-1])
        self.short = sizes <= SHORT_LIST
        blocks, of, summaries = [], [], []
        for t in np.flatnonzero(~self.short):
            own = self.lists[t]
            centres = own[:: BLOCK_DOCS]
            nearest = (spots[own] @ spots[centres].T).argmax(axis=1)
            order = np.argsort(nearest, kind="stable")
            own, nearest = own[order], nearest[order]
            first = np.flatnonzero(np.diff(nearest, prepend=-1))
            blocks += np.split(own, first[1:])
            of += [t] * len(first)
            summaries.append(np.maximum.reduceat(scores[own], first, axis=0))
        self.blocks, self.term_of = blocks, np.array(of, dtype=np.int64)
        self.summaries = np.concatenate(summaries) if summaries else np.empty((0, terms))
        self.best = scores.max(axis=0, initial=0.0)

    def essential(self, terms: np.ndarray, least: float) -> np.ndarray:
        """Terms without which no document scores ``least``: those that
        remain when the terms of the smallest maxima, together below it, go."""
        order = terms[np.argsort(self.best[terms], kind="stable")]
        return order[np.cumsum(self.best[order]) >= max(least, 1.0)]

    def candidates(self, terms: np.ndarray, bounds: np.ndarray, least: float, k: int) -> Iterator[np.ndarray]:
        """Documents to score: first the blocks of the highest bounds, then,
        with a new ``least`` sent in, all blocks that it does not exclude."""
        use = self.essential(terms, least)
        docs = [self.lists[t] for t in use if self.short[t]]
        mine = np.flatnonzero(np.isin(self.term_of, use) & (bounds >= max(least, 1.0)))
        mine = mine[np.argsort(-bounds[mine], kind="stable")]
        head = max(1, 2 * k // BLOCK_DOCS)
        docs += [self.blocks[b] for b in mine[:head]]
        least = yield np.unique(np.concatenate(docs)) if docs else np.empty(0, dtype=np.int64)
        again = self.essential(terms, least)
        rest = mine[head:]
        rest = rest[(bounds[rest] >= least) & np.isin(self.term_of[rest], again)]
        yield np.unique(np.concatenate([self.blocks[b] for b in rest])) if len(rest) else np.empty(0, dtype=np.int64)


def _impacts(n: np.ndarray, counts: np.ndarray, total_docs: int, total_terms: int) -> np.ndarray:
    """What a term that occurs ``counts`` times in a document of ``n`` terms
    adds to its score, a unit of weight."""
    m = 100 - 50 + (50 * n * total_docs) // total_terms
    return (1_000_000_000 * counts) // (1000 * counts + 20 * m)


def _searched(items: list[np.ndarray], weights: np.ndarray, total_docs: int, total_terms: int, k: int):
    """The k best documents of a task for each item (places of its terms)."""
    wide = len(weights)
    asked = np.zeros((wide, len(items)))
    for i, terms in enumerate(items):
        asked[terms, i] = 1.0

    def run(batches) -> Iterator[pa.RecordBatch]:
        best: list[tuple[np.ndarray, list]] = [(np.empty(0), [])] * len(items)
        for docs, scores in _chunks(batches, weights, wide, total_docs, total_terms):
            chunk = Chunk(scores)
            bounds = chunk.summaries @ asked
            for i, terms in enumerate(items):
                best[i] = _best_of(chunk, terms, bounds[:, i], docs, best[i], k)
        for i, (scores, docs) in enumerate(best):
            if len(scores):
                columns = [pa.array(np.full(len(docs), i)), pa.array(docs, pa.int64()), pa.array(scores.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["place", "doc_id", "score"])

    return run


def _best_of(chunk: Chunk, terms: np.ndarray, bounds: np.ndarray, docs: list, best: tuple, k: int) -> tuple:
    scores, ids = best
    visits = chunk.candidates(terms, bounds, scores[-1] if len(scores) == k else 0.0, k)
    rows, seen = next(visits), np.empty(0, dtype=np.int64)
    for last in (False, True):
        rows = np.setdiff1d(rows, seen, assume_unique=True)
        seen = rows
        if len(rows):
            found = chunk.scores[np.ix_(rows, terms)].sum(axis=1)
            keep = found >= max(scores[-1] if len(scores) == k else 0.0, 1.0)
            scores, ids = np.concatenate((scores, found[keep])), ids + [docs[r] for r in rows[keep]]
            # Largest score first, smallest id among equals, null ids last.
            order = sorted(range(len(ids)), key=lambda j: (-scores[j], ids[j] is None, ids[j] or 0))[:k]
            scores, ids = scores[order], [ids[j] for j in order]
        if not last:
            rows = visits.send(scores[-1] if len(scores) == k else 0.0)
    return scores, ids


def _chunks(batches, weights: np.ndarray, wide: int, total_docs: int, total_terms: int):
    size = max(16, CHUNK_CELLS // wide)
    held: list[pa.RecordBatch] = []
    rows = 0

    def made():
        table = pa.Table.from_batches(held).combine_chunks()
        lists = table.column("terms").combine_chunks()
        term, count = lists.flatten().to_numpy(), table.column("counts").combine_chunks().flatten().to_numpy().astype(np.int64)
        per_doc = lists.value_lengths().to_numpy()
        n = np.repeat(table.column("n").to_numpy(), per_doc)
        scores = np.zeros((table.num_rows, wide))
        scores[np.repeat(np.arange(table.num_rows), per_doc), term] = weights[term] * _impacts(n, count, total_docs, total_terms)
        return table.column("doc").to_pylist(), scores

    for batch in batches:
        for at in range(0, batch.num_rows, size):
            part = batch.slice(at, size)
            if rows and rows + part.num_rows > size:
                yield made()
                held, rows = [], 0
            held.append(part)
            rows += part.num_rows
    if rows:
        yield made()


def _slices(items: DataFrame) -> Iterator[list]:
    """Items in groups with a bounded number of terms, read one after another."""
    group, size = [], 0
    for row in items.toLocalIterator():
        if group and size + len(row["terms"]) > SLICE_TERMS:
            yield group
            group, size = [], 0
        group.append(row)
        size += len(row["terms"])
    if group:
        yield group


def lexical_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: for each item the ``k`` documents of
    the highest score above 0, equal scores by ascending doc_id (null last).

    A null, empty or wordless text has no terms: such a document is not
    counted, such an item has no row.  Every document row is a document, so
    repeated rows and rows without an id are ranked too; items equal in id and
    text count as one, others of one id are ranked each on its own.  Texts of
    any length are searched whole; only the named columns are read; without
    documents or items the result is empty.
    """
    spark = docs.sparkSession
    prepare(spark)
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    own = keyed_text(items, item_col, item_text_col).dropDuplicates()
    asked = written(own.mapInArrow(_item_terms, "item long, terms array<long>").where("size(terms) > 0"), "items")
    for group in _slices(asked):
        out = out.unionByName(_search_slice(docs, group, k, id_col, text_col))
    return out


def _search_slice(docs: DataFrame, group: list, k: int, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    terms = [np.array(row["terms"], dtype=np.int64) for row in group]
    vocabulary = np.unique(np.concatenate(terms))
    places = [np.searchsorted(vocabulary, x) for x in terms]
    counted = keyed_text(docs, id_col, text_col).mapInArrow(_counted(vocabulary), "doc long, n long, terms array<int>, counts array<int>")
    counted = written(counted.where("n > 0"), "document-terms")
    total_docs, total_terms = counted.agg(F.count(F.lit(1)), F.sum("n")).first()
    ids = spark.createDataFrame(pa.table({"place": pa.array(range(len(group)), pa.int64()), "item_id": pa.array([r["item"] for r in group], pa.int64())}))
    frequency = np.zeros(len(vocabulary))
    # At most a row a term of the slice.
    for row in counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        frequency[row["t"]] = row["count"]
    weights = np.floor(1000 * np.log((2 * total_docs + 2) / (2 * frequency + 1)))
    rows = counted.where("size(terms) > 0").mapInArrow(
        _searched(places, weights.astype(np.int64), total_docs, total_terms or 1, k), "place long, doc_id long, score long"
    )
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS)))
    some = salted.withColumn("r", F.row_number().over(Window.partitionBy("place", "salt").orderBy(*order))).where(F.col("r") <= k)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("place").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.join(F.broadcast(ids), "place").select("item_id", "rank", "doc_id", "score")
