"""Operator 1: language identification by cross-parsing entropy.

For each language a suffix automaton is built of a bounded sample of labelled
text.  A text is parsed greedily against it: each phrase is the longest run of
symbols that occurs in the sample.  The fewer phrases a language needs per
symbol, the closer the text is to it; the language that needs fewest wins.

Symbols: letters, lower-cased, one each (rare letters share a few symbols,
unseen ones match nowhere), and one symbol for any run of other characters.
Texts are parsed in rows of ``ROW`` symbols (a phrase ends with its row), all
rows of a batch in step, so long and short texts cost the same per symbol.
The automaton becomes a dense table whose entries hold the next state and
whether a phrase ended.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheetcraft.llm.common import keyed_text, once_a_worker, prepare
from sheetcraft.llm.pieces import LETTER, char_classes, text_runs

ROW = 256
SYMBOLS = 64  # of a table row: gap, unseen letter, letters, padding
GAP, UNSEEN, FIRST, LAST, PADDING = 0, 1, 2, SYMBOLS - 2, SYMBOLS - 1
ENDED = 1 << 30  # a phrase ended on the way to this state
UNDETERMINED = "und"
TABLES = 40  # parse tables held at a time


def suffix_automaton(symbols: list[int]) -> np.ndarray:
    """Transitions (states x symbols, -1 for none) of the smallest automaton
    of all factors of a sequence."""
    step = np.full((max(2, 2 * len(symbols)), SYMBOLS), -1, dtype=np.int32)
    link, length, last = [-1], [0], 0
    for c in symbols:
        new = len(link)
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and step[p, c] < 0:
            step[p, c] = new
            p = link[p]
        if p >= 0:
            q = int(step[p, c])
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(link)
                step[copy] = step[q]
                link.append(link[q])
                length.append(length[p] + 1)
                link[q] = link[new] = copy
                while p >= 0 and step[p, c] == q:
                    step[p, c] = copy
                    p = link[p]
        last = new
    return step[: len(link)].copy()


def parse_table(symbols: list[int]) -> np.ndarray:
    """``table[state * SYMBOLS + symbol]``: next state * SYMBOLS, plus ENDED
    where the phrase cannot go on and the symbol starts a new one."""
    table = suffix_automaton(symbols)
    none = table < 0
    table *= SYMBOLS
    restart = np.where(none[0], 0, table[0]) | ENDED
    np.copyto(table, restart[None, :], where=none)
    table[:, PADDING] = 0
    return table.ravel()


class LanguageModel:
    """Parse tables of the languages of a labelled sample."""

    def __init__(self, sample: list[tuple[str, str]], chars: int):
        texts: dict[str, list[str]] = {}
        for lang, text in sample:
            texts.setdefault(lang, []).append(text.lower())
        self.languages = sorted(texts)
        seen = Counter(c for own in texts.values() for text in own for c in text)
        table = np.where(char_classes() == LETTER, UNSEEN, GAP).astype(np.uint8)
        letters = sorted((c for c in seen if table[ord(c)] == UNSEEN), key=lambda c: (-seen[c], c))
        alone = LAST - FIRST - 8
        for i, c in enumerate(letters):
            table[ord(c)] = FIRST + (i if i < alone else alone + ord(c) % 9)
        self.symbols = table
        self.samples = []
        for lang in self.languages:
            own = np.concatenate([self.row_symbols(x)[0] for x in ([t] for t in texts[lang])])
            self.samples.append(own[:chars].copy())
        self.held: tuple[int, list[np.ndarray]] = (-1, [])

    def tables(self, first: int) -> list[np.ndarray]:
        """Parse tables of the TABLES languages from ``first`` on; those asked
        for last are kept."""
        if self.held[0] != first:
            self.held = (-1, [])
            self.held = (first, [parse_table(x.tolist()) for x in self.samples[first : first + TABLES]])
        return self.held[1]

    def row_symbols(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of the texts one after another, runs of gaps made one and
        none at a start, and how many each text has."""
        lowered = [t.lower() for t in texts]
        codes = np.frombuffer("".join(lowered).encode("utf-32-le"), dtype=np.uint32)
        symbols = self.symbols.take(codes)
        ends = np.cumsum([len(t) for t in lowered], dtype=np.int64)
        keep = symbols != GAP
        keep[1:] |= symbols[:-1] != GAP
        keep[(ends - [len(t) for t in lowered])[[len(t) > 0 for t in lowered]]] = True
        first_gap = np.zeros(len(symbols), dtype=bool)
        first_gap[(ends - [len(t) for t in lowered])[[len(t) > 0 for t in lowered]]] = True
        keep &= ~(first_gap & (symbols == GAP))
        kept = np.concatenate(([0], np.cumsum(keep)))
        at = kept[np.concatenate(([0], ends))]
        return symbols[keep], np.diff(at)

    def phrases(self, groups: list[list[str]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each group of texts: phrases by text and language, and whether
        a text has letters.  All groups are parsed by some tables before the next."""
        grids = [self.grid(texts) for texts in groups]
        counts = [np.zeros((len(texts), len(self.languages)), dtype=np.int64) for texts in groups]
        for first in range(0, len(self.languages), TABLES):
            tables = self.tables(first)
            for (grid, some, row_first, rows, _), own in zip(grids, counts):
                for k, table in enumerate(tables, first):
                    state = np.zeros(grid.shape[1], dtype=np.int32)
                    ended = np.zeros(grid.shape[1], dtype=np.int32)
                    for column in grid:
                        state += column
                        state = table.take(state)
                        ended += state >> 30
                        state &= ENDED - 1
                    if len(some):
                        own[some, k] = np.add.reduceat(ended, row_first[some]) + rows[some]
        return [(own, lettered) for own, (*_, lettered) in zip(counts, grids)]

    def grid(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        """Symbols in columns of ROW, the texts with any, the first column and
        the number of columns of each text, and whether it has letters."""
        symbols, sizes = self.row_symbols(texts)
        rows = -(-sizes // ROW)
        row_first = np.cumsum(rows) - rows
        first = np.cumsum(sizes) - sizes
        grid = np.full(int(rows.sum()) * ROW, PADDING, dtype=np.uint8)
        grid[np.arange(len(symbols)) + np.repeat(row_first * ROW - first, sizes)] = symbols
        grid = np.ascontiguousarray(grid.reshape(int(rows.sum()), ROW).T).astype(np.int32)
        some = np.flatnonzero(rows)
        lettered = np.zeros(len(texts), dtype=bool)
        if len(some):
            lettered[some] = np.logical_or.reduceat(symbols != GAP, first[some])
        return grid, some, row_first, rows, lettered

    def predict(self, groups: list[list[str]]) -> list[tuple[list[str], list[float], list[bool]]]:
        """Language, score and whether it has letters of each text, by group."""
        return [self.best(counts, lettered) for counts, lettered in self.phrases(groups)]

    def best(self, counts: np.ndarray, lettered: np.ndarray) -> tuple[list[str], list[float], list[bool]]:
        """Language and score from the phrases of each text.  The score is the share of phrases
        saved against the second-best language; with equal counts the first
        language in alphabetical order wins, at 0."""
        langs, scores = [], []
        for own, ok in zip(counts.tolist(), lettered.tolist()):
            if not ok or not own:
                langs.append(UNDETERMINED)
                scores.append(0.0)
                continue
            best = min(range(len(own)), key=own.__getitem__)
            others = own[:best] + own[best + 1 :]
            langs.append(self.languages[best])
            scores.append(1.0 - own[best] / min(others) if others else 1.0)
        return langs, scores, lettered.tolist()


def _model(sample: list[tuple[str, str]], chars: int) -> LanguageModel:
    key = ("language", zlib.crc32(repr(sample).encode("utf-8", "surrogatepass")), chars)
    return once_a_worker(key, lambda: LanguageModel(sample, chars))


def labelled_sample(
    docs: DataFrame, learn: Column, id_col: str, text_col: str, lang_col: str, docs_per_lang: int, chars: int
) -> list[tuple[str, str]]:
    """At most ``docs_per_lang`` rows of each label: those of the smallest id
    hash, cut at ``chars``."""
    rows = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rank = F.row_number().over(Window.partitionBy(lang_col).orderBy(F.xxhash64(id_col), id_col))
    chosen = rows.select(id_col, lang_col).withColumn("rank", rank).where(F.col("rank") <= docs_per_lang)
    chosen = chosen.select(F.col(id_col).alias("chosen"), F.col(lang_col).alias("language"))
    found = (
        rows.join(F.broadcast(chosen), (F.col(id_col) == F.col("chosen")) & (F.col(lang_col) == F.col("language")))
        .groupBy("language", F.xxhash64("chosen").alias("order"), "chosen")  # repeated ids count once
        .agg(F.min(F.substring(text_col, 1, chars)).alias("excerpt"))
        .collect()  # languages * docs_per_lang excerpts at most
    )
    return [(r["language"], r["excerpt"]) for r in sorted(found, key=lambda r: (r["language"], r["order"], r["excerpt"]))]


def identify_languages(
    docs: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    **options,
) -> DataFrame:
    """``(id_col, lang_pred, score)``, a row a document row; options and
    behaviour as in ``identify_documents``."""
    rows = keyed_text(docs.withColumn(lang_col, F.when(learn, F.col(lang_col))), id_col, text_col, lang_col)
    found = identify_documents(rows, F.lit(True), id_col, text_col, lang_col, carry=[id_col], **options)
    return found.select(id_col, "lang_pred", "score")


def identify_documents(
    docs: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    carry: list[str] | None = None,
    docs_per_lang: int = 30,
    sample_chars: int = 12_000,
    lettered: str | None = None,
) -> DataFrame:
    """The ``carry`` columns (all by default, but for those named lang_pred or
    score) with lang_pred and score, a row a document row, in one pass.

    The model is learnt from rows where ``learn`` holds and the label is not
    null, from at most ``docs_per_lang`` rows and ``sample_chars`` symbols of
    each label; ``lettered`` names a column to add that holds whether the text
    has a letter.  A null text, one without
    a letter, and any text when there is no labelled row give ``und`` and 0.
    Repeated rows keep their rows; columns not carried are not read."""
    prepare(docs.sparkSession)
    per_doc = math.ceil(4 * sample_chars / docs_per_lang)
    sample = labelled_sample(docs, learn, id_col, text_col, lang_col, docs_per_lang, per_doc)
    carry = [c for c in docs.columns if c not in ("lang_pred", "score")] if carry is None else carry
    names = [f"c{i}" for i in range(len(carry))]
    rows = docs.select(F.col(text_col).cast("string").alias("text"), *(F.col(f"`{c}`").alias(n) for c, n in zip(carry, names)))
    fields = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in rows.schema.fields[1:])

    def run(batches):
        model = _model(sample, sample_chars)
        for batch in batches:
            groups = list(text_runs(batch.column(0).to_pylist()))
            for (positions, _), found in zip(groups, model.predict([group for _, group in groups])):
                own = batch.take(pa.array(positions))
                kinds = (pa.string(), pa.float64(), pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [*own.columns[1:], *(pa.array(x, kind) for x, kind in zip(found, kinds))],
                    [*names, "lang_pred", "score", "lettered"],
                )

    found = rows.mapInArrow(run, fields + "lang_pred string, score double, lettered boolean")
    added = ["lang_pred", "score", lettered or "lettered"]
    return found.toDF(*carry, *added) if lettered else found.drop("lettered").toDF(*carry, *added[:2])


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept from training: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
