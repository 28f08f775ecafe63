"""Ranked search against plain scoring of every document."""

from __future__ import annotations

import math
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sheetcraft.llm import lexical_search as ls
from sheetcraft.llm.queries import ORACLE_SQL, op11_lexical_search
from tests.llm.cases import SCHEMA, awkward_documents, fold, sentence

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_search(docs, items, k):
    found = [(i, TERM.findall(fold(t))) for i, t in docs]
    found = [(i, t) for i, t in found if t]
    total = sum(len(t) for _, t in found)
    counts = [{w: t.count(w) for w in set(t)} if len(t) < 3000 else _counts(t) for _, t in found]
    df = {}
    for c in counts:
        for w in c:
            df[w] = df.get(w, 0) + 1
    out = []
    for item, text in set(items):
        rows = []
        for (i, t), c in zip(found, counts):
            m = 50 + (50 * len(t) * len(found)) // total
            score = 0
            for w in set(TERM.findall(fold(text))):
                if w in c:
                    weight = math.floor(1000 * math.log((2 * len(found) + 2) / (2 * df[w] + 1)))
                    score += weight * ((1000000000 * c[w]) // (1000 * c[w] + 20 * m))
            if score > 0:
                rows.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(rows, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


def _counts(words):
    out = {}
    for w in words:
        out[w] = out.get(w, 0) + 1
    return out


def test_terms():
    rng = random.Random(1)
    texts = ["".join(rng.choices("aB9 -_é\u0130\u212a\x7f\x80\n.\u4e00", k=rng.randint(0, 40))) for _ in range(500)]
    found, counts = ls.terms_of([t.encode() for t in texts])
    plain = [TERM.findall(fold(t)) for t in texts]
    assert counts.tolist() == [len(x) for x in plain]
    names = {}
    for h, w in zip(found.tolist(), (w for x in plain for w in x)):
        assert names.setdefault(w, h) == h
    assert len(set(names.values())) == len(names)


@pytest.mark.parametrize(("cells", "short", "k"), [(1 << 22, 64, 50), (3000, 4, 5), (20000, 2, 3)])
def test_search_equals_plain(spark, monkeypatch, cells, short, k):
    rng = random.Random(cells + k)
    vocabulary = [sentence(rng, "etaoinshé", 1) for _ in range(60)]
    rows = [(i, " ".join(rng.choices(vocabulary, weights=range(1, 61), k=rng.randint(1, 60)))) for i in range(700)]
    rows += [(r[0], r[1]) for r in awkward_documents()] + [(None, rows[0][1]), rows[1], rows[1], (9000, rows[2][1])]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 12))).upper()) for i in range(40)]
    items += [(90, None), (91, " .!"), (92, "unheard"), (0, rows[3][1]), items[5], (None, "ETA " + vocabulary[0])]

    def searched(*args, own=ls._searched):  # workers import the module anew
        run = own(*args)

        def small(batches):
            import sheetcraft.llm.lexical_search as there

            there.CHUNK_CELLS, there.SHORT_LIST, there.BLOCK_DOCS = cells, short, 8
            return run(batches)

        return small

    monkeypatch.setattr(ls, "_searched", searched)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"n": F.lit("x"), "terms": F.lit(1)}).repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit(1))
    got = sorted((tuple(r) for r in ls.lexical_search(docs, asked, k=k).collect()), key=str)
    assert got == plain_search(rows, [x for x in items if x[1]], k)


def test_blocks_are_skipped_only_below_the_bound():
    rng = np.random.default_rng(3)
    scores = np.where(rng.random((900, 30)) < 0.4, rng.integers(1, 1000, (900, 30)), 0).astype(float)
    chunk = ls.Chunk(scores)
    assert sorted(np.concatenate([chunk.blocks[b] for b in np.flatnonzero(chunk.term_of == 0)]).tolist()) == np.flatnonzero(scores[:, 0]).tolist()
    for b, own in enumerate(chunk.blocks):
        assert (chunk.summaries[b] == scores[own].max(axis=0)).all()
    skipped = 0
    for _ in range(50):
        terms = rng.choice(30, 5, replace=False)
        whole = scores[:, terms].sum(axis=1)
        least = np.sort(whole)[-20]
        visits = chunk.candidates(terms, chunk.summaries[:, terms].sum(axis=1), least, 10)
        found = next(visits)
        found = np.union1d(found, visits.send(least))
        assert set(np.flatnonzero(whole >= least)) <= set(found.tolist())
        skipped += len(found) < (whole > 0).sum()
    assert skipped > 25


def test_slices_and_nothing_to_search(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b"), (2, "b c")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a"), (2, "b c"), (3, "c")], "item_id long, text string")
    whole = sorted(map(tuple, ls.lexical_search(docs, items).collect()))
    monkeypatch.setattr(ls, "SLICE_TERMS", 1)
    assert sorted(map(tuple, ls.lexical_search(docs, items).collect())) == whole != []
    empty = spark.createDataFrame([], SCHEMA)
    assert ls.lexical_search(empty, items).count() == 0
    assert ls.lexical_search(docs, empty, item_col="root").count() == 0


def test_query_and_sql(spark):
    folder = "/root/testdata/sf0.001"
    got = sorted(map(tuple, op11_lexical_search(spark, folder).collect()))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    assert sorted(con.execute(ORACLE_SQL["op11_lexical_search"]).fetchall()) == got
