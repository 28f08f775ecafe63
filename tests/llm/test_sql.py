"""The SQL texts of operators 3 and 9 on planted rows: links, copies, hostile rows."""

import random

import duckdb
import pyarrow as pa
import pytest

from sheetcraft.llm.embed_dedup import embedding_components
from sheetcraft.llm.ngram_join import jaccard_components
from sheetcraft.llm.sql import OP3_SQL, OP9_SQL


def _answers(table: str, rows: pa.Table, sql: str) -> list[tuple]:
    con = duckdb.connect()
    con.register(table, rows)
    return sorted(con.sql(sql).fetchall(), key=repr)


def test_set_components_equal_sql(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    texts = [None, "", " \t", "One", "one", "one two", "One  two", "ONE two three", "é Ä x", "é ä x"]
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(30, 200))]
        texts.append(" ".join(base))
        for _ in range(3):  # chains of near copies, some below the threshold
            base = list(base)
            base[rng.randrange(len(base))] = "new"
            texts += [" ".join(base), "\n".join(base).upper()]
    ids = rng.sample(range(1000), len(texts))
    rows = list(zip(ids, texts)) + [(ids[12], texts[12]), (None, texts[14]), (None, "alone here and now")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    table = pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string())})
    want = _answers("documents", table, OP3_SQL)
    got = sorted([tuple(r) for r in jaccard_components(df).collect()], key=repr)
    assert got == want
    assert sum(i != c for i, _, c in want) > 20 and any(n == 0 for _, n, _ in want)


@pytest.mark.parametrize("size", [16, 64])
def test_vector_components_equal_sql(spark, size):
    rng = random.Random(size)
    vectors = [None, [], [0.0] * size, [1.0] * (size - 1) + [None], [float("nan")] * size, [float("inf")] * size, [1.0, 2.0]]
    for _ in range(15):
        base = [rng.gauss(0, 1) for _ in range(size)]
        vectors += [base, base, [x * 2 for x in base], [x + rng.gauss(0, 0.15) for x in base], [x + rng.gauss(0, 0.5) for x in base]]
    ids = rng.sample(range(1000), len(vectors))
    rows = [(i, v) for i, v in zip(ids, vectors)] + [(ids[8], vectors[8]), (None, vectors[9])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    table = pa.table({"vec_id": pa.array([r[0] for r in rows], pa.int64()), "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float32()))})
    want = _answers("embeddings", table, OP9_SQL)
    got = sorted([tuple(r) for r in embedding_components(df).collect()], key=repr)
    assert got == want
    assert sum(n for _, n, _, _ in want) > 60
