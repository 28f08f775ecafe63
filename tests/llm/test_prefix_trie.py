"""The prefix trie of conversations against a plain one."""

from __future__ import annotations

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sheetcraft.llm import prefix_trie as pt
from sheetcraft.llm.queries import ORACLE_SQL, op13_prefix_trie
from tests.llm.cases import words

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_trie(rows, rebuild=True):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4 if rebuild else 0
        built[c] = tuple(own.get(c - c % 20, [])[:h] + own[c][h:])
    nodes = {}
    for c, path in built.items():
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append(c)
    out = []
    kids = {}
    for p in nodes:
        if p:
            kids[p[:-1]] = kids.get(p[:-1], 0) + 1
    leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for p, members in nodes.items():
        s = (len(members) - 1) * len(words(p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += s
            leaves[p[:d]] += p not in kids
    for p, members in nodes.items():
        ends = ",".join(map(str, sorted(c for c in members if len(built[c]) == len(p))))
        parent = min(nodes[p[:-1]]) if p else None
        out.append((min(members), len(p), parent, len(members), kids.get(p, 0), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def some_conversations(seed, convs=120, deep=9):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(400), convs):
        for turn in range(rng.choice([1, 2, 3, 5, deep])):
            rows.append((c, rng.choice([turn, turn, turn, None, 3]), rng.choice(["user", "bot", None]), rng.choice(["a b", "c", "", None, "d e\nf"])))
    rows += [(None, 1, "user", "lost"), rows[0], rows[0], (500, 0, "user", "x " * 30_000)]
    rows += [(600 + i, t, "user", "same again") for i in range(60) for t in range(4)]
    return rows


def found(df):
    return sorted((tuple(r[n] for n in NAMES) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", range(12))
def test_find_close(seed):
    rng = random.Random(seed)
    bits, depth = [], 0
    for _ in range(rng.choice([1, 5, 200, 3000, 9000])):
        if depth and rng.random() < rng.choice([0.1, 0.5, 0.6]):
            bits.append(0)
            depth -= 1
        else:
            bits.append(1)
            depth += 1
    bits += [0] * depth
    stack, close = [], {}
    for i, b in enumerate(bits):
        if b:
            stack.append(i)
        else:
            close[stack.pop()] = i
    opens = np.flatnonzero(bits)
    own = pt.Parentheses(np.array(bits, dtype=np.uint8))
    assert own.find_close(opens).tolist() == [close[i] for i in opens.tolist()]
    assert own.rank(opens).tolist() == list(range(len(opens)))


@pytest.mark.parametrize(("level", "block"), [(1024, 1 << 19), (1024, 20), (3, 25), (1, 7)])
def test_trie_equals_plain(spark, monkeypatch, level, block):
    rows = some_conversations(level + block)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumns({"conv": F.lit("x"), "level": F.lit(1), "p": F.lit(2)})
    conv = F.col("conv")

    def shards(batches):  # workers import the module anew
        import sheetcraft.llm.prefix_trie as own

        own.BLOCK_TURNS = block
        return own._shards(batches)

    monkeypatch.setattr(pt, "_shards", shards)
    got = found(pt.prefix_trie(docs, F.crc32(conv.cast("string")) % 4, conv - conv % 20, level_turns=level))
    assert got == plain_trie(rows)


def test_plain_conversations_and_long_ones(spark):
    rows = [(c, t, "u", f"t{t if c != 2 or t < 120 else -t} x") for c, n in ((1, 150), (2, 200), (3, 64), (4, 2), (5, 150)) for t in range(n)]
    assert found(pt.prefix_trie(spark.createDataFrame(rows, SCHEMA), level_turns=32)) == plain_trie(rows, rebuild=False)


def test_no_conversation(spark):
    assert pt.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert pt.prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).count() == 0


def test_query_and_sql(spark):
    folder = "/root/testdata/sf0.001"
    got = found(op13_prefix_trie(spark, folder))
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got == plain_trie(rows)
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{folder}/conversations.parquet'")
    assert sorted(con.execute(f"select {', '.join(NAMES)} from ({ORACLE_SQL['op13_prefix_trie']})").fetchall(), key=str) == got
