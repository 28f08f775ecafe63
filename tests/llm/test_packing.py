"""Packing of documents into sequences."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sheetcraft.llm import packing, pieces
from tests.llm.cases import SCHEMA, awkward_documents

MODEL = public_tokenizers.path("byte_bpe_50k.json")


def plain_first_fit(sizes, capacity):
    bins, room = [], []
    for i, s in enumerate(sizes):
        at = next((b for b, r in enumerate(room) if r >= s), None)
        if at is None:
            bins.append([])
            room.append(capacity)
            at = len(bins) - 1
        bins[at].append(i)
        room[at] -= s
    return bins


@pytest.mark.parametrize("seed", range(8))
def test_tournament_equals_plain_first_fit(seed):
    rng = random.Random(seed)
    sizes = sorted((rng.randint(1, 63) for _ in range(rng.choice([0, 1, 2, 7, 100, 500]))), reverse=True)
    bins = packing.first_fit(sizes, 64)
    assert bins == plain_first_fit(sizes, 64)
    sequences = packing.close_gaps(bins, sizes, 64)
    lengths = [sum(z - a for _, a, z in s) for s in sequences]
    assert all(n & (n - 1) == 0 for n in lengths) and sum(n < 64 for n in lengths) <= 6
    seen = sorted(x for s in sequences for x in s)
    at = {}
    for i, a, z in seen:  # each id lies in exactly one piece
        assert a == at.get(i, 0) and z > a
        at[i] = z
    assert [at[i] for i in range(len(sizes))] == sizes


def test_encoder_equals_the_library():
    model = Tokenizer.from_file(MODEL)
    coder = packing.LibraryEncoder(open(MODEL).read())
    rng = random.Random(5)
    odd = ["࢏", "꟎", "一", "\U0001f600", "é", "İ", "\xa0", " ", "'s", "'", " ", "  ", "\n", "<|endoftext|>", "<|", "a", "B", "7", "_"]
    texts = ["".join(rng.choices(odd, k=rng.randint(0, 60))) for _ in range(2000)] + ["", "x" * 5000]
    assert [x.tolist() for x in coder.encode_all(texts)] == [x.ids for x in model.encode_batch(texts, add_special_tokens=False)]


def test_remembered_pieces_have_two_generations(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 10)
    coder = packing.LibraryEncoder(open(MODEL).read())
    texts = [f"w{i} the{i % 7}" for i in range(200)]
    again = [x.tolist() for at in range(0, 200, 4) for x in coder.encode_all(texts[at : at + 4])]
    assert again == [x.ids for x in coder.model.encode_batch(texts, add_special_tokens=False)]
    assert 0 < len(coder.young) <= 10 and 0 < len(coder.old) <= 10


def check_pieces(rows, texts, size):
    """Pieces of rows, grouped by document, against whole encodings."""
    model = Tokenizer.from_file(MODEL)
    wanted = sorted([*model.encode(t or "", add_special_tokens=False).ids, 0] for t in texts)
    docs, found = {}, []
    for r in rows:
        docs.setdefault(r["doc_id"], []).append(r)
    for own in docs.values():
        own.sort(key=lambda r: r["start"])
        # rows of one id: follow each document's pieces in turn
        while own:
            ids, at = [], 0
            while True:
                nxt = next((r for r in own if r["start"] == at and (not ids or r["doc_tokens"] == n)), None)
                if nxt is None:
                    break
                own.remove(nxt)
                n, part = nxt["doc_tokens"], nxt["ids"]
                ids += np.frombuffer(part, "<u4").tolist()
                at += nxt["length"]
                if at == n:
                    break
            assert at == n
            found.append(ids)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert 0 < at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    assert padding == 0
    return sorted(found), wanted


@pytest.mark.parametrize("group_ids", [2000, 1 << 22])
def test_pieces_hold_every_id_once(spark, group_ids):
    rows = awkward_documents()
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"start": F.lit("x"), "bin": F.lit(1), "salt": F.lit(2), "ids": F.lit("y")})
    distinct = [r for i, r in enumerate(rows) if r not in rows[:i]]
    out = packing.pack_documents(docs.dropDuplicates(), MODEL, group_ids=group_ids)
    found, wanted = check_pieces(out.collect(), [r[1] for r in distinct], 1024)
    assert found == wanted
    everything = packing.pack_documents(docs, MODEL, group_ids=group_ids)
    assert everything.agg(F.sum("length")).first()[0] == sum(len(packing.LibraryEncoder(open(MODEL).read()).encode_all([r[1] or ""])[0]) + 1 for r in rows)


def test_copies_are_spread_over_groups(spark):
    docs = spark.createDataFrame([(7, "the same text in every row")] * 3000, "doc_id long, text string")
    out = packing.pack_documents(docs, MODEL, group_ids=2000).collect()
    assert sum(r["length"] for r in out) == 3000 * out[0]["doc_tokens"]
    groups = {}
    for r in out:
        groups[r["sequence_id"] >> 32] = groups.get(r["sequence_id"] >> 32, 0) + r["length"]
    assert len(groups) >= 8 and max(groups.values()) < 4 * 2000


def test_no_documents(spark):
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA), MODEL).count() == 0


def test_query_digest(spark):
    from sheetcraft.llm.queries import op12_packing

    rows = op12_packing(spark, "/root/testdata/sf0.001").collect()
    model = Tokenizer.from_file(MODEL)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    coded = {i: [*model.encode(t or "", add_special_tokens=False).ids, 0] for i, t in texts.items()}
    total = {}
    for r in rows:
        part = coded[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] and r["doc_tokens"] == len(coded[r["doc_id"]])
        assert r["ids_crc32"] == zlib.crc32(np.array(part, dtype="<u4").tobytes())
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["length"]
    assert total == {i: len(x) for i, x in coded.items()}
