"""Word hashes, language, token ids, BPE, quality and mixing."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sheetcraft.llm import byte_bpe, classifier, common, lang_id, mixing, quality, token_ids
from sheetcraft.session import scratch_dir
from tests.llm.cases import SCHEMA, awkward_documents, sentence, words

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
MODEL = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward_documents(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("block", [5, 64, 1 << 16])
def test_word_hashes_do_not_depend_on_blocks(monkeypatch, block):
    rng = random.Random(block)
    text = "".join(rng.choice("ab  \ncé\t") for _ in range(3000)) + "x" * 300 + " y"
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    whole = common.word_hashes(data, common.EXACT)
    monkeypatch.setattr(common, "BLOCK", block)
    monkeypatch.setattr(common, "_POWERS", [])
    cut = common.word_hashes(data, common.EXACT)
    assert all((a == b).all() for a, b in zip(whole, cut))
    found = [bytes(data[a:z]).decode() for a, z in zip(cut[1], cut[2])]
    assert found == words(text)
    assert len(set(found)) == len(set(cut[0].tolist()))


def test_automaton_holds_all_factors():
    rng = random.Random(2)
    symbols = [rng.randint(2, 5) for _ in range(200)]
    table = lang_id.parse_table(symbols)
    for _ in range(300):
        query = [rng.randint(2, 5) for _ in range(30)]
        phrases, own = 1, []
        for c in query:  # greedy parse by search
            if any(symbols[i : i + len(own) + 1] == [*own, c] for i in range(len(symbols))):
                own.append(c)
            else:
                phrases, own = phrases + 1, [c]
        state, ended = 0, 1
        for c in query:
            step = int(table[state + c])
            ended += step >> 30
            state = step & (lang_id.ENDED - 1)
        assert ended == phrases


def test_language_held_out_accuracy_and_cases(spark):
    rng = random.Random(3)
    letters = {"aa": "etaoinsh", "bb": "ñíóaeuqr", "cc": "äöüschei"}
    rows = [(i, sentence(rng, letters[k], rng.randint(5, 80)), k) for i, k in enumerate(random.Random(4).choices(list(letters), k=400))]
    rows += [(900, None, "aa"), (901, "", "aa"), (902, "123 !?", "bb"), (903, rows[0][1], None), (0, rows[0][1], rows[0][2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("x"))
    found = lang_id.identify_languages(docs, ~lang_id.held_out()).collect()
    assert len(found) == len(rows)
    got = {r["doc_id"]: r for r in found}
    held = [(i, k) for i, _, k in rows[:400] if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 50 and np.mean([got[i]["lang_pred"] == k for i, k in held]) > 0.97
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (900, 901, 902))
    assert got[903]["lang_pred"] == got[0]["lang_pred"]
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_without_labels_or_rows(spark, docs, empty):
    assert lang_id.identify_languages(empty, F.lit(True)).count() == 0
    found = lang_id.identify_languages(docs, F.lit(False)).collect()
    assert len(found) == docs.count() and {r["lang_pred"] for r in found} == {"und"}


def test_every_language_is_learnt(spark):
    rng = random.Random(19)
    letters = {f"l{k:02}": "".join(rng.sample("abcdefghijklmnopqrstuvwxyz", 6)) for k in range(45)}
    rows = [(n, sentence(rng, own, 40), lang) for n, (lang, own) in enumerate([*letters.items()] * 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(2)
    found = {r["doc_id"]: r["lang_pred"] for r in lang_id.identify_languages(docs, F.col("doc_id") < 135).collect()}
    assert all(found[n] == lang for n, _, lang in rows[135:])


def test_token_ids_equal_the_library(spark, docs):
    folder = scratch_dir(spark, "t") + "/ids"
    files = token_ids.write_token_shards(docs, folder, MODEL, shards=3)
    found = token_ids.shard_digest(spark, folder, files).orderBy("start").collect()
    rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    model, start = Tokenizer.from_file(MODEL), 0
    assert len(found) == len(rows)
    for row, (doc_id, text) in zip(found, rows):
        ids = np.array([*model.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        assert tuple(row) == (doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


@pytest.mark.parametrize("text", ["'the same words'", "concat('words ', n)"])
def test_one_id_on_all_rows_fills_many_shards(spark, text):
    docs = spark.range(0, 4000, 1, 8).withColumnRenamed("id", "n").selectExpr("5L doc_id", f"{text} text")
    blocks = token_ids.token_blocks(docs, MODEL, 1, "doc_id", "text", 8).select("shard", F.size("doc_ids").alias("n")).collect()
    assert sum(r["n"] for r in blocks) == 4000 and max(r["n"] for r in blocks) < 1500


def test_token_ids_of_an_empty_table(spark, empty):
    folder = scratch_dir(spark, "t") + "/ids"
    assert token_ids.write_token_shards(empty, folder, MODEL, shards=2) == 0
    assert token_ids.shard_digest(spark, folder, 0).count() == 0


def test_pieces_encode_as_whole_texts():
    coder, model = token_ids.PieceEncoder(open(MODEL, encoding="utf-8").read()), Tokenizer.from_file(MODEL)
    rng = random.Random(5)
    alphabets = ["ab ", "abc 1\n", "éÀΣσ ́x", "日本 　a", "a\x1c\x85\xa0b ", "don't we'll ", ["<|endoftext|>", " ", "a", "|>"]]
    texts = ["".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    for text, ids in zip(texts, coder.encode_all(texts)):
        assert ids.tolist() == model.encode(text, add_special_tokens=False).ids, text


def test_control_byte_code_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 3, 4, 5, 10_001):
        values = rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32) >> rng.integers(0, 32, n).astype(np.uint32)
        control, data = token_ids.pack(values)
        assert len(control) == -(-n // 4)
        assert (token_ids.unpack(control, data, n) == values).all()


def test_pattern_is_the_published_one():
    assert byte_bpe.PIECES == public_tokenizers.PATTERN


def test_bpe_equals_the_library(docs):
    coder = byte_bpe.encoder(open(RANKS, "rb").read())
    model = tiktoken.Encoding("own", pat_str=byte_bpe.PIECES, mergeable_ranks=coder.ranks, special_tokens={})
    rng = random.Random(6)
    alphabets = ["ab", "abc ", "é1 \n\t", "àßあ漢字😀 ab", "'sstredvml '", "====----", "  　\xa0\x1c\x85a", "'s 1!\n"]
    texts = []
    for _ in range(6000):
        own = rng.choice(alphabets)
        texts.append("".join(rng.choice(own) for _ in range(rng.randint(0, 40))))
    texts += ["a" * 5000, "ab" * 3000, " " * 4000, "".join(rng.choice("aehinorst") for _ in range(20000))]
    for text, ids in zip(texts, coder.encode_all(texts)):
        assert ids.tolist() == model.encode_ordinary(text), text[:60]
        assert coder.decode(ids) == text.encode()
    for row in byte_bpe.digests(byte_bpe.bpe_round_trip(docs, RANKS)).join(docs.select("doc_id", "text"), "doc_id").distinct().collect():
        ids = np.array(model.encode_ordinary(row["text"] or ""), dtype="<u4")
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256((row["text"] or "").encode()).hexdigest()


def test_bpe_tree_equals_plain_merging():
    coder = byte_bpe.encoder(open(RANKS, "rb").read())
    rng = random.Random(7)
    for _ in range(1500):
        raw = bytes(rng.choice(b"etaoin shr\xc3\xa9") for _ in range(rng.randint(1, 120)))
        assert coder.tree(raw) == byte_bpe.merge_all(raw, coder.ranks) == byte_bpe.merge_short(raw, coder.ranks)


def test_bpe_keeps_rows(docs, empty):
    assert byte_bpe.bpe_round_trip(docs, RANKS).count() == docs.count()
    assert byte_bpe.bpe_round_trip(empty, RANKS).count() == 0


def brute_quality(text: str | None) -> tuple:
    own = words(text)
    windows = list(zip(own, own[1:], own[2:]))
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    failed = len(own) < 50 or 100 * len(covered) > 50 * len(own)
    return len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered), failed


def test_quality_base_figures(spark, docs):
    extra = [(500 + i, t) for i, t in enumerate(["a b c a b c a b c", "x y\nx y\n \n \nx y", "é# é# é|" * 30, "a b c d\n" * 40])]
    table = docs.where("n_chars < 20000").select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    model = classifier.train([], [], {})
    found = quality.quality_rules(table, model).join(table, "doc_id").distinct().collect()
    for r in found:
        got = tuple(r[c] for c in (*quality.FIGURES, "base_failed"))
        assert got == brute_quality(r["text"])
        assert r["kept"] == (not r["base_failed"])
    assert quality.quality_rules(table.limit(0), model).count() == 0


def labelled(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(300):
        bad = rng.random() < 0.3
        text = sentence(rng, "etaoinshr", rng.randint(60, 120))
        rows.append((i, text.replace(" ", "!! ").upper() if bad else text, int(not bad)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows if i % 2] + [(7, None)], "doc_id long, quality int")
    return docs, labels, {i: q for i, _, q in rows}


def test_quality_verdict_on_unseen_rows(spark):
    docs, labels, truth = labelled(spark, 8)
    model = quality.quality_model(docs, labels)
    found = {r["doc_id"]: r for r in quality.quality_rules(docs, model).collect()}
    unseen = [i for i in truth if i % 2 == 0]
    assert np.mean([found[i]["kept"] == bool(truth[i]) for i in unseen]) > 0.97
    assert all(found[i]["kept"] for i in unseen if truth[i])


def test_mixing_meets_its_targets(spark):
    docs, labels, truth = labelled(spark, 9)
    mixed = mixing.mix_documents(docs.withColumn("rate", F.lit("clash")), labels, {"1": 0.9, "0": 0.1})
    rows = mixed.collect()
    assert len(rows) == docs.count() and set(mixed.columns) == {"doc_id", "text", *mixing.ADDED}
    total = sum(r["rate"] * r["n_tokens"] for r in rows)
    poor = sum(r["rate"] * r["n_tokens"] * r["posterior"][0] for r in rows)
    assert poor / total == pytest.approx(0.1, abs=1e-3)
    assert all(r["rate"] >= 0 for r in rows)
    assert all(r["copies"] >= 1 for r in rows if truth[r["doc_id"]] == 1)
    assert any(r["copies"] == 0 for r in rows if truth[r["doc_id"]] == 0)


def test_mixing_copies_meet_the_targets(spark):
    """Also where every rate of a domain lies within a tenth of one."""
    rng = random.Random(18)
    rows = [(i, sentence(rng, "etaoinshr" if i % 2 else "bcdfgjklm", 20)) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 6000, 5)], "doc_id long, quality int")
    for share in (0.91, 1.09):
        target = 60_000 * share  # of each domain's 60,000 tokens
        mixed = mixing.mix_documents(docs, labels, {"1": 1.0, "0": 1.0}, budget=2 * target).collect()
        for domain in (0, 1):
            got = sum(r["copies"] * r["n_tokens"] for r in mixed if r["doc_id"] % 2 == domain)
            assert got == pytest.approx(target, rel=0.02)


def test_mixing_equals_driver_side_least_squares(spark):
    docs, labels, _ = labelled(spark, 10)
    rows = mixing.mix_documents(docs, labels, {"1": 0.5, "0": 0.5}, budget=9000.0).collect()
    a = np.array([r["n_tokens"] * np.array(r["posterior"]) for r in rows]).T
    rates = np.array([r["rate"] for r in rows])
    assert np.allclose(a @ rates, [4500, 4500], rtol=1e-3)


def test_mixing_tells_of_domains_it_cannot_give(spark):
    docs, labels, _ = labelled(spark, 20)
    with pytest.raises(ValueError, match="poetry"):
        mixing.mix_documents(docs, labels, {"1": 0.5, "poetry": 0.5})
    with pytest.warns(UserWarning, match="miss the target"):
        mixing.mix_documents(docs, labels, {"0": 0.9, "1": 0.1}, budget=100_000.0)
    found = mixing.mix_documents(docs, labels, {"0": 1.0}, classes=1).select("domain").distinct().collect()
    assert [r["domain"] for r in found] == ["0"]


def test_mixing_without_labels_or_rows(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = mixing.mix_documents(docs, none, {"1": 1.0}).collect()
    assert len(rows) == docs.count() and all(r["rate"] == 1 and r["copies"] == 1 and r["domain"] is None for r in rows)
    assert mixing.mix_documents(empty, none, {"1": 1.0}).count() == 0
