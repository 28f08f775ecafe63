"""N-gram join, passages, embeddings and components against brute force."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest

from sheetcraft.llm import embed_dedup, graph, ngram_join, setjoin, substring_dedup
from tests.llm.cases import SCHEMA, Union, awkward_documents, fold, sentence, words


def shingles(text: str | None, k: int) -> set:
    own = words(fold(text))
    return {tuple(own[i : i + k]) for i in range(max(1, len(own) - k + 1))} if own else set()


def brute_components(rows: list[tuple]) -> dict:
    sets = [(i, shingles(t, 3)) for i, t in rows]
    union, groups = Union(), {}
    for (i, a), (j, b) in combinations(enumerate(s for _, s in sets), 2):
        if a and b and 100 * len(a & b) >= 90 * len(a | b):
            union.join(i, j)
    for n in range(len(rows)):
        groups.setdefault(union.find(n), []).append(n)
    out = {}
    for members in groups.values():
        ids = [rows[n][0] for n in members if rows[n][0] is not None]
        for n in members:
            out[n] = min(ids, default=None)
    return out


def near_groups(seed: int) -> list[tuple]:
    """Groups whose members differ from a base in 0 to 5 words of 4 to 200."""
    rng = random.Random(seed)
    rows, n = [], 0
    for _ in range(6):
        base = sentence(rng, "etaoinshrdlu", rng.choice((4, 12, 60, 120, 200))).split()
        for _ in range(14):
            own = list(base)
            for _ in range(rng.randint(0, 5)):
                own[rng.randrange(len(own))] = sentence(rng, "bcfghjkm", 1)
            rows.append((n, " ".join(own)))
            n += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_components_equal_brute_force(spark, seed):
    rows = near_groups(seed)
    found = {r[0]: r for r in ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute_components(rows)
    assert len(found) == len(rows)
    for n, (i, text) in enumerate(rows):
        assert found[i]["n_shingles"] == len(shingles(text, 3))
        assert found[i]["component_id"] == want[n]
    assert len({r["component_id"] for r in found.values()}) < len(rows)


def test_ngram_awkward_rows(spark):
    rows = [r[:2] for r in awkward_documents()]
    found = ngram_join.jaccard_components(spark.createDataFrame(awkward_documents(), SCHEMA)).collect()
    want = brute_components(rows)
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in found) == sorted(
        (str(i), len(shingles(t, 3)), str(want[n])) for n, (i, t) in enumerate(rows)
    )
    assert ngram_join.jaccard_components(spark.createDataFrame([], SCHEMA)).count() == 0


def test_similar_sets_always_share_a_signature():
    rng = np.random.default_rng(3)
    bands = setjoin.size_bands(90, 100)
    for size in (10, 11, 19, 40, 95, 150, 230, 600, 2500):
        for _ in range(40):
            a = rng.integers(0, 1 << 64, size, dtype=np.uint64)
            swap = int((100 * size - 90 * size) / 190)  # as many as 0.9 allows
            b = np.concatenate((a[: size - swap], rng.integers(0, 1 << 64, swap, dtype=np.uint64)))
            drop = rng.integers(0, max(1, size // 10 - 2 * swap) + 1)
            b = b[: len(b) - drop] if 100 * (size - swap - drop) >= 90 * (size + swap) and drop else b
            inter = len(np.intersect1d(a, b))
            if 100 * inter < 90 * len(np.union1d(a, b)):
                continue
            one = ngram_join.signatures(np.unique(a), bands, 90, 100)
            two = ngram_join.signatures(np.unique(b), bands, 90, 100)
            assert len(np.intersect1d(one, two)) or inter == size == len(b), size


def test_blocks_split_large_groups(spark, monkeypatch):
    monkeypatch.setattr(setjoin, "CHUNK_SETS", 4)
    rows = near_groups(5)
    found = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute_components(rows)
    assert {r["doc_id"]: r["component_id"] for r in found} == {i: want[n] for n, (i, _) in enumerate(rows)}


def test_components_of_paths_stars_and_rings(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 240)] + [(300, 301), (301, 302), (302, 300)]
    edges += [(rng.randint(400, 500), rng.randint(400, 500)) for _ in range(60)]
    union = Union()
    for a, b in edges:
        union.join(a, b)
    found = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {x: union.find(x) for e in edges if e[0] != e[1] for x in e}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bands_reach_their_recall():
    bands, rows = substring_dedup.tuned_bands(0.8, 0.95)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.95 > 1 - (1 - 0.8**rows) ** (bands - 1)


def test_planted_passages_go_and_clean_texts_stay(spark):
    rng = random.Random(11)
    passages = [sentence(rng, "bcdfghjklm", n) for n in (51, 55, 60, 80, 150)]
    rows, holders = [], {}
    for n in range(60):
        own = [sentence(rng, "etaoinshr", rng.randint(5, 60)) for _ in range(rng.randint(1, 5))]
        if n % 2:
            p = rng.randrange(len(passages))
            if rng.random() < 0.5:
                own.insert(rng.randint(0, len(own)), passages[p])
            else:
                k = rng.randrange(len(own))
                own[k] = f"{own[k]} {passages[p]} {sentence(rng, 'etaoinshr', 9)}"
            holders.setdefault(p, []).append(n)
        rows.append((n, "\n".join(own)))
    near = passages[4].split()
    near[70] = "other"
    rows.append((60, " ".join(near)))
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, node string")
    found = substring_dedup.dedup_passages(docs)
    assert found.columns == docs.columns
    after = {r["doc_id"]: r["text"] for r in found.collect()}
    assert len(after) == len(rows)
    for p, own in holders.items():
        have = [n for n in own if passages[p] in after[n]]
        assert have == [min(own)], (p, own, have)
    for n, text in rows[:60]:
        if n % 2 == 0 or n in {min(own) for own in holders.values()}:
            assert after[n] == text
    assert len(after[60].split()) < 40  # a near copy of a paragraph


def brute_repeats(rows: list[tuple]) -> dict:
    """Places of words in a run of 12 that a document of a smaller id holds."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        own = words(fold(text))
        runs = [tuple(own[k : k + 12]) for k in range(len(own) - 11)]
        out[i] = {p for k, run in enumerate(runs) if run in seen for p in range(k, k + 12)}
        seen.update(runs)
    return out


def test_repeats_of_any_wrapping_go_to_their_ends(spark):
    """Passages of 11 to 80 words, inside longer lines or wrapped at other places."""
    rng = random.Random(17)
    passages = [sentence(rng, "bcdfghjklm", n).split() for n in (11, 12, 13, 20, 30, 40, 55, 80)]
    rows = []
    for n in range(80):
        own = sentence(rng, "etaoinshr", rng.randint(8, 40)).split()
        for p in rng.sample(passages, 2):
            own += p + sentence(rng, "etaoinshr", rng.randint(4, 20)).split()
        if n % 2:  # lines of 10 to 15 words, from any word on
            width, k = rng.randint(10, 15), rng.randint(1, 14)
            own = [" ".join(own[:k])] + [" ".join(own[j : j + width]) for j in range(k, len(own), width)]
            rows.append((n, "\n".join(own)))
        else:
            rows.append((n, " ".join(own)))
    want = brute_repeats(rows)
    found = substring_dedup.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = {r["id"]: {p for s in r["removed"] for p in range(s["from_word"], s["to_word"])} for r in found}
    assert all(got.get(i, set()) == places for i, places in want.items())
    assert sum(map(bool, want.values())) > 60


def test_short_equal_paragraphs_go(spark):
    rows = [(1, "a b c d e f\nown words here"), (2, "other\nA b c d e f\nlast line"), (3, "x a b c d e f y")]
    found = substring_dedup.dedup_passages(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: r["text"] for r in found.collect()} == {**dict(rows), 2: "other\nlast line"}


def test_removal_keeps_the_other_words():
    rng = random.Random(12)
    for _ in range(200):
        text = "".join(rng.choice(["ab", "c", " ", "  ", "\n", "\t", "é"]) for _ in range(rng.randint(0, 60)))
        own = words(text)
        a = rng.randint(0, len(own))
        z = rng.randint(a, len(own))
        left = substring_dedup.without_words(text, [(a, z)])
        assert words(left) == own[:a] + own[z:]
        assert substring_dedup.without_words(text, []) == text


def test_passages_awkward_rows(spark):
    docs = spark.createDataFrame(awkward_documents(), SCHEMA)
    found = substring_dedup.dedup_passages(docs)
    assert found.columns == docs.columns and found.count() == docs.count()
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in found.collect():
        if before[r["doc_id"]] in (None, "", "one"):
            assert r["text"] == before[r["doc_id"]]
    assert substring_dedup.repeated_spans(spark.createDataFrame([], SCHEMA)).count() == 0


def brute_vectors(rows: list[tuple], threshold: float) -> dict:
    union, links = Union(), {i: 0 for i, _ in rows}
    ok = {i: np.array(v, dtype=float) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)}
    for i in links:
        union.find(i)
    for i, j in combinations(ok, 2):
        if len(ok[i]) == len(ok[j]) and ok[i] @ ok[j] / np.linalg.norm(ok[i]) / np.linalg.norm(ok[j]) >= threshold:
            links[i] += 1
            links[j] += 1
            union.join(i, j)
    return {i: (links[i], union.find(i)) for i in links}


@pytest.mark.parametrize("chunk", [4, 1024])
def test_embeddings_equal_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(embed_dedup, "CHUNK", chunk)
    rng = np.random.default_rng(13)
    rows = []
    for _ in range(60):
        base = rng.normal(size=64)
        for _ in range(rng.integers(1, 7)):
            rows.append((len(rows), (base + rng.normal(size=64) * rng.uniform(0, 0.2)).astype(np.float32).tolist()))
    rows += [(len(rows) + k, rows[3][1]) for k in range(5)]
    rows.append((len(rows), [2.0 * x for x in rows[3][1]]))
    odd = [None, [], [0.0] * 64, [float("nan")] + [1.0] * 63, [float("inf")] * 64, [None] + [1.0] * 63, [1.0, 2.0], [1.0, 2.0]]
    rows += [(len(rows) + k, v) for k, v in enumerate(odd)]
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, node string")
    found = embed_dedup.embedding_components(table).collect()
    want = brute_vectors(rows, 0.95)
    assert len(found) == len(rows)
    right = sum((r["n_links"], r["component_id"]) == want[r["vec_id"]] for r in found)
    assert right >= 0.99 * len(rows)
    for r in found:
        assert r["kept"] == (r["vec_id"] == r["component_id"])
        assert r["n_links"] <= want[r["vec_id"]][0]
        if r["vec_id"] >= len(rows) - len(odd) and r["vec_id"] < len(rows) - 2:
            assert r["n_links"] == 0 and r["kept"]


def test_embeddings_empty(spark):
    assert embed_dedup.embedding_components(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_lattice_points_are_nearest():
    rng = np.random.default_rng(14)
    x = rng.normal(size=(300, 8)) * 2
    point = embed_dedup.nearest_e8(x)
    twice = point * 2
    assert np.allclose(twice, np.rint(twice)) and (np.rint(point.sum(axis=1)) % 2 == 0).all()
    assert ((np.rint(twice) % 2).std(axis=1) == 0).all()
    own = ((x - point) ** 2).sum(axis=1)
    other = ((x[:, None] - point[:, None] - embed_dedup._NEIGHBOURS[None]) ** 2).sum(axis=2).min(axis=1)
    assert (own <= other + 1e-9).all()


def test_near_copies_are_no_source_of_runs(spark):
    """The 14 words of its own that a near copy holds stay where they are elsewhere."""
    rng = random.Random(23)
    base = sentence(rng, "etaoinshr", 400).split()
    own = sentence(rng, "bcdfgjklm", 14).split()
    rows = [(1, " ".join(base)), (2, " ".join(base[:200] + own + base[200:])), (3, sentence(rng, "pqvwxyz", 60) + " " + " ".join(own))]
    found = {r[0]: r for r in substring_dedup.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(found) == {2} and found[2]["repeats_of"] == [1]
    after = {r[0]: r[1] for r in substring_dedup.dedup_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert after == {1: rows[0][1], 2: "", 3: rows[2][1]}


@pytest.mark.parametrize("seed", [1, 2])
def test_words_removed_within_runs_stay_somewhere(spark, seed):
    rng = random.Random(seed)
    lines = [sentence(rng, "etaoinshrdlu", rng.choice((6, 14, 25, 40))) for _ in range(25)]
    rows = []
    for n in range(90):
        own = []
        for line in rng.sample(lines, 4):
            line = line.split()
            if rng.random() < 0.5:  # nearly the line
                line[rng.randrange(len(line))] = sentence(rng, "bcfgjk", 1)
            if rng.random() < 0.5:  # inside a longer one
                line = sentence(rng, "pqvwxyz", rng.randint(1, 30)).split() + line
            own.append(" ".join(line))
        rows.append((n, rng.choice("\n ").join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = substring_dedup.repeated_spans(docs).collect()
    gone = {r["id"]: {p for s in r["removed"] for p in range(s["from_word"], s["to_word"])} for r in found}
    left = {w for n, t in rows for p, w in enumerate(words(fold(t))) if p not in gone.get(n, set())}
    # Words of a line as it was made are in many documents: none may vanish.
    assert {w for line in lines for w in line.split()} & {w for _, t in rows for w in t.split()} <= left
    assert sum(map(len, gone.values())) > 2000


def test_columns_of_any_name_and_kind(spark):
    rng = random.Random(5)
    line = sentence(rng, "etaoin", 40)
    rows = [(1, line, 7, {"a": 1}, "x"), (1, line, 7, {"a": 1}, "x"), (2, line, 8, {}, None), (None, "own words", 9, None, "y"), (3, None, 1, None, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __id int, __key map<string,int>, `row.id` string")
    out = substring_dedup.dedup_passages(docs)
    assert out.columns == docs.columns
    got = sorted(((r[0], r[1], r[2]) for r in out.collect()), key=str)
    assert got == sorted([(1, line, 7), (1, line, 7), (2, "", 8), (None, "own words", 9), (3, None, 1)], key=str)
    kept = ngram_join.one_a_component(docs)
    assert kept.columns == docs.columns
    assert sorted(((r[0], r[2]) for r in kept.collect()), key=str) == [(1, 7), (3, 1), (None, 9)]
