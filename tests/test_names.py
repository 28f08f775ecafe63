"""Columns by position, lossless types and leaves of JSON columns."""

from __future__ import annotations

import json
import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sheetcraft.functions import jsonpath as J
from sheetcraft.functions import names as N
from sheetcraft.operators import referrals
from sheetcraft.operators import reshape as R
from sheetcraft.operators.json_trie import Leaf, json_leaves
from sheetcraft.operators.lattice import TextState, text_states
from sheetcraft.session import scratch_dir
from sheetcraft.sources import workbooks as W

ODD = ["No.", "a.b", "a`b", "x", "Rate", "rate", "", " ", "RATE_2"]


def test_stored_names_are_unique_whatever_the_case():
    assert N.stored_names(["Rate", "x", "rate", "RATE"]) == ["Rate", "x", "rate_2", "RATE_3"]
    rng = random.Random(1)
    for _ in range(300):
        headers = [rng.choice(["a", "A", "a_2", "A_2", "a_3", "b", "B"]) for _ in range(rng.randint(0, 7))]
        names = N.stored_names(headers)
        assert len({n.lower() for n in names}) == len(headers)
        assert all(n == h for i, (n, h) in enumerate(zip(names, headers)) if h.lower() not in {x.lower() for x in headers[:i]} | {x.lower() for x in headers[i + 1 :]})


def test_odd_headers_collect_union_unstack_and_write(spark):
    rows = [(i, float(i), "t", None, 1.5 if i else None, 2, None, "y", True) for i in range(4)]
    df = spark.createDataFrame(rows, "c0 int, c1 double, c2 string, c3 string, c4 double, c5 int, c6 string, c7 string, c8 boolean")
    odd = N.with_headers(df, ODD)
    assert N.headers_of(odd) == ODD
    live = R.drop_empty(odd)
    assert N.headers_of(live) == [h for h in ODD if h not in ("x", "")]
    both = R.union_mixed([live, N.with_headers(df.select("c0", "c5"), ["rate", "RATE_2"])])
    assert N.headers_of(both) == N.headers_of(live) and both.count() == 8
    kinds = dict(zip(N.headers_of(both), [t for _, t in both.dtypes]))
    assert kinds["rate"] == "int" and kinds["RATE_2"] == "string"  # True beside 2 is text
    assert sorted(r[-1] for r in both.collect()) == ["2"] * 4 + ["True"] * 4
    path = scratch_dir(spark, "odd") + "/t"
    N.with_headers(both.drop(both.columns[6]), [h or "blank" for h in N.headers_of(both) if h != " "]).write.parquet(path)
    assert spark.read.parquet(path).count() == 8
    long = R.unstack_groups(live, ["No."], {"g.1 (0.5)": {"m.": "Rate"}, "G.1 (0.5)": {"m.": "rate", "n`": "a`b"}}, group_col="a.b")
    assert N.headers_of(long) == ["No.", "a.b", "m.", "n`"] and long.count() == 8
    assert R.drop_all_null_rows(odd, ["x", ""]).count() == 0 and R.nan_text_to_null(odd).count() == 4


def test_structs_with_dots_unstack(spark):
    df = spark.sql("select 1 as id, named_struct('Rate', 2.0D, 'a.b', 3) as `Infant (0.5-1)`, named_struct('rate', 4) as `infant (0.5-1)_2`")
    long = R.unstack_groups(df, ["id"])
    assert [tuple(r) for r in long.orderBy("Age Group").collect()] == [(1, "Infant (0.5-1)", 2.0, 3, None), (1, "infant (0.5-1)_2", None, None, 4)]


def test_repeated_headers_of_cells(spark):
    def cells(path, line, texts):
        return (path, None, 0, "s", line, line, path, [None if t is None else ("s" if isinstance(t, str) else "n", str(t)) for t in texts], None)

    rows = [cells("a", 0, ["x", "x", "No.", "Rate"]), cells("a", 1, [1, "p", None, 2]), cells("b", 0, ["rate", "x"]), cells("b", 1, ["q", 5])]
    t = W.to_table(spark.createDataFrame(rows, W.SCAN_SCHEMA))
    assert N.headers_of(t) == ["x", "x.1", "Rate", "rate"]
    assert sorted(map(tuple, t.collect()), key=str) == [(1, "p", 2, None), (5, None, None, "q")]


def test_lattice_join_is_that_of_the_whole(spark):
    rng = random.Random(3)
    pool = ["1", "-7", "01234", "0", "-0", "9223372036854775808", "1.5", "1.50", "1e3", "true", "True", "x", "", " 1", "NaN", None]
    texts = [[rng.choice(pool[: rng.choice([2, 4, 8, len(pool)])]) for _ in range(6)] for _ in range(30)]
    df = spark.createDataFrame([tuple(c[i] for c in texts) for i in range(6)], ", ".join(f"t{i} string" for i in range(30)))
    whole = text_states(df)
    parts = [text_states(df.limit(0)), text_states(df.filter("t0 is null")), text_states(df.filter("t0 is not null"))]
    for i in range(30):
        assert parts[0][i].joined(parts[1][i]).joined(parts[2][i]) == whole[i] == parts[2][i].joined(parts[1][i])
    assert TextState().joined(whole[0]) == whole[0]
    again = R.retype(df)
    for i, kind in enumerate(dict(again.dtypes).values()):
        back = [r[0] for r in again.select(F.col(f"t{i}").cast("string")).collect()]
        assert back == texts[i], kind


@pytest.mark.parametrize(
    ("texts", "kind"),
    [(["01234", "97201"], "string"), (["9223372036854775808", "1"], "decimal(19,0)"), (["1", "-5"], "bigint"), (["1.5", "2.25"], "double"),
     (["1", "1.5"], "string"), (["true", "false"], "boolean"), (["1.50"], "string"), ([None], "string"), (["9" * 39], "string")],
)
def test_types_lose_nothing(spark, texts, kind):
    df = spark.createDataFrame([(t,) for t in texts], "a string")
    assert dict(R.retype(df).dtypes) == {"a": kind}
    assert [r[0] for r in R.retype(df).select(F.col("a").cast("string")).collect()] == texts


def test_mixed_columns_stay_text(spark):
    a = spark.createDataFrame([("01234",), ("true",), ("nan",), ("9223372036854775808",)], "k string")
    b = spark.createDataFrame([(97201,), (None,)], "k int")
    c = spark.createDataFrame([(True,)], "k boolean")
    got = [r[0] for r in R.union_mixed([a, b, c]).collect()]
    assert got == ["01234", "true", None, "9223372036854775808", "97201", None, "True"]
    d = spark.createDataFrame([("x", 1)], "A string, b int")
    assert R.union_mixed([b, d]).columns == ["k", "A", "b"]
    e = spark.createDataFrame([(1,)], "a int")
    assert N.headers_of(R.union_mixed([e, d])) == ["a", "A", "b"]


def test_leaves_differ_in_case_and_keep_their_kind(spark):
    rows = ['{"a":1}', '{"A":2}', '"{\\"a\\":1}"', '{"n":{"x":1,"X":"t"},"l":[1,2]}', '{"m":1}', '{"m":{"k":2}}', "null", "[1]", '{"z":null}']
    df = spark.createDataFrame([(r,) for r in rows], "t string").select(F.parse_json("t").alias("v"))
    assert json_leaves(df, "v") == [
        Leaf(("A",), "bigint"), Leaf(("a",), "bigint"), Leaf(("l",), "array<bigint>"), Leaf(("m",), "string"),
        Leaf(("n", "X"), "string"), Leaf(("n", "x"), "bigint"), Leaf(("z",), "string"),
    ]
    notes = [(1, '{"Filters":[{"a":1}]}'), (2, '{"Filters":[{"A":2}]}'), (3, '{"Filters":["{\\"a\\":1}"]}'), (4, '{"Filters":[{"ID":5}]}')]
    for strict in (False, True):
        out = referrals.process_referral_notes(spark.createDataFrame(notes, "id int, Notes string"), strict=strict)
        assert N.headers_of(out) == ["id", "A", "ID", "a"]
        assert len({c.lower() for c in out.columns}) == 4
        got = {r[0]: tuple(r)[1:] for r in out.collect()}
        assert got == {1: (None, None, 1), 2: (2, None, None), 3: (None, None, None), 4: (None, 5, None)}
        out.write.parquet(scratch_dir(spark, "leaves") + "/t")


VALUES = st.recursive(
    st.none() | st.booleans() | st.integers(-5, 5) | st.sampled_from([math.nan, math.inf, -math.inf]) | st.sampled_from(["NaN", "a\\", 'q"', "", "{}"]),
    lambda x: st.lists(x, max_size=3) | st.dictionaries(st.sampled_from(["a", "A", "b.c", "Filters"]), x, max_size=3),
    max_leaves=6,
)
NOTE = st.builds(lambda v, tail: json.dumps({"Filters": v}) + tail, VALUES, st.sampled_from(["", " ", "x", "{}", ",1", '],["']))
TWICE = st.builds(lambda a, b: f'{{"Filters":{json.dumps(a)},"Filters":{json.dumps(b)}}}', VALUES, VALUES)


@settings(max_examples=12, deadline=None)
@given(notes=st.lists(NOTE | TWICE | st.sampled_from(["", "[]", "null", "{", '{"filters":[1]}']), min_size=1, max_size=25))
def test_filters_parse_as_json_loads_does(spark, notes):
    J.accept_repeated_keys(spark)

    def plain(value):
        if isinstance(value, float):
            return None
        if isinstance(value, dict):
            return {k: plain(v) for k, v in value.items()}
        return [plain(v) for v in value] if isinstance(value, list) else value

    def wanted(text):
        try:
            data = json.loads(text)
        except ValueError:
            return None
        found = data.get("Filters") if isinstance(data, dict) else None
        return plain(found) if isinstance(found, list) and found else None

    df = spark.createDataFrame(list(enumerate(notes)), "id int, n string")
    rows = df.select("id", F.transform(J.filter_values("n"), lambda x: F.to_json(x)).alias("own"), J.filter_texts_strict("n").alias("strict")).orderBy("id").collect()
    for text, row in zip(notes, rows):
        assert [None if x is None else json.loads(x) for x in row["own"]] == wanted(text) if row["own"] is not None else wanted(text) is None, text
        assert [json.loads(x) for x in row["strict"]] == wanted(text) if row["strict"] is not None else wanted(text) is None, text


def test_cleaning_scans_and_shuffles_once(spark):
    from sheetcraft.plans.catalog import referral_clean

    plan = referral_clean(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 2 and plan.count("WindowGroupLimit") >= 2
    assert plan.count("Exchange hashpartitioning") == 2  # numbering, and the distinct rows without a key
