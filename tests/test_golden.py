"""Golden micro-tests for expressions and small operators."""

import datetime as dt
from pathlib import PurePosixPath
from urllib.parse import urlsplit, urlunsplit

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sheetcraft.functions import jsonpath, text, timeparse, urls
from sheetcraft.functions.regions import REGIONS, counties, regions
from sheetcraft.operators import programs as P
from sheetcraft.operators import referrals as R
from sheetcraft.operators import reshape as RS


def test_strip_matches_python(spark):
    samples = ["  a b ", "\t\nx　", " y ", None, "", "z"]
    got = [r[0] for r in spark.createDataFrame([(s,) for s in samples], "s string").select(text.strip_ws("s")).collect()]
    assert got == [s.strip() if s is not None else None for s in samples]


def test_time_parse_cases(spark):
    ok = ["01/02/2024 03:04 PM", "1/2/2024 3:04 pm"]
    bad = ["13/01/2024 01:00 AM", "01/02/2024 13:04 PM", "1/2/24 3:04 PM"]
    df = spark.createDataFrame([(s,) for s in ok + bad + [None]], "s string")
    got = [r[0] for r in df.select(timeparse.parse_action_time("s", on_error="null")).collect()]
    assert got[:2] == [dt.datetime(2024, 1, 2, 15, 4)] * 2
    assert got[2:] == [None, None, None, None]
    for b in bad:
        with pytest.raises(PySparkException):
            spark.createDataFrame([(b,)], "s string").select(timeparse.parse_action_time("s")).collect()


def test_null_semantics(spark):
    df = spark.createDataFrame(
        [(None, None, None, None, None, None)],
        "RecordedBy string, Status string, License string, `Provider Type` string, Regulation string, "
        "`Business Name` string",
    )
    assert R.anonymise(df).first()["RecordedBy"] is None
    # null status is not "invalid" by itself; null regulation is
    row = df.select(P.invalid_programs_mask().alias("m")).first()
    assert row["m"] is True
    df2 = df.withColumn("Regulation", F.lit("x"))
    assert df2.select(P.invalid_programs_mask().alias("m")).first()["m"] is False


def test_notes_golden(spark):
    rows = [
        (1, '{"Filters":[{"a":1,"b":{"c":2}},{"a":"x","l":[1,2]}]}'),
        (2, '{"Filters":["s"]}'),
        (3, None), (4, "bad"), (5, "[1]"), (6, '{"Other":1}'), (7, '{"Filters":[]}'),
    ]
    df = spark.createDataFrame(rows, "id int, Notes string")
    for strict in (False, True):
        out = R.process_referral_notes(df, strict=strict)
        assert out.columns == ["id", "a", "b.c", "l"]
        got = sorted(out.collect(), key=lambda r: (r["id"], str(r["a"])))
        assert [r["id"] for r in got] == [1, 1, 2]
        assert got[0]["a"] == "1" and got[0]["b.c"] == 2 and got[0]["l"] is None
        assert got[1]["a"] == "x" and got[1]["l"] == [1, 2]
        assert all(got[2][c] is None for c in ("a", "b.c", "l"))


def test_notes_given_schema_skips_discovery(spark):
    df = spark.createDataFrame([(1, '{"Filters":[{"a":1}]}')], "id int, Notes string")
    out = R.process_referral_notes(df, schema="struct<a: bigint, z: string>")
    assert out.columns == ["id", "a", "z"]
    assert out.first()["a"] == 1


@pytest.mark.parametrize(
    "f,t,flags",
    [
        (0, 24, (False, True, True, False, False)),
        (24, 36, (False, False, True, True, False)),
        (36, 60, (False, False, False, True, True)),
        (0, 0, (True, False, False, False, False)),
        (12, 12, (True, False, False, False, False)),
        (None, 24, (True, False, False, False, False)),
    ],
)
def test_age_flags(spark, f, t, flags):
    df = spark.createDataFrame([(f, t)], f"`{P.FROM_TOTAL}` int, `{P.TO_TOTAL}` int")
    row = P.care_for_flag_from_total_months(df).first()
    assert (row[P.UNKNOWN_RANGE],) + tuple(row[c] for c in P.AGE_RANGE_COLUMNS) == flags


def test_range_labels():
    assert P.AGE_RANGE_COLUMNS == ("Infant (0-24)", "Toddler (24-36)", "Preschool (36-60)", "School Age (60+)")


@pytest.mark.parametrize(
    "pt,lic,reg,ptypes,code",
    [
        ("Licensed Center", "cc1", "Licensed Child Care Center", None, "CC"),
        ("Licensed Home", "CF9", "Certified Family Child Care", None, "CF"),
        ("Licensed Home", "rf", "Registered Family Child Care", None, "RF"),
        ("License Exempt Home", "IQY7", "Regulated Subsidy", None, "RS"),
        ("License Exempt Center", "RS7", "Regulated Subsidy", None, "RS"),
        ("License Exempt Center", "PS1", "Recorded Preschool Program", None, "PSR"),
        ("License Exempt Center", "SA1", "Recorded School Age Program", None, "SAR"),
        ("Interim Emergency Site", "RA1", "Recorded Agency", None, "RA"),
        ("License Exempt Center", "AP1", "Unlicensed", None, "AP"),
        ("License Exempt Center", "X", "Unlicensed", "Preschool Promise", "PSE"),
        ("License Exempt Center", "X", "Unlicensed", "school age", "SAE"),
        ("License Exempt Center", "X", "Unlicensed", "preschool; School Age", "CE"),
        ("License Exempt Center", "X", "Unlicensed", None, "CE"),
        (" License Exempt Home ", None, " Unlicensed", None, "FE"),
        ("Licensed Center", "CF1", "Licensed Child Care Center", None, None),
        (None, None, None, None, None),
    ],
)
def test_type_code_rules(spark, pt, lic, reg, ptypes, code):
    df = spark.createDataFrame(
        [(pt, lic, reg, ptypes)], "`Provider Type` string, License string, Regulation string, `Program Types` string"
    )
    assert P.type_code_programs(df).first()[P.TYPE_CODE] == code


def test_program_flags_substrings(spark):
    df = spark.createDataFrame([("Preschool Promise; Early Head Start (OPK)",), (None,)], "`Program Types` string")
    rows = P.flag_program_types(df).collect()
    assert rows[0]["Preschool"] and rows[0]["Preschool Promise"] and rows[0]["Head Start (OPK)"]
    assert rows[0]["Early Head Start (OPK)"] and not rows[0]["Tribal"]
    assert not any(rows[1][n] for n in P.PROGRAM_TYPE_NAMES)


def test_regions_table(spark):
    assert regions(spark).count() == 15
    assert sorted(r[1] for r in REGIONS) == [i for i in range(1, 17) if i != 13]
    assert counties(spark).count() == 36
    df = spark.createDataFrame([(" Lane ",), ("Nowhere",), (None,)], "Region string")
    for how in ("join", "case"):
        got = sorted(P.sda_code_programs(df, how=how).collect(), key=lambda r: str(r["Region"]))
        assert [r["SDA"] for r in got] == [6, None, None]


def test_dhs_rename(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`DHS ID` int, `ODHS Name` int, other int")
    assert P.dhs_to_odhs_names(df).columns == ["ODHS ID", "ODHS Name", "other"]


def test_unstack_keeps_all_null_pairs(spark):
    df = spark.createDataFrame([(1, 5.0, None, None, None), (2, None, None, None, None)],
                               "id bigint, ir double, ic int, tr double, tc int")
    groups = {"Infant": {"Rate": "ir", "Capacity": "ic"}, "Toddler": {"Rate": "tr", "Capacity": "tc"}}
    out = RS.unstack_groups(df, ["id"], groups).collect()
    assert sorted((r["id"], r["Age Group"], r["Rate"]) for r in out) == [(1, "Infant", 5.0), (1, "Toddler", None)]


def test_drop_empty_and_union(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    out = RS.drop_empty(df)
    assert out.columns == ["a"] and out.count() == 1
    a = spark.createDataFrame([(1, "x")], "k int, n string")
    b = spark.createDataFrame([("z", "y", 3)], "k string, n string, m int")
    u = RS.union_mixed([a, b])
    assert dict(u.dtypes) == {"k": "string", "n": "string", "m": "int"}
    c = spark.createDataFrame([("7",)], "k string")
    assert dict(RS.union_mixed([a.select("k"), c]).dtypes) == {"k": "string"}  # mixed columns stay text
    assert dict(RS.union_mixed([a.select("k"), c], infer=True).dtypes) == {"k": "bigint"}


def test_json_path(spark):
    df = spark.createDataFrame([('{"a": {"b": null, "c": 1}, "d": 2}',), ("bad",), (None,)], "j string")
    out = df.select(
        jsonpath.json_path("j", ["a", "b"], default="D").alias("present_null"),
        jsonpath.json_path("j", ["a", "x"], default="D").alias("absent"),
        jsonpath.json_path("j", ["d", "x"], default="D").alias("not_map"),
        jsonpath.json_path("j", ["a", "c"], as_type="bigint").alias("typed"),
    ).collect()
    assert (out[0]["present_null"], out[0]["absent"], out[0]["not_map"], out[0]["typed"]) == (None, "D", "D", 1)
    assert out[1]["absent"] == "D" and out[2]["absent"] == "D"


def _py_join(url: str, rel: str) -> str:
    parts = urlsplit(url)
    path = PurePosixPath(parts.path) / urlsplit(rel).path
    return urlunsplit(parts._replace(path=str(path)))


SEG = st.sampled_from(["a", "b", ".", "..", "", "en", "x.html"])


@settings(max_examples=60, deadline=None)
@given(base=st.lists(SEG, max_size=4), rel=st.lists(SEG, min_size=1, max_size=3),
       lead=st.booleans(), query=st.sampled_from(["", "?q=1"]), frag=st.sampled_from(["", "#top"]))
def test_url_join_matches_python(spark, base, rel, lead, query, frag):
    path = ("/" if lead else "") + "/".join(base)
    if path and not path.startswith("/"):
        path = "/" + path
    url = f"https://h.example.org{path}{query}{frag}"
    r = "/".join(rel)
    if not r or r.startswith("//"):
        return
    got = spark.createDataFrame([(url,)], "u string").select(urls.join_url_path("u", r)).first()[0]
    assert got == _py_join(url, r)


def test_url_absolute_and_errors(spark):
    df = spark.createDataFrame([("http://a/b",), ("/rel/x",), ("mailto:x",)], "u string")
    assert [r[0] for r in df.select(urls.is_absolute_url("u")).collect()] == [True, False, False]
    with pytest.raises(ValueError):
        urls.join_url_path("u", "http://other/x")
    with pytest.raises(ValueError):
        urls.join_url_path("u", "a?q=1")


def test_notes_special_keys_and_null_only_leaves(spark):
    rows = [(1, '{"Filters":[{"a b":1,"n":null,"d.o":{"x y":"z"},"q\\"t":2}]}'), (2, '{"Filters":[{"a b":2}]}')]
    out = R.process_referral_notes(spark.createDataFrame(rows, "id int, Notes string"))
    assert out.columns == ["id", "a b", "d.o.x y", "n", 'q"t']
    got = {r["id"]: r for r in out.collect()}
    assert got[1]["a b"] == 1 and got[1]["d.o.x y"] == "z" and got[1]["n"] is None and got[1]['q"t'] == 2
    assert got[2]["a b"] == 2 and got[2]["d.o.x y"] is None


def test_scale_conf():
    from sheetcraft.session import scale_conf

    big = scale_conf(100 * 2**40, executors=1000, cores_per_executor=8)
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (256 << 20)
    small = scale_conf(10 << 20, executors=1, cores_per_executor=8)
    assert small["spark.sql.shuffle.partitions"] == "16"


@settings(max_examples=60, deadline=None)
@given(scheme=st.sampled_from(["http", "HTTPS", "ftp"]), host=st.sampled_from(["h.example.org", "H:8080", "u@h"]),
       path=st.sampled_from(["", "/", "/a/b", "/a//b/", "/x.html"]), query=st.sampled_from(["", "?", "?q=1&r=2"]),
       frag=st.sampled_from(["", "#", "#top"]))
def test_url_text_matches_python(spark, scheme, host, path, query, frag):
    url = f"{scheme}://{host}{path}{query}{frag}"
    got = spark.createDataFrame([(url,)], "u string").select(urls.url_text("u")).first()[0]
    assert got == urlunsplit(urlsplit(url))


def test_url_text_rejects_relative(spark):
    df = spark.createDataFrame([("/just/a/path",)], "u string")
    assert df.select(urls.url_text("u", on_error="null")).first()[0] is None
    with pytest.raises(PySparkException):
        df.select(urls.url_text("u")).collect()
