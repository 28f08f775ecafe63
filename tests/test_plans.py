"""Plan-shape checks: exchanges, joins, Python nodes."""

import re

import __spark_entry__ as E

from .conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return _plan(df)


def test_projections_have_no_exchange(spark):
    q = E.queries()
    for name in ("programs_type_code", "programs_flags", "programs_age_flags", "programs_valid",
                 "age_details_long", "url_join", "json_path_default", "programs_sda_case"):
        p = _plan(q[name](spark, SF_SMALL))
        assert "Exchange" not in p, (name, p)


def test_sda_join_is_broadcast(spark):
    p = _plan(E.queries()["programs_sda"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_age_details_is_one_generate(spark):
    p = _plan(E.queries()["age_details_long"](spark, SF_SMALL))
    assert p.count("Generate") == 1 and p.count("FileScan") == 1


def test_referral_clean_shape(spark):
    df = E.queries()["referral_clean"](spark, SF_SMALL)
    p = _final_plan(df)
    # keys are cut to a few rows before the shuffle, not sized in another scan
    assert "LeftAnti" not in p and p.count("WindowGroupLimit") >= 2
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    # one key-partitioned exchange feeds the numbering window
    assert len(re.findall(r"Window \[row_number", p)) == 1


def test_has_rate_cap_one_aggregate_one_join(spark):
    df = E.queries()["programs_has_rate_cap"](spark, SF_SMALL)
    p = _final_plan(df)
    assert p.count("LeftOuter") == 1
    assert p.count("Generate") == 1


def test_scan_prunes_columns(spark):
    df = E.queries()["programs_type_code"](spark, SF_SMALL)
    p = _plan(df)
    assert "ReadSchema: struct<p_partkey:bigint>" in p


def test_window_variant_shares_one_key_exchange(spark):
    df = E.queries()["referral_clean_window"](spark, SF_SMALL)
    p = _final_plan(df)
    assert "Window [max(" in p and "Window [row_number()" in p
    # one exchange on the two keys for the group sizes, and one that numbering,
    # distinct and the max window share
    ex = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p)
    key_ex = [e for e in ex if e.count("#") == 2]
    assert len(key_ex) == 2, ex


def test_referral_scans_get_key_null_filters(spark):
    from pyspark.sql import functions as F

    from sheetcraft.operators import referrals as R
    from sheetcraft.plans import adapters as A
    from sheetcraft.sources.files import materialize

    export = A.referral_export(spark, SF_SMALL)
    table = materialize(export.withColumn("ReferralID", F.col("ReferralID")), "t-plan-referrals")
    out = R.clean_referrals(R.filter_search_logs(table))
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        p = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    assert "IsNotNull(ReferralID)" in p
    assert "Or(IsNull(ReferralID)" in p
