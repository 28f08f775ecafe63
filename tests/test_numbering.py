"""Numbering and forward fill over range partitions equal the plain window."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sheetcraft.operators import numbering as N
from sheetcraft.operators import referrals as R
from sheetcraft.operators.reshape import distinct_rows, forward_fill
from sheetcraft.plans import catalog as C

from .conftest import SF_SMALL


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def plain(df, keys, order, out):
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return df.withColumn(out, F.row_number().over(window).cast("bigint"))


def test_numbering_equals_the_window(spark):
    base = R.parse_times(R.anonymise(C._search_logs(spark, SF_SMALL)))
    keyed = R._project(base.withColumn(R.SEARCH_NO, F.lit(None).cast("bigint"))).drop(R.SEARCH_NO)
    keyed = keyed.filter(R.keys_present())
    want = R._project(keyed.withColumn(R.SEARCH_NO, F.row_number().over(R._number_window()).cast("bigint")))
    assert same(R.number_searches(base).filter(R.keys_present()), want)


def test_hot_null_and_small_groups(spark):
    rows = [("k" if i % 3 else None, None if i % 7 == 0 else f"v{i % 130}", i) for i in range(400)]
    rows += [(f"s{i % 50}", "x", i) for i in range(120)]
    df = spark.createDataFrame(rows, "k string, v string, w int")
    assert same(N.number_rows(df, ["k"], ["v", "w"], "n"), plain(df, ["k"], ["v", "w"], "n"))


def test_copies_of_one_row(spark):
    rows = [("k", "same", 1)] * 300 + [("k", f"v{i}", i) for i in range(100)]
    df = spark.createDataFrame(rows, "k string, v string, w int")
    assert same(N.number_rows(df, ["k"], ["v", "w"], "n"), plain(df, ["k"], ["v", "w"], "n"))


def test_empty_table(spark):
    df = spark.createDataFrame([], "k string, v string")
    assert N.number_rows(df, ["k"], ["v"], "n").count() == 0
    assert forward_fill(df, ["v"], ["k"], ["k"]).count() == 0


@pytest.mark.parametrize("copies", [False, True])
def test_largest_part_shrinks_with_partitions(spark, copies):
    """One key holds all rows: more partitions, fewer rows in each, be the
    rows distinct or copies of one row."""
    df = spark.range(20_000).select(F.lit("k").alias("k"), (F.lit(0) if copies else F.col("id")).alias("v"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    largest = {}
    try:
        for n in (4, 16):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            parts = N.in_order(df, ["k"], ["v"]).groupBy(N.PART).count()
            largest[n] = parts.agg(F.max("count")).first()[0]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert largest[4] < 20_000 / 2 and largest[16] < largest[4] / 2


def test_forward_fill_equals_the_window(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderpriority")
    blank = o.withColumn("p", F.when(F.col("o_orderkey") % 5 == 0, F.col("o_orderpriority")))
    for group in (F.lit(0), F.when(F.col("o_custkey") % 2 == 0, F.col("o_custkey") % 4)):
        df = blank.withColumn("g", group)
        w = Window.partitionBy("g").orderBy("o_orderkey").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        assert same(forward_fill(df, ["p"], ["g"], ["o_orderkey"]), df.withColumn("p", F.last("p", True).over(w)))


def test_clean_methods_agree(spark):
    logs = C._search_logs(spark, SF_SMALL)
    want = R.clean_referrals(logs)
    for method in ("window", "antijoin"):
        assert same(want, R.clean_referrals(logs, method=method))


def test_dedup_first_counts_a_copy_once(spark):
    logs = C._search_logs(spark, SF_SMALL).filter(R.keys_present()).limit(3)
    many = logs
    for _ in range(4):
        many = many.unionByName(many)
    assert R.clean_referrals(many).count() < R.clean_referrals(many, dedup_first=True).count()
    assert same(R.clean_referrals(many, dedup_first=True), R.clean_referrals(logs, dedup_first=True))


def test_rows_are_shuffled_once(spark):
    """The rows of the written table are read in place: no window, no exchange."""
    out = R.number_searches(R.parse_times(R.anonymise(C._search_logs(spark, SF_SMALL)))).filter(R.keys_present())
    out.write.format("noop").mode("overwrite").save()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window [row_number" not in plan and "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_a_limit_of_rows_a_file_changes_nothing(spark):
    df = spark.range(500).select(F.lit("k").alias("k"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "7")
    try:
        got = N.number_rows(df, ["k"], ["v"], "n")
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert got.where("n <> v + 1").count() == 0 and got.count() == 500


def test_distinct_rows_equal_dropped_duplicates(spark):
    rows = [(f"t{i % 90}" * 40, i % 2, None if i % 9 == 0 else float(i % 90)) for i in range(600)]
    rows += [(None, None, None)] * 3 + [("once", 1, 0.0), ("zero", 1, 0.0), ("zero", 1, -0.0)] + [("hot", 1, 1.0)] * 400
    df = spark.createDataFrame(rows, "a string, h1 int, `a.b` double")
    got = distinct_rows(df)
    assert got.columns == df.columns
    assert same(got, df.dropDuplicates())
    assert distinct_rows(df.limit(0)).count() == 0
