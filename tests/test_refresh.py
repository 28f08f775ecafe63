"""Refresh policies: which files are parsed, what the table holds."""

import os
import time

import pytest
from pyspark.sql import functions as F

from sheetcraft.plans.catalog import export_workbooks
from sheetcraft.session import local_path, scratch_dir
from sheetcraft.sources import workbooks as W
from sheetcraft.sources.refresh import WorkbookRefresher


@pytest.fixture()
def setup(spark):
    cust = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    src = export_workbooks(cust, "t-refresh", rows_per_file=40)
    return cust, src


def test_policies(spark, setup):
    cust, src = setup
    n = cust.count()
    r = WorkbookRefresher(spark, src, scratch_dir(spark, "t-target"))
    files = sorted(os.listdir(local_path(src)))
    assert r.is_stale()
    assert r.refresh("check").count() == n and r.parsed_count == len(files) and r.last_parsed == ["*"]
    assert not r.is_stale()
    assert r.refresh("check").count() == n and r.last_parsed == []
    p0 = os.path.join(local_path(src), files[0])
    os.utime(p0, (time.time() + 10, time.time() + 10))
    assert r.refresh("check").count() == n
    assert [os.path.basename(p) for p in r.last_parsed] == [files[0]]
    gone = os.path.join(local_path(src), files[1])
    gone_rows = W.to_table(W.scan_workbooks(spark, gone)).count()
    os.remove(gone)
    after_delete = r.refresh("check").count()
    assert after_delete == n - gone_rows and r.last_parsed == []
    with open(os.path.join(local_path(src), files[2]), "wb") as fh:
        fh.write(b"broken")
    assert r.refresh("fallback").count() == after_delete
    with pytest.raises(Exception):
        r.refresh("check")
    assert r.refresh("only_cached").count() == after_delete
    with pytest.raises(Exception):
        r.refresh("force")


def test_processors_and_fingerprint(spark, setup):
    cust, src = setup
    tgt = scratch_dir(spark, "t-target2")
    r = WorkbookRefresher(spark, src, tgt, post_process=lambda d: d.withColumn("post", F.lit(1)))
    r.refresh("check")
    r.register_pre_process(lambda d: d.filter(F.col("c_acctbal") > 0))
    assert r.is_stale()  # a changed pre-processor makes the table stale
    t = r.refresh("check")
    assert t.count() == cust.filter("c_acctbal > 0").count()
    assert "post" in t.columns
    raw = spark.read.parquet(r.table_path)
    assert "post" not in raw.columns


def test_skip_and_only_cached_and_csv(spark, setup):
    cust, src = setup
    r = WorkbookRefresher(spark, src, scratch_dir(spark, "t-target3"), fmt="csv")
    with pytest.raises(FileNotFoundError):
        r.refresh("only_cached")
    assert r.refresh("skip").count() == cust.count()
    assert r.table_path is None
    t = r.refresh("check")
    assert t.count() == cust.count()
    assert dict(t.dtypes)["c_acctbal"] == "double"
    assert r.refresh(lambda ref: ref.read_cache().limit(3)).count() == 3
    with pytest.raises(ValueError):
        r.refresh("nope")


def test_empty_folder_gives_empty_table(spark):
    src = scratch_dir(spark, "t-empty-src")
    r = WorkbookRefresher(spark, src, scratch_dir(spark, "t-empty-target"))
    t = r.refresh("check")
    assert t.count() == 0 and t.columns == []
    assert W.to_table(W.scan_workbooks(spark, src)).count() == 0


def test_a_failed_refresh_changes_nothing(spark, setup):
    cust, src = setup
    tgt = scratch_dir(spark, "t-target4")
    n = WorkbookRefresher(spark, src, tgt).refresh("check").count()

    def fails(df):
        raise ValueError("no")

    broken = WorkbookRefresher(spark, src, tgt, pre_process=fails)
    with pytest.raises(ValueError):
        broken.refresh("check")
    late = WorkbookRefresher(spark, src, tgt, pre_process=lambda d: d.withColumn("x", F.raise_error(F.lit("late"))))
    with pytest.raises(Exception):
        late.refresh("check")
    assert broken.is_stale() and late.is_stale()
    assert WorkbookRefresher(spark, src, tgt).refresh("only_cached").count() == n
    assert not WorkbookRefresher(spark, src, tgt).is_stale()


def test_force_on_a_bad_file_keeps_the_data(spark, setup):
    cust, src = setup
    r = WorkbookRefresher(spark, src, scratch_dir(spark, "t-target5"))
    n = r.refresh("check").count()
    name = sorted(os.listdir(local_path(src)))[0]
    with open(os.path.join(local_path(src), name), "wb") as fh:
        fh.write(b"broken")
    with pytest.raises(Exception):
        r.refresh("force")
    assert r.refresh("fallback").count() == n


def _at_least(low):
    return lambda d: d.filter(F.col("c_custkey") >= low)


def test_captured_values_are_part_of_the_fingerprint(spark, setup):
    from functools import partial

    cust, src = setup
    tgt = scratch_dir(spark, "t-target6")
    for low in (2, 7, 7):
        t = WorkbookRefresher(spark, src, tgt, pre_process=_at_least(low)).refresh("check")
        assert t.count() == cust.filter(F.col("c_custkey") >= low).count()
    same = WorkbookRefresher(spark, src, tgt, pre_process=_at_least(7))
    assert not same.is_stale()
    prints = {WorkbookRefresher(spark, src, tgt, pre_process=partial(lambda d, k: d, k=k)).fingerprint for k in (1, 2)}
    assert len(prints) == 2


def test_generations_are_merged_and_swept(spark, setup, monkeypatch):
    from sheetcraft.sources import refresh as M

    monkeypatch.setattr(M, "MAX_GENERATIONS", 2)
    cust, src = setup
    r = WorkbookRefresher(spark, src, scratch_dir(spark, "t-target7"))
    n = r.refresh("check").count()
    files = sorted(os.listdir(local_path(src)))
    for k in range(3):
        p = os.path.join(local_path(src), files[k])
        os.utime(p, (time.time() + 10 + k, time.time() + 10 + k))
        assert r.refresh("check").count() == n and r.parsed_count == 1
    cells = [x for x in os.listdir(local_path(r.target) + "/cells") if x.startswith("g=")]
    assert len(cells) <= 4 and len(os.listdir(local_path(r.target) + "/table")) == 2


def _parquet_files(folder):
    return {os.path.join(d, f) for d, _, names in os.walk(local_path(folder)) for f in names if f.endswith(".parquet")}


def _cells_read(r):
    return [os.path.basename(p) for p in r.last_parsed]


def _rewrite(spark, src, name, df):
    """Put the workbook of ``df`` in the place of a file."""
    made = export_workbooks(df.coalesce(1), "t-one", rows_per_file=10_000, prefix="one")
    parts = [W.to_table(W.scan_workbooks(spark, made))]
    assert parts[0].count() == df.count()
    names = os.listdir(local_path(made))
    kept = max(names, key=lambda f: os.path.getsize(os.path.join(local_path(made), f)))
    os.replace(os.path.join(local_path(made), kept), os.path.join(local_path(src), name))


def test_row_wise_refresh_writes_only_what_changed(spark, setup):
    cust, src = setup
    tgt = scratch_dir(spark, "t-rows")
    make = lambda **kw: WorkbookRefresher(spark, src, tgt, row_wise=True, pre_process=_at_least(3), **kw)
    r = make()
    whole = lambda: W.to_table(W.scan_workbooks(spark, src)).filter("c_custkey >= 3")
    same = lambda a, b: a.columns == b.columns and a.dtypes == b.dtypes and not a.exceptAll(b).count() and not b.exceptAll(a).count()
    assert same(r.refresh("check"), whole())
    files = sorted(os.listdir(local_path(src)))
    before = _parquet_files(f"{tgt}/parts")
    one = spark.range(1).select(
        *[F.lit(7 if c == "c_custkey" else None).cast(t).alias(c) if c != "c_name" else F.lit("new").alias(c) for c, t in cust.dtypes]
    )
    _rewrite(spark, src, files[0], one.repartition(1))
    assert make().is_stale()
    assert same(r.refresh("check"), whole())
    assert _cells_read(r) == [files[0]]
    after = _parquet_files(f"{tgt}/parts")
    assert before <= after  # the rows of the other files were not written again
    assert spark.read.parquet(*[f"file:{p}" for p in after - before]).count() == 1
    os.remove(os.path.join(local_path(src), files[1]))
    assert same(r.refresh("check"), whole()) and _parquet_files(f"{tgt}/parts") <= after
    assert not make().is_stale()
    # any reader of the target finds the rows
    assert same(WorkbookRefresher(spark, src, tgt).refresh("only_cached"), whole())


def test_row_wise_refresh_when_columns_change(spark, setup):
    """A text in a numeric column, and a new column, change every row's type."""
    cust, src = setup
    r = WorkbookRefresher(spark, src, scratch_dir(spark, "t-rows2"), row_wise=True)
    assert dict(r.refresh("check").dtypes)["c_custkey"] == "bigint"
    name = sorted(os.listdir(local_path(src)))[0]
    odd = cust.limit(2).select(F.lit("x1").alias("c_custkey"), "c_name", F.lit(1).alias("Extra"))
    _rewrite(spark, src, name, odd)
    t = r.refresh("check")
    want = W.to_table(W.scan_workbooks(spark, src))
    assert t.dtypes == want.dtypes and dict(t.dtypes)["c_custkey"] == "string" and "Extra" in t.columns
    assert not t.exceptAll(want).count() and not want.exceptAll(t).count()
    with pytest.raises(ValueError):
        WorkbookRefresher(spark, src, r.target, row_wise=True, pre_process=lambda d: d.select("c_name")).refresh("check")
    assert r.refresh("only_cached").count() == want.count()
    with pytest.raises(ValueError):
        WorkbookRefresher(spark, src, r.target, row_wise=True, fmt="csv")


class _Least:
    def __init__(self, low):
        self.low = low

    def __call__(self, df):
        return df.filter(F.col("c_custkey") >= self.low)


def test_a_changed_processor_parses_nothing_again(spark, setup):
    """Objects are told apart by class and attributes; cells stay."""
    cust, src = setup
    tgt = scratch_dir(spark, "t-object")
    WorkbookRefresher(spark, src, tgt, pre_process=_Least(2)).refresh("check")
    assert not WorkbookRefresher(spark, src, tgt, pre_process=_Least(2)).is_stale()
    r = WorkbookRefresher(spark, src, tgt, pre_process=_Least(9))
    assert r.is_stale()
    assert r.refresh("check").count() == cust.filter("c_custkey >= 9").count() and r.parsed_count == 0
