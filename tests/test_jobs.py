"""End-to-end jobs: outputs, CSV files and the action-log index."""

import os

from pyspark.sql import functions as F

from sheetcraft.plans import adapters as A
from sheetcraft.plans import jobs as JOBS
from sheetcraft.plans.catalog import export_workbooks
from sheetcraft.session import local_path, scratch_dir

from .conftest import SF_SMALL


def test_action_log_index_follows_file_and_row_order(spark):
    logs = A.adapter(spark, SF_SMALL, "logs")
    export = logs.select(
        F.col("referral_id").alias("WLS ID"), F.col("recorded_by").alias("Recorded By"),
        F.col("log_name").alias("Recorded Date"), F.col("log_name").alias("Date of Action"),
        F.col("log_name").alias("Action Log Name"), F.col("log_type").alias("Action Log Type"),
        F.col("notes").alias("Notes"),
    )
    src = export_workbooks(export, "t-job-src", rows_per_file=100)
    out_dir = scratch_dir(spark, "t-job-out")
    out = JOBS.process_action_logs(spark, src, out_dir)
    assert out.columns[0] == "index"
    n = out.count()
    assert n == logs.count()
    stats = out.agg(F.min("index"), F.max("index"), F.countDistinct("index")).first()
    assert tuple(stats) == (0, n - 1, n)
    assert os.path.isdir(os.path.join(local_path(out_dir), JOBS.ACTION_LOGS_CSV))


def test_referral_job_writes_both_files(spark):
    src = export_workbooks(A.referral_export(spark, SF_SMALL), "t-job-ref")
    out_dir = scratch_dir(spark, "t-job-ref-out")
    main, filters = JOBS.process_referrals(spark, src, out_dir)
    assert "Notes" not in main.columns and {"k", "name", "value"} <= set(filters.columns)
    for name in (JOBS.REFERRALS_CSV, JOBS.FILTERS_CSV):
        assert os.path.isdir(os.path.join(local_path(out_dir), name))
    first = main.count()
    # second run: nothing stale, same outputs (the first frames' files are replaced)
    main2, _ = JOBS.process_referrals(spark, src, out_dir)
    assert main2.count() == first


def test_jobs_report_their_rows(spark):
    from sheetcraft.operators.metrics import RunReport

    src = export_workbooks(A.referral_export(spark, SF_SMALL), "t-job-report")
    report = RunReport("t")
    main, filters = JOBS.process_referrals(spark, src, scratch_dir(spark, "t-job-report-out"), report=report)
    assert [r.stage for r in report.records] == ["read", "clean", "referrals csv", "filters csv"]
    assert report.count("kept") == main.count() == report.count("referrals") <= report.count("read")
    assert report.count("filters") == filters.count()
    assert all(r.seconds >= 0 for r in report.records)


def test_clear_scratch(spark):
    from sheetcraft.session import _scratch_base, clear_scratch

    made = local_path(scratch_dir(spark, "t-clear"))
    assert os.path.isdir(made)
    clear_scratch(spark)
    assert not os.path.exists(local_path(_scratch_base(spark)))
    assert os.path.isdir(local_path(scratch_dir(spark, "t-clear")))
