"""The two end-to-end jobs: referral processing and program action logs.

Each reads a folder of workbook exports through the refresh-if-stale
materialization, runs the DataFrame steps, writes the result as Parquet and
CSV, and returns the Parquet table.  A ``RunReport`` takes the rows read, kept
and removed and the time of each stage.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetcraft.operators import action_logs, referrals
from sheetcraft.operators.metrics import RunReport
from sheetcraft.sources import files as FS
from sheetcraft.sources.refresh import WorkbookRefresher

log = logging.getLogger(__name__)

# Output file names of the referral job.
REFERRALS_CSV = "ProcessedReferrals.csv"
FILTERS_CSV = "ProcessedReferralFiltersOnly.csv"
ACTION_LOGS_CSV = "ProcessedActionLogs.csv"


def _saved(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def process_referrals(
    spark: SparkSession,
    source: str,
    out_dir: str,
    target: str | None = None,
    policy: str = "check",
    notes_schema: str | None = None,
    report: RunReport | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Workbooks -> search logs (materialized, refreshed per ``policy``) ->
    cleaned referrals (written once as Parquet, shared by both outputs) ->
    ``ProcessedReferrals.csv`` without notes and
    ``ProcessedReferralFiltersOnly.csv`` with one row per notes filter."""
    out_dir = out_dir.rstrip("/")
    refresher = WorkbookRefresher(
        spark, source, target or f"{out_dir}/_materialized", pre_process=referrals.filter_search_logs
    )
    report = report or RunReport("referrals")
    logs = refresher.refresh(policy)
    cleaned_path, main_path, filters_path = (f"{out_dir}/_{x}" for x in ("cleaned", "referrals", "filters"))
    report.run("read", lambda: report.watch(logs, read=None).write.format("noop").mode("overwrite").save())
    cleaned = report.watch(referrals.clean_referrals(logs), kept=None)
    report.run("clean", lambda: cleaned.write.mode("overwrite").parquet(cleaned_path))
    log.info("referrals: removed=%d", report.count("read") - report.count("kept"))
    cleaned = spark.read.parquet(cleaned_path)
    main = _saved(cleaned.drop(referrals.NOTES), main_path)
    report.run("referrals csv", lambda: FS.write_csv(report.watch(main, referrals=None), f"{out_dir}/{REFERRALS_CSV}"))
    filters = _saved(referrals.process_referral_notes(cleaned, schema=notes_schema), filters_path)
    report.run("filters csv", lambda: FS.write_csv(report.watch(filters, filters=None), f"{out_dir}/{FILTERS_CSV}"))
    return main, filters


def process_action_logs(
    spark: SparkSession,
    source: str,
    out_dir: str,
    target: str | None = None,
    policy: str = "check",
    report: RunReport | None = None,
) -> DataFrame:
    """Workbooks -> renamed 7-column program action log -> CSV with a leading
    0-based ``index`` in file, sheet and row order (computed without a
    single-task window)."""
    out_dir = out_dir.rstrip("/")
    order = ["path", "sheet_pos", "_row"]

    def rename_keep_order(df: DataFrame) -> DataFrame:
        renamed = action_logs.rename_program_action_log(df)
        return df.withColumnsRenamed(action_logs.RENAMES).select(
            *order, *[F.col(f"`{c}`") for c in renamed.columns]
        )

    refresher = WorkbookRefresher(
        spark, source, target or f"{out_dir}/_materialized", pre_process=rename_keep_order, with_source=True
    )
    table = refresher.refresh(policy)
    indexed = FS.with_row_index(table, order).drop(*order)
    out = indexed.select("index", *[F.col(f"`{c}`") for c in action_logs.OUT_COLUMNS])
    report = report or RunReport("action logs")
    path = f"{out_dir}/_action_logs"
    report.run("index", lambda: report.watch(out, read=None).write.mode("overwrite").parquet(path))
    out = spark.read.schema(out.schema).parquet(path)
    report.run("csv", lambda: FS.write_csv(report.watch(out, written=None), f"{out_dir}/{ACTION_LOGS_CSV}"))
    return out
