"""Query catalog: name -> Spark query over the driver's tables.

Each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame with
snake_case columns that match the DuckDB oracle of the same name
(``sheetcraft.plans.oracle``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetcraft.functions import jsonpath as J
from sheetcraft.functions import urls as U
from sheetcraft.functions.regions import REGIONS, counties
from sheetcraft.functions.text import snake
from sheetcraft.operators import action_logs, referrals
from sheetcraft.operators import headers as H
from sheetcraft.operators import programs as P
from sheetcraft.operators import reshape as R
from sheetcraft.plans import adapters as A
from sheetcraft.plans import jobs as JOBS
from sheetcraft.session import scratch_dir
from sheetcraft.sources import files as FS
from sheetcraft.sources import workbooks as W
from sheetcraft.sources.refresh import WorkbookRefresher

Query = Callable[[SparkSession, str], DataFrame]

REFERRAL_SNAKE = {
    referrals.REFERRAL_ID: "referral_id",
    referrals.ACTION_DATE: "action_ts",
    referrals.SEARCH_NO: "search_no",
    referrals.RECORDED_BY: "recorded_by",
    "Type": "type",
    "County": "county",
    "City": "city",
    "Zipcode": "zipcode",
    referrals.LOG_NAME: "log_name",
    referrals.LOG_TYPE: "log_type",
    referrals.NOTES: "notes",
}


def _snake_referrals(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in REFERRAL_SNAKE.items() if k in df.columns})


def _search_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Referral export filtered to the two search log names (the reader's
    pre-processor in the reference)."""
    return referrals.filter_search_logs(A.referral_export(spark, sf_dir))


# --- referral pipeline ------------------------------------------------------


def referral_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snake_referrals(referrals.clean_referrals(_search_logs(spark, sf_dir)))


def referral_clean_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snake_referrals(referrals.clean_referrals(_search_logs(spark, sf_dir), method="window"))


def referral_clean_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snake_referrals(referrals.clean_referrals(_search_logs(spark, sf_dir), method="antijoin"))


def referral_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snake_referrals(referrals.process_referral_action_logs(_search_logs(spark, sf_dir)))


def referral_without_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = referrals.clean_referrals(_search_logs(spark, sf_dir))
    return _snake_referrals(cleaned.drop(referrals.NOTES))


def action_log_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = A.to_display(A.adapter(spark, sf_dir, "logs"), A.LOGS_DISPLAY)
    return _snake_referrals(referrals.filter_search_logs(logs))


def referral_anonymise(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = A.to_display(A.adapter(spark, sf_dir, "logs"), A.LOGS_DISPLAY)
    out = referrals.anonymise(logs).select(referrals.REFERRAL_ID, referrals.RECORDED_BY, referrals.LOG_NAME)
    return _snake_referrals(out)


def referral_parse_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    export = A.referral_export(spark, sf_dir)
    parsed =referrals.parse_times(export.withColumn("action_text", F.col(f"`{referrals.ACTION_DATE}`")))
    return parsed.select(
        F.col(referrals.REFERRAL_ID).alias("referral_id"),
        F.col(f"`{referrals.ACTION_DATE}`").alias("action_ts"),
        "action_text",
    )


def action_log_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = A.adapter(spark, sf_dir, "logs")
    export = logs.select(
        F.col("referral_id").alias("WLS ID"),
        F.col("recorded_by").alias("Recorded By"),
        F.col("action_ts").alias("Recorded Date"),
        F.col("action_ts").alias("Date of Action"),
        F.col("log_name").alias("Action Log Name"),
        F.col("log_type").alias("Action Log Type"),
        F.col("notes").alias("Notes"),
        F.col("county").alias("County"),
        F.col("zipcode").alias("Zipcode"),
    )
    out = action_logs.rename_program_action_log(export)
    return out.toDF("program_id", "recorded_by", "recorded_date", "action_date", "log_name", "log_type", "notes")


QUERIES: dict[str, Query] = {
    "referral_clean": referral_clean,
    "referral_clean_window": referral_clean_window,
    "referral_clean_antijoin": referral_clean_antijoin,
    "referral_number": referral_number,
    "referral_without_notes": referral_without_notes,
    "action_log_filter": action_log_filter,
    "referral_anonymise": referral_anonymise,
    "referral_parse_time": referral_parse_time,
    "action_log_rename": action_log_rename,
}


# --- programs ------------------------------------------------------------------


PROGRAM_SNAKE = {v: k for k, v in {**A.PROGRAMS_DISPLAY, **A.AGES_DISPLAY}.items()}


def _snake(df: DataFrame, extra: dict[str, str] | None = None) -> DataFrame:
    mapping = {**PROGRAM_SNAKE, **(extra or {})}
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def programs_invalid_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    prog = A.programs_export(spark, sf_dir)
    return prog.select(F.col(f"`{P.RECORD_ID}`").alias("record_id"), P.invalid_programs_mask().alias("invalid"))


def programs_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = P.remove_invalid_programs(A.programs_export(spark, sf_dir))
    return _snake(out.select(P.RECORD_ID, P.STATUS))


def programs_valid_any_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = P.remove_invalid_programs(A.programs_export(spark, sf_dir), filter_status=False)
    return _snake(out.select(P.RECORD_ID, P.STATUS))


def programs_type_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = P.type_code_programs(A.programs_export(spark, sf_dir))
    return _snake(out.select(P.RECORD_ID, P.TYPE_CODE, P.PROVIDER_TYPE), {P.TYPE_CODE: "type_code"})


def programs_type_code_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = P.type_code_programs(A.programs_export(spark, sf_dir), dropna=True)
    return _snake(out.select(P.RECORD_ID, P.TYPE_CODE, P.PROVIDER_TYPE), {P.TYPE_CODE: "type_code"})


def programs_sda(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = P.sda_code_programs(A.ages_export(spark, sf_dir))
    return _snake(out.select(P.RECORD_ID, P.REGION, P.SDA), {P.SDA: "sda"})


def programs_sda_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = P.sda_code_programs(A.ages_export(spark, sf_dir), how="case")
    return _snake(out.select(P.RECORD_ID, P.REGION, P.SDA), {P.SDA: "sda"})


def programs_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = P.flag_program_types(A.programs_export(spark, sf_dir))
    flags = {n: snake(n) for n in P.PROGRAM_TYPE_NAMES}
    return _snake(out.select(P.RECORD_ID, P.PROGRAM_TYPES, *[F.col(f"`{n}`") for n in flags]), flags)


def programs_total_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = P.care_for_ages_total_months(A.ages_export(spark, sf_dir))
    return _snake(
        out.select(P.RECORD_ID, P.FROM_TOTAL, P.TO_TOTAL),
        {P.FROM_TOTAL: "from_total_months", P.TO_TOTAL: "to_total_months"},
    )


def programs_age_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = P.care_for_flag_from_total_months(P.care_for_ages_total_months(A.ages_export(spark, sf_dir)))
    names = {P.FROM_TOTAL: "f", P.TO_TOTAL: "t", P.UNKNOWN_RANGE: "unknown_care_range"}
    for (label, _, _), col in zip(P.AGE_RANGES, P.AGE_RANGE_COLUMNS):
        names[col] = snake(label)
    return _snake(out.select(P.RECORD_ID, *[F.col(f"`{c}`") for c in names]), names)


DETAIL_GROUPS = {
    "Infant": {"Rate": "infant_rate", "Capacity": "infant_capacity"},
    "Toddler": {"Rate": "toddler_rate", "Capacity": "toddler_capacity"},
}


def details_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Age details in long form (Record ID, Age Group, Rate, Capacity)."""
    wide = A.adapter(spark, sf_dir, "details").withColumnRenamed("record_id", P.RECORD_ID)
    return R.unstack_groups(wide, [P.RECORD_ID], DETAIL_GROUPS, key_casts={P.RECORD_ID: "bigint"})


def age_details_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snake(details_long(spark, sf_dir), {R.AGE_GROUP: "age_group", "Rate": "rate", "Capacity": "capacity"})


def programs_has_rate_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = P.programs_has_rates_caps(A.programs_export(spark, sf_dir), details_long(spark, sf_dir))
    return _snake(
        out.select(P.RECORD_ID, P.HAS_RATE, P.HAS_CAPACITY),
        {P.HAS_RATE: "has_rate", P.HAS_CAPACITY: "has_capacity"},
    )


def distinct_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = details_long(spark, sf_dir)
    return d.filter(F.col("Rate").isNotNull()).select(F.col(f"`{P.RECORD_ID}`").alias("record_id")).distinct()


def row_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole rows, key aside: documents' text, language, source and length."""
    return R.distinct_rows(A.read_table(spark, sf_dir, "documents").drop("doc_id"))


def rename_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = A.read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("DHS_id"),
        F.col("p_name").alias("ODHS_name"),
        F.col("p_brand").alias("brand_DHS"),
        F.col("p_size").alias("size"),
    )
    return P.dhs_to_odhs_names(part)


def drop_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = A.read_table(spark, sf_dir, "part")
    blank = (F.col("p_partkey") % 10) == 0
    with_blanks = part.select(
        F.when(~blank, F.col("p_partkey")).alias("k"),
        F.when(~blank, F.col("p_name")).alias("name"),
        F.lit(None).cast("string").alias("empty_col"),
    )
    return R.drop_empty(with_blanks)


def union_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = A.read_table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("key"), F.col("r_name").alias("name")
    )
    nation = A.read_table(spark, sf_dir, "nation").select(
        F.concat(F.lit("N"), F.col("n_nationkey")).alias("key"),
        F.col("n_name").alias("name"),
        F.col("n_regionkey").cast("bigint").alias("regionkey"),
    )
    return R.union_mixed([region, nation])


QUERIES.update(
    {
        "programs_invalid_mask": programs_invalid_mask,
        "programs_valid": programs_valid,
        "programs_valid_any_status": programs_valid_any_status,
        "programs_type_code": programs_type_code,
        "programs_type_code_only": programs_type_code_only,
        "programs_sda": programs_sda,
        "programs_sda_case": programs_sda_case,
        "programs_flags": programs_flags,
        "programs_total_months": programs_total_months,
        "programs_age_flags": programs_age_flags,
        "age_details_long": age_details_long,
        "programs_has_rate_cap": programs_has_rate_cap,
        "distinct_ids": distinct_ids,
        "row_dedup": row_dedup,
        "rename_pattern": rename_pattern,
        "drop_empty": drop_empty,
        "union_mixed": union_mixed,
    }
)


# --- notes, JSON, URLs, dimension, stage counts ----------------------------------


def notes_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    export = A.referral_export(spark, sf_dir).select(referrals.REFERRAL_ID, referrals.LOG_TYPE, referrals.NOTES)
    out = referrals.explode_filters(export, position="filter_pos")
    return _snake_referrals(out.withColumn("filter_pos", F.col("filter_pos").cast("bigint"))).withColumnRenamed(
        "notes", "filter_json"
    )


def notes_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage 6 writes the cleaned referrals; stage 7 reads that table, so the
    leaf discovery (one aggregate) and the flatten do not redo the cleaning."""
    from sheetcraft.sources.files import materialize

    cleaned = materialize(referrals.clean_referrals(_search_logs(spark, sf_dir)), "referrals-cleaned")
    return _snake_referrals(referrals.process_referral_notes(cleaned))


def json_path_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = A.read_table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        J.json_path("props", ["k"]).alias("k"),
        J.json_path("props", ["missing"], default="none").alias("missing"),
        J.json_path("props", ["k", "x"], default="not-a-map").alias("nested"),
    )


def url_absolute(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = A.read_table(spark, sf_dir, "pages")
    return pages.select("page_id", U.is_absolute_url("url").alias("is_absolute"))


def url_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = A.read_table(spark, sf_dir, "pages")
    return pages.select("page_id", U.url_text("url", on_error="null").alias("url_text"))


def url_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = A.read_table(spark, sf_dir, "pages")
    return pages.select("page_id", U.join_url_path("url", "about", on_error="null").alias("joined"))


COUNTY_NAMES = [c for _, _, cs in REGIONS for c in cs]


def county_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Programs placed in a county (one in 37 in none), coded by the county
    dimension: a broadcast of the fixed 36-row table."""
    part = A.read_table(spark, sf_dir, "part")
    names = F.array(*[F.lit(c) for c in COUNTY_NAMES])
    progs = part.select(
        F.col("p_partkey").alias("record_id"),
        F.try_element_at(names, (F.col("p_partkey") % (len(COUNTY_NAMES) + 1) + 1).cast("int")).alias("county"),
    )
    dim = counties(spark)
    out = progs.join(F.broadcast(dim), "county", "left")
    return out.select("record_id", "county", "region", "sda")


def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read, search rows, rows kept and removed by the cleaning, as one
    aggregate over the export and the cleaned rows."""
    export = A.referral_export(spark, sf_dir)
    is_search = F.col(f"`{referrals.LOG_NAME}`").isin(*referrals.SEARCH_LOG_NAMES)
    cleaned = referrals.clean_referrals(referrals.filter_search_logs(export))
    one, none = F.lit(1), F.lit(0)
    seen = export.select(one.alias("r"), F.coalesce(is_search.cast("int"), none).alias("s"), none.alias("k"))
    seen = seen.union(cleaned.select(none.alias("r"), none.alias("s"), one.alias("k")))
    total = {n: F.coalesce(F.sum(n), F.lit(0)).cast("bigint") for n in "rsk"}
    return seen.agg(
        total["r"].alias("rows_read"),
        total["s"].alias("rows_searches"),
        total["k"].alias("rows_kept"),
        (total["s"] - total["k"]).alias("rows_removed"),
    )


QUERIES.update(
    {
        "notes_filters": notes_filters,
        "notes_flatten": notes_flatten,
        "json_path_default": json_path_default,
        "url_absolute": url_absolute,
        "url_join": url_join,
        "url_normalized": url_normalized,
        "county_lookup": county_lookup,
        "stage_counts": stage_counts,
    }
)


# --- workbooks: exports written from the given tables, then scanned back ------------------


ROWS_PER_WORKBOOK = 1000


def _spread(df: DataFrame) -> DataFrame:
    """At least a partition a core: a scan deals out no less than a row group."""
    parallelism = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(parallelism) if df.rdd.getNumPartitions() < parallelism else df


def export_workbooks(df: DataFrame, name: str, **kw) -> str:
    """Write ``df`` as workbooks into a fresh shared folder; return the folder."""
    spark = df.sparkSession
    out = scratch_dir(spark, name)
    kw.setdefault("rows_per_file", ROWS_PER_WORKBOOK)
    df = _spread(df)  # writers run in parallel tasks
    W.write_workbooks(df, out, **kw).write.format("noop").mode("overwrite").save()
    return out


def _customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.read_table(spark, sf_dir, "customer")


def workbook_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> xlsx files -> directory collect (scan, header names, type
    inference, empty drop) -> table."""
    folder = export_workbooks(_customer(spark, sf_dir), "customer-xlsx")
    cells = FS.materialize(W.scan_workbooks(spark, folder), "customer-cells")
    return W.to_table(cells)


def workbook_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sheet per market segment; all sheets scanned; the sheet name is the
    segment."""
    folder = export_workbooks(_customer(spark, sf_dir), "customer-sheets", sheet_col="c_mktsegment")
    cells = FS.materialize(W.scan_workbooks(spark, folder, sheet_name=None), "customer-sheet-cells")
    t = W.to_table(cells, with_source=True)
    return t.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", F.col("sheet").alias("c_mktsegment"))


def workbook_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = export_workbooks(_customer(spark, sf_dir), "customer-catalog", sheet_col="c_mktsegment")
    return W.sheet_catalog(spark, folder).select("sheet").distinct()


def referral_clean_from_workbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole referral job as in production: exported workbooks ->
    collect -> search-log filter -> clean."""
    folder = export_workbooks(A.referral_export(spark, sf_dir), "referral-xlsx")
    cells = FS.materialize(W.scan_workbooks(spark, folder), "referral-cells")
    logs = referrals.filter_search_logs(W.to_table(cells))
    return _snake_referrals(referrals.clean_referrals(logs))


DETAIL_HEADER = ["Record ID", "Infant", "Infant", "Toddler", "Toddler"]
DETAIL_SECOND_ROW = [["Record ID", "Rate", "Capacity", "Rate", "Capacity"]]


def age_details_from_workbook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Age details exported with a two-row header -> header inference ->
    wide to long."""
    details = A.adapter(spark, sf_dir, "details").select(
        "record_id", "infant_rate", "infant_capacity", "toddler_rate", "toddler_capacity"
    )
    folder = export_workbooks(details, "details-xlsx", header=DETAIL_HEADER, header_rows=DETAIL_SECOND_ROW)
    cells = FS.materialize(W.scan_workbooks(spark, folder), "details-cells")
    wide = H.infer_header_table(cells)
    long = R.unstack_groups(wide, [P.RECORD_ID], key_casts={P.RECORD_ID: "bigint"})
    return _snake(long, {R.AGE_GROUP: "age_group", "Rate": "rate", "Capacity": "capacity"})


QUERIES.update(
    {
        "workbook_roundtrip": workbook_roundtrip,
        "workbook_sheets": workbook_sheets,
        "workbook_catalog": workbook_catalog,
        "referral_clean_from_workbooks": referral_clean_from_workbooks,
        "age_details_from_workbook": age_details_from_workbook,
    }
)


# --- refresh policies over exported workbooks ---------------------------------------------


def _positive_balance(df: DataFrame) -> DataFrame:
    return df.filter(F.col("c_acctbal") > 0)


def _customer_columns(df: DataFrame) -> DataFrame:
    return df.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


def _refresher(spark: SparkSession, sf_dir: str, name: str) -> tuple[WorkbookRefresher, str]:
    folder = export_workbooks(_customer(spark, sf_dir), f"{name}-src")
    target = scratch_dir(spark, f"{name}-target")
    r = WorkbookRefresher(spark, folder, target, pre_process=_positive_balance, post_process=_customer_columns)
    return r, folder


def refresh_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    r, _ = _refresher(spark, sf_dir, "refresh-check")
    r.refresh("check")
    return r.refresh("check")  # second call: nothing stale, reads the table


def refresh_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build, then make one source unreadable: fallback keeps its last cells."""
    import os

    from sheetcraft.session import local_path

    r, folder = _refresher(spark, sf_dir, "refresh-fallback")
    r.refresh("check")
    base = local_path(folder)
    first = sorted(f for f in os.listdir(base) if f.endswith(".xlsx"))[0]
    with open(os.path.join(base, first), "wb") as fh:
        fh.write(b"damaged")
    return r.refresh("fallback")


def refresh_force(spark: SparkSession, sf_dir: str) -> DataFrame:
    r, _ = _refresher(spark, sf_dir, "refresh-force")
    r.refresh("check")
    return r.refresh("force")


def refresh_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    r, _ = _refresher(spark, sf_dir, "refresh-skip")
    return r.refresh("skip")


def refresh_only_cached(spark: SparkSession, sf_dir: str) -> DataFrame:
    r, _ = _refresher(spark, sf_dir, "refresh-cached")
    r.refresh("check")
    return r.refresh("only_cached")


def refresh_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A caller-supplied policy: rebuild only when stale, else read."""
    r, _ = _refresher(spark, sf_dir, "refresh-custom")

    def policy(ref: WorkbookRefresher) -> DataFrame:
        return ref.refresh("check") if ref.is_stale() else ref.read_cache()

    return r.refresh(policy)


def refresh_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row-wise refresh: the first workbook's rows move to new workbooks, and a
    refresh adds the rows of these files alone."""
    import os

    from sheetcraft.session import local_path

    folder = export_workbooks(_customer(spark, sf_dir), "refresh-rows-src")
    r = WorkbookRefresher(spark, folder, scratch_dir(spark, "refresh-rows-target"), pre_process=_positive_balance, row_wise=True)
    r.refresh("check")
    base = local_path(folder)
    first = sorted(f for f in os.listdir(base) if f.endswith(".xlsx"))[0]
    rows = W.to_table(W.scan_workbooks(spark, f"{folder}/{first}"))
    made = export_workbooks(rows, "refresh-rows-new", prefix="again")
    for name in sorted(os.listdir(local_path(made))):
        if name.endswith(".xlsx"):
            os.link(os.path.join(local_path(made), name), os.path.join(base, name))
    os.remove(os.path.join(base, first))
    return _customer_columns(r.refresh("check"))


def collect_file_and_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of workbooks (customers), one workbook by its own path (the 25
    nations) and a folder without any file: a table each."""
    folder = export_workbooks(_customer(spark, sf_dir), "collect-folder")
    single = scratch_dir(spark, "collect-file")
    nation = A.read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name").coalesce(1)
    W.write_workbooks(nation, single).write.format("noop").mode("overwrite").save()
    nations = W.to_table(W.scan_workbooks(spark, f"{single}/part-00000-0000.xlsx"))
    none = W.to_table(W.scan_workbooks(spark, scratch_dir(spark, "collect-none")))
    customers = W.to_table(W.scan_workbooks(spark, folder)).unionByName(none, allowMissingColumns=True)
    return customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", "c_name", "n_name")


def refresh_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table kept as CSV, read back with the types it was written with."""
    folder = export_workbooks(_customer(spark, sf_dir), "refresh-csv-src")
    target = scratch_dir(spark, "refresh-csv-target")
    r = WorkbookRefresher(spark, folder, target, pre_process=_positive_balance, post_process=_customer_columns, fmt="csv")
    r.refresh("check")
    return r.refresh("only_cached")


QUERIES.update(
    {
        "refresh_check": refresh_check,
        "refresh_incremental": refresh_incremental,
        "refresh_csv": refresh_csv,
        "collect_file_and_folder": collect_file_and_folder,
        "refresh_fallback": refresh_fallback,
        "refresh_force": refresh_force,
        "refresh_skip": refresh_skip,
        "refresh_only_cached": refresh_only_cached,
        "refresh_custom": refresh_custom,
    }
)


# --- schema-given notes flatten; streaming ingestion --------------------------------------

NOTES_SCHEMA = "struct<k: bigint, name: string, value: string>"


def notes_flatten_given_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``notes_flatten`` with the leaf types given: no discovery pass and
    no need to write the cleaned table first."""
    cleaned = referrals.clean_referrals(_search_logs(spark, sf_dir))
    return _snake_referrals(referrals.process_referral_notes(cleaned, schema=NOTES_SCHEMA))


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer in two drops of workbooks (two market segments first, the
    others later); an available-now stream ingests the first drop, then only
    the new files of the second.  Every customer row is ingested."""
    from sheetcraft.streaming.ingest import ingest_workbooks, ingested_table

    cust = _customer(spark, sf_dir)
    drop = scratch_dir(spark, "drop")
    early = F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING")
    first = cust.filter(early)
    second = cust.filter(~early | F.col("c_mktsegment").isNull())
    W.write_workbooks(first, drop, rows_per_file=ROWS_PER_WORKBOOK, prefix="a").write.format("noop").mode(
        "overwrite"
    ).save()
    cells, ckpt = scratch_dir(spark, "stream-cells"), scratch_dir(spark, "stream-ckpt")
    ingest_workbooks(spark, drop, cells, ckpt)
    W.write_workbooks(second, drop, rows_per_file=ROWS_PER_WORKBOOK, prefix="b").write.format("noop").mode(
        "overwrite"
    ).save()
    ingest_workbooks(spark, drop, cells, ckpt)
    return ingested_table(spark, cells)


QUERIES.update({"notes_flatten_given_schema": notes_flatten_given_schema, "stream_ingest": stream_ingest})


CUSTOMER_SCHEMA = "index bigint, c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> CSV with a 0-based row index in key order (no single-task
    window) -> read back with a declared schema."""
    out = scratch_dir(spark, "customer-csv")
    FS.write_csv(_customer(spark, sf_dir), out, index=True, order_by=["c_custkey"])
    return FS.read_csv(spark, out, schema=CUSTOMER_SCHEMA, null_tokens=False)


def forward_fill_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders with the priority blanked on all but each customer's first
    order, filled back down per customer in order-key order."""
    o = A.read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    # each customer's first order key: a partial aggregate, joined back
    firsts = o.groupBy("o_custkey").agg(F.min("o_orderkey").alias("first_key"))
    blanked = o.join(firsts, "o_custkey").withColumn(
        "p", F.when(F.col("o_orderkey") == F.col("first_key"), F.col("o_orderpriority"))
    )
    filled = R.forward_fill(blanked, ["p"], ["o_custkey"], ["o_orderkey"])
    return filled.select("o_orderkey", "o_custkey", F.col("p").alias("first_priority"))


def csv_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> CSV -> back: line breaks, quotes, outer blanks, empty and
    null texts come back as they were."""
    out = scratch_dir(spark, "documents-csv")
    docs = A.read_table(spark, sf_dir, "documents")
    n = F.col("doc_id") % 6
    text = (
        F.when(n == 0, F.col("text"))
        .when(n == 1, F.concat(F.lit("  "), F.col("text"), F.lit("\t ")))
        .when(n == 2, F.concat(F.lit('"'), F.col("text"), F.lit('",\r\n"')))
        .when(n == 3, F.lit(""))
        .when(n == 4, F.concat(F.col("text"), F.lit("\\")))
    )
    FS.write_csv(docs.select("doc_id", text.alias("text"), "lang"), out)
    return FS.read_csv(spark, out, schema="doc_id bigint, text string, lang string", null_tokens=False)


QUERIES.update({"csv_text_roundtrip": csv_text_roundtrip, "csv_roundtrip": csv_roundtrip, "forward_fill_sheet": forward_fill_sheet})


# --- cells built from the given tables (no workbook in between) -------------------------


def cells_of(df: DataFrame, path: Column, line: Column, cells: list[Column], heads: dict[str, list[list[str | None]]]) -> DataFrame:
    """Cells as a scan gives them: data rows of ``df`` in the sheet ``path``
    at ``line``, and each sheet's header rows.  A cell is (tag, text) or null."""
    spark = df.sparkSession
    kind = "array<struct<t: string, v: string>>"
    data = df.select(path.alias("path"), line.cast("int").alias("_line"), F.array(*cells).cast(kind).alias("cells"))
    rows = [(p, i, [None if t is None else ("s", t) for t in row]) for p, own in heads.items() for i, row in enumerate(own)]
    both = data.unionByName(spark.createDataFrame(rows, f"path string, _line int, cells {kind}"))
    layouts = spark.createDataFrame([(p, W._layout_key([None if t is None else ("s", t) for t in own[0]])) for p, own in heads.items()],
                                    "path string, layout string")
    return both.join(F.broadcast(layouts), "path").select(
        "path", F.lit(None).cast("timestamp").alias("mtime"), F.lit(0).alias("sheet_pos"), F.lit("s").alias("sheet"),
        F.col("_line").alias("_row"), "_line", "layout", "cells", F.lit(None).cast("string").alias("error"),
    )


def _cell(tag: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.struct(F.lit(tag).alias("t"), value.cast("string").alias("v")))


def _detail_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Details as two sheets with one top row and different rows below it."""
    d = A.adapter(spark, sf_dir, "details")
    even = F.col("record_id") % 2 == 0
    pairs = [(f"{g}_rate", f"{g}_capacity") for g in ("infant", "toddler")]
    cells = [_cell("n", F.col("record_id"))]
    for rate, capacity in pairs:
        cells.append(F.when(even, _cell("n", F.col(rate))).otherwise(_cell("n", F.col(capacity))))
        cells.append(F.when(even, _cell("n", F.col(capacity))).otherwise(_cell("n", F.col(rate))))
    top = ["Record ID", "Infant", "Infant", "Toddler", "Toddler"]
    heads = {"even": [top, [None, "Rate", "Capacity", "Rate", "Capacity"]], "odd": [top, [None, "Capacity", "Rate", "Capacity", "Rate"]]}
    return cells_of(d, F.when(even, "even").otherwise("odd"), F.abs("record_id") + 10, cells, heads)


def headers_from_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = H.infer_header_table(_detail_cells(spark, sf_dir))
    names = [(g, m) for g in ("Infant", "Toddler") for m in ("Rate", "Capacity")]
    return t.select(F.col("Record ID").alias("record_id"), *[F.col(f"{g}.{m}").alias(f"{g}_{m}".lower()) for g, m in names])


def headers_custom_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule of the caller: the row below names the measure, in lower case."""

    def rule(names, rows):
        below = [names[0]] + [str(x).lower() for x in rows[0][1:]]
        levels = [[n.split(".")[0], b] for n, b in zip(names, below)]
        return H.HeaderSpec([n.split(".")[0] for n in names], 1, [0], levels)

    t = H.infer_header_table(_detail_cells(spark, sf_dir), inferrer=rule)
    names = [(g, m) for g in ("Infant", "Toddler") for m in ("rate", "capacity")]
    return t.select(F.col("Record ID").alias("record_id"), *[F.col(f"{g}.{m}").alias(f"{g}_{m}".lower()) for g, m in names])


def headers_all_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One header row whose repeated names a function makes unique: the table
    stays flat."""
    d = A.adapter(spark, sf_dir, "details")
    cells = [_cell("n", F.col(c)) for c in ("record_id", "infant_rate", "infant_capacity")]
    cells = cells_of(d, F.lit("x"), F.abs("record_id") + 10, cells, {"x": [["id", "infant", "infant"]]})
    return H.infer_header_table(cells, pattern=r"\.(\d+)$", repl=lambda m: f"_{m[1]}")


def table_from_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as two sheets of different columns: union by name, exact large
    integers, a column that mixes numbers, texts and the text ``nan``."""
    c = A.read_table(spark, sf_dir, "customer")
    first = F.col("c_custkey") % 3 == 0
    key = _cell("n", F.col("c_custkey") + F.lit(9007199254740993))
    text = F.when(F.col("c_custkey") % 5 == 0, F.lit("nan")).otherwise(F.col("c_name"))
    cells = [
        key,
        F.when(first, _cell("n", F.col("c_acctbal"))).otherwise(_cell("s", text)),
        F.when(first, _cell("n", F.col("c_nationkey"))).otherwise(_cell("s", F.col("c_mktsegment"))),
    ]
    heads = {"a": [["key", "balance", "mixed"]], "b": [["key", "mixed", "segment"]]}
    return W.to_table(cells_of(c, F.when(first, "a").otherwise("b"), F.col("c_custkey") + 1, cells, heads), null_tokens=False)


def odd_headers_from_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as two sheets whose headers are no column names: dots,
    back-ticks, a repeated text, and texts that differ in case alone."""
    c = A.read_table(spark, sf_dir, "customer")
    first = F.col("c_custkey") % 2 == 0
    cells = [
        _cell("n", F.col("c_custkey")),
        _cell("n", F.when(F.col("c_custkey") % 3 == 0, F.col("c_acctbal"))),
        _cell("s", F.col("c_name")),
        _cell("s", F.col("c_mktsegment")),
        _cell("n", F.col("c_nationkey")),
    ]
    heads = {"a": [["No.", "a.b", "a`b", "x", "x"]], "b": [["No.", "A.b", "a`b", "x", "X"]]}
    t = W.to_table(cells_of(c, F.when(first, "a").otherwise("b"), F.col("c_custkey") + 1, cells, heads))
    return t.toDF("no", "a_b", "a_tick_b", "x", "x_1", "upper_a_b", "upper_x")


def union_of_odd_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tables that share header texts but for case: union, empty drop and
    wide to long, all by position."""
    o = A.read_table(spark, sf_dir, "orders")
    key = F.col("o_orderkey").alias("No.")
    even = o.where("o_orderkey % 2 = 0").select(key, F.col("o_totalprice").alias("Infant (0.5-1).Rate"), F.lit(None).cast("int").alias("none."))
    odd = o.where("o_orderkey % 2 = 1").select(key, F.col("o_totalprice").alias("infant (0.5-1).rate"), F.substring("o_orderpriority", 1, 1).cast("int").alias("b`t"))
    wide = R.drop_empty(R.union_mixed([even, odd]))
    groups = {"Infant (0.5-1)": {"Rate": "Infant (0.5-1).Rate"}, "infant (0.5-1)": {"Rate": "infant (0.5-1).rate", "b`t": "b`t"}}
    return R.unstack_groups(wide, ["No."], groups).toDF("no", "age_group", "rate", "b_t")


def notes_case_twins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes whose filters hold keys that differ in case, a repeated key, NaN
    and infinities, a text that looks like an object, and text after the JSON."""
    e = _spread(A.read_table(spark, sf_dir, "events").select("event_id", "user_id"))
    n, who = F.col("event_id"), F.col("user_id")
    at = F.format_string
    note = (
        F.when(n % 6 == 0, at('{"Filters":[{"a":%d,"id":"x"}]}', who))
        .when(n % 6 == 1, at('{"Filters":[{"A":%d},{"a":1,"a":%d}]}', who, who))
        .when(n % 6 == 2, at('{"Filters":["{\\"a\\":%d}"]}', who))
        .when(n % 6 == 3, at('{"Filters":[{"b":{"c":NaN,"C":%d},"ID":-Infinity}]}', who))
        .when(n % 6 == 4, at('{"Filters":[{"a":%d}]} and more', who))
        .otherwise(at('{"Filters":[{"b":{"c":"NaN"},"ID":%d}],"Filters":[{"b":{"c":"NaN %d"}}]}', who, who))
    )
    t = referrals.process_referral_notes(e.select(n.alias("id"), note.alias(referrals.NOTES)))
    return t.toDF("event_id", "upper_a", "upper_id", "a", "b_upper_c", "b_c", "id")


def typed_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns that become numbers only where no value changes its text."""
    c = A.read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    texts = c.select(
        k.cast("string").alias("key"),
        F.when(k % 7 == 0, F.lpad(k.cast("string"), 6, "0")).otherwise(k.cast("string")).alias("code"),
        (k.cast("decimal(38,0)") + F.lit("9223372036854775807").cast("decimal(38,0)")).cast("string").alias("large"),
        F.when(k % 2 == 0, F.lit("true")).otherwise(F.lit("false")).alias("flag"),
        F.when(k % 2 == 0, F.lit("1.50")).otherwise(F.lit("1.5")).alias("price"),
        (k.cast("double") + 0.5).cast("string").alias("half"),
    )
    t = R.retype(texts)
    kinds = dict(t.dtypes)
    large = F.col("large").cast("decimal(38,0)").cast("string").alias("large")
    return t.select("key", "code", large, F.lit(kinds["large"].startswith("decimal")).alias("large_is_number"), "flag", "price", "half")


QUERIES.update(
    {
        "headers_from_cells": headers_from_cells,
        "headers_custom_rule": headers_custom_rule,
        "headers_all_unique": headers_all_unique,
        "table_from_cells": table_from_cells,
        "odd_headers_from_cells": odd_headers_from_cells,
        "union_of_odd_headers": union_of_odd_headers,
        "notes_case_twins": notes_case_twins,
        "typed_texts": typed_texts,
    }
)


# --- end-to-end jobs over exported workbooks --------------------------------------------

def _referral_job(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    folder = export_workbooks(A.referral_export(spark, sf_dir), "job-referral-src")
    return JOBS.process_referrals(spark, folder, scratch_dir(spark, "job-referral-out"))


def job_referrals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snake_referrals(_referral_job(spark, sf_dir)[0])


def job_referral_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snake_referrals(_referral_job(spark, sf_dir)[1])


def job_action_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Program action logs exported as workbooks (with two extra columns the
    job drops) -> the job's CSV, compared without its file-order index."""
    logs = A.adapter(spark, sf_dir, "logs")
    export = logs.select(
        F.col("referral_id").alias("WLS ID"),
        F.col("recorded_by").alias("Recorded By"),
        F.date_format("action_ts", "yyyy-MM-dd HH:mm:ss").alias("Recorded Date"),
        F.date_format("action_ts", "yyyy-MM-dd HH:mm:ss").alias("Date of Action"),
        F.col("log_name").alias("Action Log Name"),
        F.col("log_type").alias("Action Log Type"),
        F.col("notes").alias("Notes"),
        F.col("county").alias("County"),
        F.col("zipcode").alias("Zipcode"),
    )
    folder = export_workbooks(export, "job-actions-src")
    out = JOBS.process_action_logs(spark, folder, scratch_dir(spark, "job-actions-out"))
    return out.drop("index").toDF(
        "program_id", "recorded_by", "recorded_date", "action_date", "log_name", "log_type", "notes"
    )


QUERIES.update(
    {"job_referrals": job_referrals, "job_referral_filters": job_referral_filters, "job_action_logs": job_action_logs}
)
