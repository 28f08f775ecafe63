"""Domain tables derived from the driver's tables.

Each adapter is one portable SQL text run unchanged by Spark (``spark.sql``
with DataFrame arguments, no global views) and by DuckDB (the oracle side).
Snake_case inside; ``to_*_layout`` renames to the export's display names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sheetcraft.functions.timeparse import format_action_time

LOGS_SQL = """
select case when event_id % 97 = 0 then null else user_id end as referral_id,
  date_trunc('week', ts) as action_ts,
  case event_id % 3 when 0 then 'guest' when 1 then concat('u', user_id, '@example.org') end as recorded_by,
  case event_id % 2 when 0 then 'Phone' else 'Web' end as type,
  concat('County', event_id % 36) as county,
  concat('City', event_id % 11) as city,
  concat('97', 100 + event_id % 300) as zipcode,
  case event_type when 'click' then 'Parent Searched for Programs'
                  when 'view' then 'Specialist Performed Search'
                  else concat('Other ', event_type) end as log_name,
  event_type as log_type,
  case event_id % 10 when 0 then null when 1 then 'not json' when 2 then '{{"Filters":[]}}'
    when 3 then '{{"Other":1}}'
    else concat('{{"Filters":[', props, ',{{"name":"County","value":"C', event_id % 36, '"}}]}}') end as notes
from {events}
"""

PROGRAMS_SQL = """
select p_partkey as record_id,
  case p_partkey % 7 when 0 then 'Inactive' when 1 then null else 'Active' end as status,
  concat(case p_partkey % 11 when 0 then 'CC' when 1 then 'cf' when 2 then 'RF' when 3 then 'RS' when 4 then 'PS'
    when 5 then 'SA' when 6 then 'RA' when 7 then 'AP' when 8 then 'IQY' when 9 then 'test-' else 'Duplicate ' end, p_partkey) as license,
  case p_partkey % 5 when 0 then 'Licensed Home' when 1 then 'Licensed Center ' when 2 then 'License Exempt Home'
    when 3 then ' License Exempt Center' else case when p_partkey % 2 = 0 then 'Interim Emergency Site' else 'early learning hub' end end as provider_type,
  case p_partkey % 9 when 0 then 'Licensed Child Care Center' when 1 then 'Certified Family Child Care'
    when 2 then 'Registered Family Child Care' when 3 then 'Regulated Subsidy' when 4 then 'Recorded Preschool Program'
    when 5 then 'Recorded School Age Program' when 6 then 'Recorded Agency' when 7 then 'Unlicensed' end as regulation,
  case p_partkey % 4 when 0 then 'Preschool; Teen Parent' when 1 then 'School Age Full-Time'
    when 2 then 'PRESCHOOL, school age full-time' end as program_types,
  case when p_partkey % 23 = 0 then ', ' else p_name end as business_name
from {part}
"""

AGES_SQL = """
select p_partkey as record_id,
  case p_partkey % 17 when 0 then 'Blue Mountain' when 1 then 'Multnomah ' when 2 then 'Marion-Polk-Yamhill'
    when 3 then 'North Coast ' when 4 then 'Linn-Benton-Lincoln' when 5 then 'Lane ' when 6 then 'South Central'
    when 7 then 'South Coast ' when 8 then 'Southern' when 9 then 'The Gorge ' when 10 then 'Grant-Harney'
    when 11 then 'Central ' when 12 then 'Eastern' when 13 then 'Clackamas ' when 14 then 'Washington'
    when 15 then 'Unknown' end as region,
  case when p_partkey % 13 = 0 then null else cast(p_size % 8 as int) end as from_years,
  cast(p_partkey % 12 as int) as from_months,
  case when p_partkey % 10 = 0 then 0 else cast(p_size % 8 + p_partkey % 6 as int) end as to_years,
  case when p_partkey % 10 = 0 then 0 else cast(p_partkey % 12 as int) end as to_months
from {part}
"""

DETAILS_SQL = """
select case when p_partkey % 5 = 4 then -p_partkey else p_partkey end as record_id,
  case when p_partkey % 3 = 0 then p_retailprice end as infant_rate,
  case when p_partkey % 4 = 0 then p_size end as infant_capacity,
  case when p_partkey % 6 = 0 then p_retailprice * 2 end as toddler_rate,
  case when p_partkey % 8 = 0 then p_size + 1 end as toddler_capacity
from {part}
"""

ADAPTERS = {
    "logs": (LOGS_SQL, "events"),
    "programs": (PROGRAMS_SQL, "part"),
    "ages": (AGES_SQL, "part"),
    "details": (DETAILS_SQL, "part"),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def adapter(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql, source = ADAPTERS[name]
    df = spark.sql(sql, **{source: read_table(spark, sf_dir, source)})
    if name == "logs":
        # date_trunc yields a zoned TIMESTAMP; the export's times are zone-less.
        df = df.withColumn("action_ts", df["action_ts"].cast("timestamp_ntz"))
    return df


def adapter_sql(name: str) -> str:
    """DuckDB text of an adapter (its source is a pre-registered view)."""
    sql, source = ADAPTERS[name]
    return sql.format(**{source: source})


# --- display layouts (what a workbook export carries) -----------------------

LOGS_DISPLAY = {
    "referral_id": "ReferralID",
    "action_ts": "Date of Action",
    "recorded_by": "RecordedBy",
    "type": "Type",
    "county": "County",
    "city": "City",
    "zipcode": "Zipcode",
    "log_name": "Action Log Name",
    "log_type": "Action Log Type",
    "notes": "Notes",
}

PROGRAMS_DISPLAY = {
    "record_id": "Record ID",
    "status": "Status",
    "license": "License",
    "provider_type": "Provider Type",
    "regulation": "Regulation",
    "program_types": "Program Types",
    "business_name": "Business Name",
}

AGES_DISPLAY = {
    "record_id": "Record ID",
    "region": "Region",
    "from_years": "Care For Ages From Years",
    "from_months": "Care For Ages From Months",
    "to_years": "Care For Ages To Years",
    "to_months": "Care For Ages To Months",
}


def to_display(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def referral_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Referral action log as exported: display names, time as text."""
    logs = adapter(spark, sf_dir, "logs").withColumn("action_ts", format_action_time("action_ts"))
    return to_display(logs, LOGS_DISPLAY)


def programs_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_display(adapter(spark, sf_dir, "programs"), PROGRAMS_DISPLAY)


def ages_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_display(adapter(spark, sf_dir, "ages"), AGES_DISPLAY)
