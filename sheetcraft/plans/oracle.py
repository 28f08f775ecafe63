"""DuckDB oracle texts for the query catalog.

Written independently of the Spark code, in plain SQL over the driver's
pre-registered views; ``{logs}`` etc. are the adapters as sub-queries.
"""

from __future__ import annotations

from sheetcraft.plans.adapters import adapter_sql


def _sub(text: str) -> str:
    return text.format(
        logs=f"({adapter_sql('logs')})",
        programs=f"({adapter_sql('programs')})",
        ages=f"({adapter_sql('ages')})",
        details=f"({adapter_sql('details')})",
    )


SEARCH_NAMES = "('Parent Searched for Programs','Specialist Performed Search')"

_NUMBERED = """
f as (select * from {logs} a where log_name in """ + SEARCH_NAMES + """),
p as (select referral_id, action_ts, case when recorded_by <> 'guest' then 'user' else recorded_by end as recorded_by,
        type, county, city, zipcode, log_name, log_type, notes from f),
n as (select *, case when referral_id is not null and action_ts is not null then
        row_number() over (partition by referral_id, action_ts
          order by recorded_by nulls first, type nulls first, county nulls first, city nulls first, zipcode nulls first,
                   log_name nulls first, log_type nulls first, notes nulls first) end as search_no from p)
"""

REFERRAL_CLEAN = "with " + _NUMBERED + """,
u as (select distinct * from n),
m as (select *, max(search_no) over (partition by referral_id, action_ts) as max_no from u)
select referral_id, action_ts, search_no, recorded_by, type, county, city, zipcode, log_name, log_type, notes
from m where referral_id is null or action_ts is null or coalesce(max_no <= 10, true)
"""

REFERRAL_CLEAN_ANTIJOIN = "with " + _NUMBERED + """,
u as (select distinct * from n)
select referral_id, action_ts, search_no, recorded_by, type, county, city, zipcode, log_name, log_type, notes
from u where not exists (select 1 from n b where b.search_no > 10
   and b.referral_id = u.referral_id and b.action_ts = u.action_ts)
"""

REFERRAL_NUMBER = "with " + _NUMBERED + """
select referral_id, action_ts, search_no, recorded_by, type, county, city, zipcode, log_name, log_type, notes from n
"""

REFERRAL_WITHOUT_NOTES = "with " + _NUMBERED + """,
u as (select distinct * from n),
m as (select *, max(search_no) over (partition by referral_id, action_ts) as max_no from u)
select referral_id, action_ts, search_no, recorded_by, type, county, city, zipcode, log_name, log_type
from m where referral_id is null or action_ts is null or coalesce(max_no <= 10, true)
"""

STAGE_COUNTS = "with " + _NUMBERED + """,
u as (select distinct * from n),
m as (select *, max(search_no) over (partition by referral_id, action_ts) as max_no from u),
k as (select * from m where referral_id is null or action_ts is null or coalesce(max_no <= 10, true))
select (select count(*) from {logs} a) as rows_read,
       (select count(*) from f) as rows_searches,
       (select count(*) from k) as rows_kept,
       (select count(*) from f) - (select count(*) from k) as rows_removed
"""

ACTION_LOG_FILTER = """
select * from {logs} a where log_name in """ + SEARCH_NAMES

REFERRAL_ANONYMISE = """
select referral_id, case when recorded_by <> 'guest' then 'user' else recorded_by end as recorded_by, log_name
from {logs} a
"""

REFERRAL_PARSE_TIME = """
select referral_id, action_ts, strftime(action_ts, '%m/%d/%Y %I:%M %p') as action_text from {logs} a
"""

# Program action log: the logs adapter in that export's layout.
ACTION_LOG_RENAME = """
select referral_id as program_id, recorded_by, action_ts as recorded_date, action_ts as action_date,
       log_name, log_type, notes from {logs} a
"""

def oracle_texts() -> dict[str, str]:
    raw = {
        "referral_clean": REFERRAL_CLEAN,
        "referral_clean_window": REFERRAL_CLEAN,
        "referral_clean_antijoin": REFERRAL_CLEAN_ANTIJOIN,
        "referral_number": REFERRAL_NUMBER,
        "referral_without_notes": REFERRAL_WITHOUT_NOTES,
        "stage_counts": STAGE_COUNTS,
        "action_log_filter": ACTION_LOG_FILTER,
        "referral_anonymise": REFERRAL_ANONYMISE,
        "referral_parse_time": REFERRAL_PARSE_TIME,
        "action_log_rename": ACTION_LOG_RENAME,
    }
    out = {k: _sub(v) for k, v in raw.items()}
    out.update(program_oracles())
    out.update(extra_oracles())
    out.update(workbook_oracles())
    return out


# --- programs ----------------------------------------------------------------

_INVALID_ANY_STATUS = """coalesce(upper(license) like '%TEST%', false)
  or coalesce(upper(license) like '%DUPLICATE%', false) or coalesce(upper(provider_type) like '%EARLY LEARNING HUB%', false)
  or regulation is null or coalesce(business_name = ', ', false)"""

PROGRAMS_INVALID_MASK = """
select record_id, coalesce(status <> 'Active', false) or """ + _INVALID_ANY_STATUS + """ as invalid
from {programs} x
"""

PROGRAMS_VALID = """
select record_id, status from {programs} x
where not (coalesce(status <> 'Active', false) or """ + _INVALID_ANY_STATUS + """)
"""

PROGRAMS_VALID_ANY_STATUS = """
select record_id, status from {programs} x where not (""" + _INVALID_ANY_STATUS + """)
"""

PROGRAMS_TYPE_CODE = """
with m as (select record_id, trim(provider_type) as pt, upper(substr(trim(license),1,2)) as l2, upper(substr(trim(license),1,3)) as l3,
    trim(regulation) as rg, coalesce(upper(program_types) like '%PRESCHOOL%', false) as ps,
    coalesce(upper(program_types) like '%SCHOOL AGE%', false) as sa from {programs} x)
select record_id, case
  when pt='Licensed Center' and l2='CC' and rg='Licensed Child Care Center' then 'CC'
  when pt='Licensed Home' and l2='CF' and rg='Certified Family Child Care' then 'CF'
  when pt='Licensed Home' and l2='RF' and rg='Registered Family Child Care' then 'RF'
  when pt in ('License Exempt Home','License Exempt Center') and (l2='RS' or l3='IQY') and rg='Regulated Subsidy' then 'RS'
  when pt='License Exempt Center' and l2='PS' and rg='Recorded Preschool Program' then 'PSR'
  when pt='License Exempt Center' and l2='SA' and rg='Recorded School Age Program' then 'SAR'
  when pt in ('License Exempt Center','Interim Emergency Site') and l2='RA' and rg='Recorded Agency' then 'RA'
  when pt='License Exempt Center' and l2='AP' and rg='Unlicensed' then 'AP'
  when pt='License Exempt Center' and ps and not sa and rg='Unlicensed' then 'PSE'
  when pt='License Exempt Center' and not ps and sa and rg='Unlicensed' then 'SAE'
  when pt='License Exempt Center' and ps = sa and rg='Unlicensed' then 'CE'
  when pt='License Exempt Home' and rg='Unlicensed' then 'FE' end as type_code,
  pt as provider_type
from m
"""

PROGRAMS_TYPE_CODE_ONLY = "select * from (" + PROGRAMS_TYPE_CODE + ") t where type_code is not null"

REGION_VALUES = """(values ('Blue Mountain', 1), ('Multnomah', 2), ('Marion-Polk-Yamhill', 3), ('North Coast', 4),
  ('Linn-Benton-Lincoln', 5), ('Lane', 6), ('South Central', 7), ('South Coast', 8), ('Southern', 9),
  ('The Gorge', 10), ('Grant-Harney', 11), ('Central', 12), ('Eastern', 14), ('Clackamas', 15),
  ('Washington', 16)) r(name, sda)"""

PROGRAMS_SDA = """
select a.record_id, a.region, r.sda from {ages} a left join """ + REGION_VALUES + """ on trim(a.region) = r.name
"""

_FLAG_NAMES = (
    ("Preschool", "preschool"),
    ("Head Start (OPK)", "head_start_opk"),
    ("Early Head Start (OPK)", "early_head_start_opk"),
    ("School Age Before & After Care", "school_age_before_after_care"),
    ("Baby Promise", "baby_promise"),
    ("CCI (Multnomah)", "cci_multnomah"),
    ("School Age Full-Time", "school_age_full_time"),
    ("Preschool Promise", "preschool_promise"),
    ("Foster Care", "foster_care"),
    ("Relief Nursery", "relief_nursery"),
    ("Teen Parent", "teen_parent"),
    ("Tribal", "tribal"),
)

PROGRAMS_FLAGS = (
    "select record_id, trim(program_types) as program_types, "
    + ", ".join(
        f"coalesce(contains(upper(program_types), upper('{name}')), false) as {alias}" for name, alias in _FLAG_NAMES
    )
    + " from {programs} x"
)

PROGRAMS_TOTAL_MONTHS = """
select record_id, from_months + from_years * 12 as from_total_months, to_months + to_years * 12 as to_total_months
from {ages} x
"""

PROGRAMS_AGE_FLAGS = """
with m as (select record_id, from_months + from_years * 12 as f, to_months + to_years * 12 as t from {ages} x),
v as (select *, coalesce(t <> 0 and f <> t, false) as ok from m)
select record_id, f, t, not ok as unknown_care_range,
  ok and coalesce(0 <= t, false) and coalesce(f < 24, false) as infant,
  ok and coalesce(24 <= t, false) and coalesce(f < 36, false) as toddler,
  ok and coalesce(36 <= t, false) and coalesce(f < 60, false) as preschool,
  ok and coalesce(60 <= t, false) as school_age
from v
"""

AGE_DETAILS_LONG = """
with d as (select * from {details} x where infant_rate is not null or infant_capacity is not null
             or toddler_rate is not null or toddler_capacity is not null)
select record_id, 'Infant' as age_group, infant_capacity as capacity, infant_rate as rate from d
union all select record_id, 'Toddler', toddler_capacity, toddler_rate from d
"""

PROGRAMS_HAS_RATE_CAP = """
with d as (select record_id, infant_rate is not null or toddler_rate is not null as r,
             infant_capacity is not null or toddler_capacity is not null as c from {details} x)
select distinct p.record_id, coalesce(d.r, false) as has_rate, coalesce(d.c, false) as has_capacity
from {programs} p left join d on p.record_id is not distinct from d.record_id
"""

DISTINCT_IDS = """
select distinct record_id from {details} x where infant_rate is not null or toddler_rate is not null
"""

ROW_DEDUP = "select distinct text, lang, source, n_chars from documents"

RENAME_PATTERN = """
select p_partkey as "ODHS_id", p_name as "ODHS_name", p_brand as "brand_ODHS", p_size as size
from part
"""

DROP_EMPTY = """
select k, name from (
  select case when p_partkey % 10 <> 0 then p_partkey end as k,
         case when p_partkey % 10 <> 0 then p_name end as name
  from part) t
where k is not null or name is not null
"""

UNION_MIXED = """
select cast(r_regionkey as varchar) as key, r_name as name, cast(null as bigint) as regionkey from region
union all
select concat('N', n_nationkey) as key, n_name as name, cast(n_regionkey as bigint) as regionkey from nation
"""

def program_oracles() -> dict[str, str]:
    raw = {
        "programs_invalid_mask": PROGRAMS_INVALID_MASK,
        "programs_valid": PROGRAMS_VALID,
        "programs_valid_any_status": PROGRAMS_VALID_ANY_STATUS,
        "programs_type_code": PROGRAMS_TYPE_CODE,
        "programs_type_code_only": PROGRAMS_TYPE_CODE_ONLY,
        "programs_sda": PROGRAMS_SDA,
        "programs_sda_case": PROGRAMS_SDA,
        "programs_flags": PROGRAMS_FLAGS,
        "programs_total_months": PROGRAMS_TOTAL_MONTHS,
        "programs_age_flags": PROGRAMS_AGE_FLAGS,
        "age_details_long": AGE_DETAILS_LONG,
        "programs_has_rate_cap": PROGRAMS_HAS_RATE_CAP,
        "distinct_ids": DISTINCT_IDS,
        "row_dedup": ROW_DEDUP,
        "rename_pattern": RENAME_PATTERN,
        "drop_empty": DROP_EMPTY,
        "union_mixed": UNION_MIXED,
    }
    return {k: _sub(v) for k, v in raw.items()}


# --- notes, JSON, URLs, dimension ---------------------------------------------------

_FILTER_LISTS = """
fl as (select *, cast(json_extract(case when json_valid(notes) then notes end, '$.Filters') as json[]) as fls
       from {src} z where notes is not null),
ex as (select fl.*, u.f, u.pos from fl, unnest(fl.fls) with ordinality as u(f, pos) where len(fl.fls) > 0)
"""

NOTES_FILTERS = "with " + _FILTER_LISTS.replace("{src}", "{logs}") + """
select referral_id, log_type, pos - 1 as filter_pos, cast(f as varchar) as filter_json from ex
"""

NOTES_FLATTEN = ("with " + _NUMBERED + """,
u as (select distinct * from n),
m as (select *, max(search_no) over (partition by referral_id, action_ts) as max_no from u),
c as (select referral_id, action_ts, search_no, recorded_by, type, county, city, zipcode, log_name, log_type, notes
      from m where referral_id is null or action_ts is null or coalesce(max_no <= 10, true)),
""" + _FILTER_LISTS.replace("{src}", "c") + """
select referral_id, action_ts, search_no, recorded_by, type, county, city, zipcode, log_name, log_type,
  cast(json_extract(f, '$.k') as bigint) as k, json_extract_string(f, '$.name') as name,
  json_extract_string(f, '$.value') as value
from ex
""")

JSON_PATH_DEFAULT = """
select event_id, json_extract_string(props, '$.k') as k,
  coalesce(json_extract_string(props, '$.missing'), 'none') as missing,
  coalesce(json_extract_string(props, '$.k.x'), 'not-a-map') as nested
from events
"""

# Parts of a url by the places of its marks (the implementation matches one
# pattern): fragment after the first #, query after the first ? before it,
# scheme up to a colon that no / comes before, authority after // up to a /.
_URL_PARTS = """
h as (select page_id, url, case when instr(url, '#') > 0 then substr(url, instr(url, '#')) else '' end as fragment,
        case when instr(url, '#') > 0 then substr(url, 1, instr(url, '#') - 1) else url end as u0 from pages),
q as (select *, case when instr(u0, '?') > 0 then substr(u0, instr(u0, '?')) else '' end as query,
        case when instr(u0, '?') > 0 then substr(u0, 1, instr(u0, '?') - 1) else u0 end as u1 from h),
c as (select *, case when instr(u1, ':') > 1 and ascii(lower(u1)) between 97 and 122
        and length(translate(lower(substr(u1, 1, instr(u1, ':') - 1)), 'abcdefghijklmnopqrstuvwxyz0123456789+-.', '')) = 0
        then substr(u1, 1, instr(u1, ':') - 1) else '' end as scheme from q),
d as (select *, case when scheme = '' then u1 else substr(u1, length(scheme) + 2) end as u2 from c),
n as (select *, case when starts_with(u2, '//') then string_split(substr(u2, 3), '/')[1] else '' end as netloc,
        case when starts_with(u2, '//') then substr(u2, 3 + length(string_split(substr(u2, 3), '/')[1])) else u2 end as path
      from d),
s as (select *, scheme <> '' and netloc <> '' as is_absolute from n)
"""

URL_ABSOLUTE = f"with {_URL_PARTS} select page_id, is_absolute from s"

URL_JOIN = f"""
with {_URL_PARTS}
select page_id, case when is_absolute then
  scheme || '://' || netloc || '/' ||
  array_to_string(list_filter(string_split(path || '/about', '/'), lambda x: x <> '' and x <> '.'), '/')
  || query || fragment end as joined
from s
"""


URL_NORMALIZED = f"""
with {_URL_PARTS}
select page_id, case when is_absolute then
  lower(scheme) || '://' || netloc || path || case when query = '?' then '' else query end
  || case when fragment = '#' then '' else fragment end end as url_text
from s
"""


# Region, SDA code and counties, stated here a second time so that
# a slip in the package's table shows.
_SDA_COUNTIES = """
Blue Mountain 1: Morrow, Umatilla, Union
Multnomah 2: Multnomah
Marion-Polk-Yamhill 3: Marion, Polk, Yamhill
North Coast 4: Clatsop, Tillamook, Columbia
Linn-Benton-Lincoln 5: Linn, Benton, Lincoln
Lane 6: Lane
South Central 7: Douglas, Klamath, Lake
South Coast 8: Coos, Curry
Southern 9: Jackson, Josephine
The Gorge 10: Gilliam, Hood River, Sherman, Wasco, Wheeler
Grant-Harney 11: Grant, Harney
Central 12: Crook, Deschutes, Jefferson
Eastern 14: Baker, Malheur, Wallowa
Clackamas 15: Clackamas
Washington 16: Washington
"""


def _county_oracle() -> str:
    """DuckDB takes the lines apart: place, county, region and code."""
    return f"""
with l as (select string_split(line, ': ') as x from (select unnest(string_split(trim('{_SDA_COUNTIES}', chr(10)), chr(10))) as line)),
d as (select unnest(string_split(x[2], ', ')) as county, regexp_extract(x[1], '^(.*) [0-9]+$', 1) as region,
        cast(regexp_extract(x[1], '([0-9]+)$', 1) as int) as sda from l),
n as (select list(county order by sda, spot) as names from (select *, row_number() over () as spot from d)),
p as (select p_partkey as record_id, list_extract(names, cast(p_partkey % (len(names) + 1) + 1 as int)) as county from part, n)
select p.record_id, p.county, d.region, d.sda from p left join d on p.county = d.county
"""


def extra_oracles() -> dict[str, str]:
    raw = {
        "notes_filters": NOTES_FILTERS,
        "notes_flatten": NOTES_FLATTEN,
    }
    out = {k: _sub(v) for k, v in raw.items()}
    out["notes_flatten_given_schema"] = out["notes_flatten"]
    out["json_path_default"] = JSON_PATH_DEFAULT
    out["url_absolute"] = URL_ABSOLUTE
    out["url_join"] = URL_JOIN
    out["url_normalized"] = URL_NORMALIZED
    out["county_lookup"] = _county_oracle()
    return out


def workbook_oracles() -> dict[str, str]:
    return {
        "workbook_roundtrip": """select c_custkey, c_name, cast(c_nationkey as bigint) as c_nationkey, c_acctbal,
                                  c_mktsegment from customer""",
        "workbook_sheets": """select c_custkey, c_name, cast(c_nationkey as bigint) as c_nationkey, c_acctbal,
                               c_mktsegment from customer""",
        "workbook_catalog": "select distinct c_mktsegment as sheet from customer",
        "job_referrals": _sub(REFERRAL_WITHOUT_NOTES),
        "job_referral_filters": _sub(NOTES_FLATTEN),
        "job_action_logs": _sub("""
select referral_id as program_id, recorded_by, strftime(action_ts, '%Y-%m-%d %H:%M:%S') as recorded_date,
       strftime(action_ts, '%Y-%m-%d %H:%M:%S') as action_date, log_name, log_type, notes from {logs} a
"""),
        "headers_from_cells": _sub("""select record_id, infant_rate,
          cast(infant_capacity as bigint) as infant_capacity, toddler_rate, cast(toddler_capacity as bigint) as toddler_capacity
          from {details} d"""),
        "headers_custom_rule": _sub("""select record_id, infant_rate,
          cast(infant_capacity as bigint) as infant_capacity, toddler_rate, cast(toddler_capacity as bigint) as toddler_capacity
          from {details} d"""),
        "headers_all_unique": _sub("select record_id as id, infant_rate as infant, cast(infant_capacity as bigint) as infant_1 from {details} d"),
        "table_from_cells": """select c_custkey + 9007199254740993 as key, case when c_custkey % 3 = 0 then c_acctbal end as balance,
          case when c_custkey % 3 = 0 then cast(c_nationkey as varchar) when c_custkey % 5 <> 0 then c_name end as mixed,
          case when c_custkey % 3 <> 0 then c_mktsegment end as segment from customer""",
        "odd_headers_from_cells": """select c_custkey as no, case when c_custkey % 2 = 0 and c_custkey % 3 = 0 then c_acctbal end as a_b,
          c_name as a_tick_b, c_mktsegment as x, case when c_custkey % 2 = 0 then cast(c_nationkey as bigint) end as x_1,
          case when c_custkey % 2 = 1 and c_custkey % 3 = 0 then c_acctbal end as upper_a_b,
          case when c_custkey % 2 = 1 then cast(c_nationkey as bigint) end as upper_x from customer""",
        "union_of_odd_headers": """select o_orderkey as no, 'Infant (0.5-1)' as age_group,
          case when o_orderkey % 2 = 0 then o_totalprice end as rate, cast(null as integer) as b_t from orders
          union all select o_orderkey, 'infant (0.5-1)', case when o_orderkey % 2 = 1 then o_totalprice end,
          case when o_orderkey % 2 = 1 then cast(o_orderpriority[1:1] as integer) end from orders""",
        "notes_case_twins": """with e as (select event_id, cast(user_id as bigint) as u, event_id % 6 as m from events)
          select event_id, cast(null as bigint) as upper_a, cast(null as varchar) as upper_id, u as a,
                 cast(null as bigint) as b_upper_c, cast(null as varchar) as b_c, 'x' as id from e where m = 0
          union all select event_id, u, null, null, null, null, null from e where m = 1
          union all select event_id, null, null, u, null, null, null from e where m = 1
          union all select event_id, null, null, null, null, null, null from e where m = 2
          union all select event_id, null, null, null, u, null, null from e where m = 3
          union all select event_id, null, null, null, null, 'NaN ' || u, null from e where m = 5""",
        "typed_texts": """select c_custkey as key,
          case when c_custkey % 7 = 0 then lpad(cast(c_custkey as varchar), 6, '0') else cast(c_custkey as varchar) end as code,
          cast(cast(c_custkey as hugeint) + 9223372036854775807 as varchar) as large, true as large_is_number,
          c_custkey % 2 = 0 as flag, case when c_custkey % 2 = 0 then '1.50' else '1.5' end as price, c_custkey + 0.5::double as half
          from customer""",
        "csv_text_roundtrip": """select doc_id, case doc_id % 6 when 0 then text
          when 1 then '  ' || text || chr(9) || ' ' when 2 then '"' || text || '",' || chr(13) || chr(10) || '"'
          when 3 then '' when 4 then text || chr(92) end as text, lang from documents""",
        "csv_roundtrip": """select row_number() over (order by c_custkey) - 1 as index, c_custkey, c_name, c_nationkey,
                             c_acctbal, c_mktsegment from customer""",
        "forward_fill_sheet": """select o_orderkey, o_custkey,
             first_value(o_orderpriority) over (partition by o_custkey order by o_orderkey) as first_priority
             from orders""",
        "stream_ingest": """select c_custkey, c_name, cast(c_nationkey as bigint) as c_nationkey, c_acctbal,
                             c_mktsegment from customer""",
        "collect_file_and_folder": """select c_custkey, c_name, n_name
             from customer left join nation on c_nationkey = n_nationkey""",
        "referral_clean_from_workbooks": _sub(REFERRAL_CLEAN),
        **{
            f"refresh_{k}": """select c_custkey, c_name, cast(c_nationkey as bigint) as c_nationkey, c_acctbal,
                                c_mktsegment from customer where c_acctbal > 0"""
            for k in ("check", "fallback", "force", "skip", "only_cached", "custom", "incremental", "csv")
        },
        "age_details_from_workbook": _sub("""
with d as (select * from {details} x where infant_rate is not null or infant_capacity is not null
             or toddler_rate is not null or toddler_capacity is not null)
select record_id, 'Infant' as age_group, cast(infant_capacity as bigint) as capacity, infant_rate as rate from d
union all select record_id, 'Toddler', cast(toddler_capacity as bigint), toddler_rate from d
"""),
    }
