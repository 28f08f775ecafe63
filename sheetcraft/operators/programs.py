"""Program coding: validity, type code, SDA code, program-type flags, care
ages in months, age-range flags, has-rate / has-capacity.

Everything except ``sda_code_programs`` (a broadcast of a fixed 15-row
dimension) and ``programs_has_rates_caps`` (one aggregate + one join) is a
narrow projection that Catalyst collapses into one Project/Filter, with no
exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetcraft.functions.regions import regions
from sheetcraft.functions.text import icontains, or_false, prefix_upper_eq, strip_ws, xor

# Column names used by the program exports.
RECORD_ID = "Record ID"
STATUS = "Status"
LICENSE = "License"
PROVIDER_TYPE = "Provider Type"
REGULATION = "Regulation"
PROGRAM_TYPES = "Program Types"
BUSINESS_NAME = "Business Name"
REGION = "Region"
TYPE_CODE = "Type Code"
SDA = "SDA"
FROM_YEARS = "Care For Ages From Years"
FROM_MONTHS = "Care For Ages From Months"
TO_YEARS = "Care For Ages To Years"
TO_MONTHS = "Care For Ages To Months"
FROM_TOTAL = "Care For Ages From Total Months"
TO_TOTAL = "Care For Ages To Total Months"
UNKNOWN_RANGE = "Unknown Care Range"
HAS_RATE = "Has Rate"
HAS_CAPACITY = "Has Capacity"
MONTHS_PER_YEAR = 12

# The invalid-program tests.
ACTIVE = "Active"
LICENSE_MARKERS = ("TEST", "DUPLICATE")
HUB_PROVIDER = "Early Learning Hub"
EMPTY_BUSINESS_NAME = ", "

# The twelve program types, in the reference's order.
PROGRAM_TYPE_NAMES = (
    "Preschool",
    "Head Start (OPK)",
    "Early Head Start (OPK)",
    "School Age Before & After Care",
    "Baby Promise",
    "CCI (Multnomah)",
    "School Age Full-Time",
    "Preschool Promise",
    "Foster Care",
    "Relief Nursery",
    "Teen Parent",
    "Tribal",
)

# Age ranges in months (label, lower, upper or None).
AGE_RANGES = (
    ("Infant", 0, 24),
    ("Toddler", 24, 36),
    ("Preschool", 36, 60),
    ("School Age", 60, None),
)

# Type-code rules, first match wins.  Columns: code, provider
# types, licence prefixes (None = any), regulation, program-type condition
# (None = any; "ps_only", "sa_only", "both_or_neither").
TYPE_CODE_RULES = (
    ("CC", ("Licensed Center",), ("CC",), "Licensed Child Care Center", None),
    ("CF", ("Licensed Home",), ("CF",), "Certified Family Child Care", None),
    ("RF", ("Licensed Home",), ("RF",), "Registered Family Child Care", None),
    ("RS", ("License Exempt Home", "License Exempt Center"), ("RS", "IQY"), "Regulated Subsidy", None),
    ("PSR", ("License Exempt Center",), ("PS",), "Recorded Preschool Program", None),
    ("SAR", ("License Exempt Center",), ("SA",), "Recorded School Age Program", None),
    ("RA", ("License Exempt Center", "Interim Emergency Site"), ("RA",), "Recorded Agency", None),
    ("AP", ("License Exempt Center",), ("AP",), "Unlicensed", None),
    ("PSE", ("License Exempt Center",), None, "Unlicensed", "ps_only"),
    ("SAE", ("License Exempt Center",), None, "Unlicensed", "sa_only"),
    ("CE", ("License Exempt Center",), None, "Unlicensed", "both_or_neither"),
    ("FE", ("License Exempt Home",), None, "Unlicensed", None),
)
PRESCHOOL = "Preschool"
SCHOOL_AGE = "School Age"


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def range_label(label: str, lower: int, upper: int | None) -> str:
    return f"{label} ({lower}-{upper})" if upper is not None else f"{label} ({lower}+)"


AGE_RANGE_COLUMNS = tuple(range_label(*r) for r in AGE_RANGES)


# --- names -----------------------------------------------------------------


def dhs_to_odhs_names(df: DataFrame) -> DataFrame:
    """Rename every column containing ``DHS`` but not ``ODHS`` (metadata only)."""
    renames = {n: n.replace("DHS", "ODHS") for n in df.columns if "DHS" in n and "ODHS" not in n}
    return df.withColumnsRenamed(renames)


# --- validity ----------------------------------------------------------------


def invalid_programs_mask(filter_status: bool = True) -> Column:
    """OR of the invalid tests; each test's null counts as false."""
    tests = []
    if filter_status:
        tests.append(_q(STATUS) != ACTIVE)
    tests += [icontains(LICENSE, m) for m in LICENSE_MARKERS]
    tests.append(icontains(PROVIDER_TYPE, HUB_PROVIDER))
    tests.append(_q(REGULATION).isNull())
    tests.append(_q(BUSINESS_NAME) == EMPTY_BUSINESS_NAME)
    mask = F.lit(False)
    for t in tests:
        mask = mask | or_false(t)
    return mask


def remove_invalid_programs(df: DataFrame, filter_status: bool = True) -> DataFrame:
    return df.filter(~invalid_programs_mask(filter_status))


# --- type code ---------------------------------------------------------------


def type_code_column() -> Column:
    """The type-code CASE over stripped inputs (first match wins, else null).

    Reads the stripped columns by name; ``type_code_programs`` strips first.
    """
    pt, lic, reg, ptypes = _q(PROVIDER_TYPE), _q(LICENSE), _q(REGULATION), _q(PROGRAM_TYPES)
    ps = or_false(icontains(ptypes, PRESCHOOL))
    sa = or_false(icontains(ptypes, SCHOOL_AGE))
    program_conditions = {
        "ps_only": ps & ~sa,
        "sa_only": ~ps & sa,
        "both_or_neither": ~xor(ps, sa),
    }
    expr = None
    for code, providers, prefixes, regulation, programs in TYPE_CODE_RULES:
        cond = or_false(pt.isin(*providers))
        if prefixes is not None:
            any_prefix = F.lit(False)
            for p in prefixes:
                any_prefix = any_prefix | or_false(prefix_upper_eq(lic, p))
            cond = cond & any_prefix
        cond = cond & or_false(reg == regulation)
        if programs is not None:
            cond = cond & program_conditions[programs]
        expr = F.when(cond, F.lit(code)) if expr is None else expr.when(cond, F.lit(code))
    return expr.otherwise(F.lit(None).cast("string"))


def type_code_programs(df: DataFrame, dropna: bool = False) -> DataFrame:
    """Strip the four inputs (kept in the output), add ``Type Code``;
    ``dropna`` removes rows without a code."""
    stripped = df.withColumns({c: strip_ws(_q(c)) for c in (PROVIDER_TYPE, PROGRAM_TYPES, LICENSE, REGULATION)})
    out = stripped.withColumn(TYPE_CODE, type_code_column())
    return out.filter(_q(TYPE_CODE).isNotNull()) if dropna else out


# --- SDA code ----------------------------------------------------------------


def sda_code_programs(df: DataFrame, how: str = "join") -> DataFrame:
    """Add ``SDA`` from the stripped ``Region`` (null if unknown).

    ``how="join"``: left join with the broadcast 15-row dimension (its size is
    fixed, so the broadcast is bounded).  ``how="case"``: the same lookup as a
    generated CASE (no join at all).
    """
    from sheetcraft.functions.regions import REGIONS

    key = strip_ws(_q(REGION))
    if how == "case":
        expr = None
        for name, sda, _ in REGIONS:
            expr = F.when(key == name, F.lit(sda)) if expr is None else expr.when(key == name, F.lit(sda))
        return df.withColumn(SDA, expr.otherwise(F.lit(None).cast("int")))
    if how != "join":
        raise ValueError(f"unknown how {how!r}")
    dim = regions(df.sparkSession).select(F.col("region").alias("__region"), F.col("sda").alias("__sda"))
    joined = df.withColumn("__key", key).join(F.broadcast(dim), F.col("__key") == F.col("__region"), "left")
    return joined.withColumn(SDA, F.col("__sda")).drop("__key", "__region", "__sda")


# --- program-type flags -------------------------------------------------------


def flag_program_types(df: DataFrame) -> DataFrame:
    """Strip ``Program Types`` and add one boolean column per program type
    (case-insensitive substring; null -> false)."""
    out = df.withColumn(PROGRAM_TYPES, strip_ws(_q(PROGRAM_TYPES)))
    return out.withColumns({name: or_false(icontains(PROGRAM_TYPES, name)) for name in PROGRAM_TYPE_NAMES})


# --- care ages ---------------------------------------------------------------


def care_for_ages_total_months(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            FROM_TOTAL: _q(FROM_MONTHS) + _q(FROM_YEARS) * MONTHS_PER_YEAR,
            TO_TOTAL: _q(TO_MONTHS) + _q(TO_YEARS) * MONTHS_PER_YEAR,
        }
    )


def care_for_flag_from_total_months(df: DataFrame) -> DataFrame:
    """``Unknown Care Range`` and one interval-overlap flag per age range."""
    f, t = _q(FROM_TOTAL), _q(TO_TOTAL)
    valid = or_false((t != 0) & (f != t))
    cols = {UNKNOWN_RANGE: ~valid}
    for label, lower, upper in AGE_RANGES:
        mask = valid & or_false(F.lit(lower) <= t)
        if upper is not None:
            mask = mask & or_false(f < F.lit(upper))
        cols[range_label(label, lower, upper)] = mask
    return df.withColumns(cols)


# --- has rate / has capacity ---------------------------------------------------


def programs_has_rates_caps(
    df: DataFrame,
    age_details: DataFrame,
    keys: tuple[str, ...] = (RECORD_ID, "Age Group"),
) -> DataFrame:
    """``Has Rate`` / ``Has Capacity``: the program's id has a details row with
    any non-null rate measure (name contains ``Rate``) / any other measure.

    One aggregate over the details (partial + final) and one left join on the
    id (null ids match, as in a pandas merge); AQE broadcasts the aggregated
    side when its runtime size allows.  The whole-row distinct of the result
    is kept.
    """
    measures = [c for c in age_details.columns if c not in keys]
    rate_cols = [c for c in measures if "Rate" in c]
    cap_cols = [c for c in measures if "Rate" not in c]

    def any_present(cols: list[str]) -> Column:
        if not cols:
            return F.lit(False)
        out = F.lit(False)
        for c in cols:
            out = out | _q(c).isNotNull()
        return out

    per_id = age_details.groupBy(_q(RECORD_ID).alias("__id")).agg(
        F.max(any_present(rate_cols)).alias("__rate"),
        F.max(any_present(cap_cols)).alias("__cap"),
    )
    base_cols = df.columns
    joined = df.join(per_id, _q(RECORD_ID).eqNullSafe(F.col("__id")), "left")
    out = joined.select(
        *[_q(c) for c in base_cols],
        F.coalesce(F.col("__rate"), F.lit(False)).alias(HAS_RATE),
        F.coalesce(F.col("__cap"), F.lit(False)).alias(HAS_CAPACITY),
    )
    return out.dropDuplicates()
