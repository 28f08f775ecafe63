"""Referral action-log pipeline: filter, anonymise, parse times, number
searches per referral and minute, drop abusive groups, explode notes filters.

Plan notes (see README "Scale"):
* Rows whose group key is null never get a number and can never be part of an
  abusive group; they are split off before any key-partitioned step, so a hot
  null key cannot pile up in one task.  Their whole-row distinct is a hash
  aggregate with map-side partial aggregation.
* ``clean_referrals`` (default) keeps at most ``threshold`` + 1 numbered rows of
  a key, which Spark does before the shuffle too, so a hot key is never shuffled
  whole; a key that still has that many goes.  One scan, one exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetcraft.functions.jsonpath import parse_filters
from sheetcraft.functions.names import with_headers
from sheetcraft.functions.timeparse import parse_action_time
from sheetcraft.operators.json_trie import Leaf, is_object, json_leaves

# Display column names of the referral export and the pipeline.
REFERRAL_ID = "ReferralID"
ACTION_DATE = "Date of Action"
SEARCH_NO = "Referral Search Number In Minute"
RECORDED_BY = "RecordedBy"
LOG_NAME = "Action Log Name"
LOG_TYPE = "Action Log Type"
NOTES = "Notes"
GROUP_KEYS = [REFERRAL_ID, ACTION_DATE]
REFERRAL_COLUMNS = [
    REFERRAL_ID,
    ACTION_DATE,
    SEARCH_NO,
    RECORDED_BY,
    "Type",
    "County",
    "City",
    "Zipcode",
    LOG_NAME,
    LOG_TYPE,
    NOTES,
]
SEARCH_LOG_NAMES = ("Parent Searched for Programs", "Specialist Performed Search")
MAX_SEARCHES_PER_MINUTE = 10
GUEST = "guest"
USER = "user"

_ORDER_COLUMNS = [c for c in REFERRAL_COLUMNS if c not in GROUP_KEYS and c != SEARCH_NO]


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def keys_present() -> Column:
    return _q(REFERRAL_ID).isNotNull() & _q(ACTION_DATE).isNotNull()


def keys_missing() -> Column:
    """Negation of ``keys_present`` in a form a Parquet scan accepts."""
    return _q(REFERRAL_ID).isNull() | _q(ACTION_DATE).isNull()


def filter_search_logs(df: DataFrame) -> DataFrame:
    """Keep the two search log names (membership filter, pushed to the scan)."""
    return df.filter(_q(LOG_NAME).isin(*SEARCH_LOG_NAMES))


def anonymise(df: DataFrame) -> DataFrame:
    """Every recorder other than ``guest`` becomes ``user``; null stays null."""
    rb = _q(RECORDED_BY)
    return df.withColumn(RECORDED_BY, F.when(rb != GUEST, F.lit(USER)).otherwise(rb))


def parse_times(df: DataFrame, on_error: str = "raise") -> DataFrame:
    """Text ``Date of Action`` -> TIMESTAMP_NTZ; already-typed input is kept."""
    dtype = dict(df.dtypes)[ACTION_DATE]
    if dtype.startswith("timestamp"):
        return df.withColumn(ACTION_DATE, _q(ACTION_DATE).cast("timestamp_ntz"))
    return df.withColumn(ACTION_DATE, parse_action_time(_q(ACTION_DATE), on_error))


def _number_window() -> Window:
    order = [_q(c).asc_nulls_first() for c in _ORDER_COLUMNS]
    return Window.partitionBy(*[_q(k) for k in GROUP_KEYS]).orderBy(*order)


def _project(df: DataFrame) -> DataFrame:
    return df.select(*[_q(c) for c in REFERRAL_COLUMNS])


def _null_key_rows(df: DataFrame, distinct: bool, filtered: bool = False) -> DataFrame:
    rows = df if filtered else df.filter(keys_missing())
    out = _project(rows.withColumn(SEARCH_NO, F.lit(None).cast("bigint")))
    return out.dropDuplicates() if distinct else out


def _number_keyed(df: DataFrame) -> DataFrame:
    """Numbered rows of ``df`` whose group key is present (projected)."""
    from sheetcraft.operators.numbering import number_rows

    keyed = _project(df.withColumn(SEARCH_NO, F.lit(None).cast("bigint"))).drop(SEARCH_NO)
    return _project(number_rows(keyed.filter(keys_present()), GROUP_KEYS, _ORDER_COLUMNS, SEARCH_NO))


def number_searches(df: DataFrame) -> DataFrame:
    """Number rows within (ReferralID, Date of Action) from 1; null key -> null.

    The number is an identifier, not an order; ties are broken by every other
    output column (ascending, nulls first) so it is deterministic.
    """
    return _number_keyed(df).unionByName(_null_key_rows(df, distinct=False))


def process_referral_action_logs(df: DataFrame, on_error: str = "raise") -> DataFrame:
    """Anonymise, parse times, number searches, project the 11 output columns."""
    return number_searches(parse_times(anonymise(df), on_error))


def clean_numbered_antijoin(numbered: DataFrame, threshold: int = MAX_SEARCHES_PER_MINUTE) -> DataFrame:
    """Reference form on numbered rows: whole-row distinct, the distinct keys of
    rows numbered above the threshold, then keep rows without such a key
    (null keys never match, so they stay)."""
    dedup = numbered.dropDuplicates()
    bad = dedup.filter(_q(SEARCH_NO) > threshold).select(*[_q(k) for k in GROUP_KEYS]).distinct()
    return dedup.join(bad, GROUP_KEYS, "left_anti").select(*[_q(c) for c in REFERRAL_COLUMNS])


def clean_numbered_window(numbered: DataFrame, threshold: int = MAX_SEARCHES_PER_MINUTE) -> DataFrame:
    """Fused form on numbered rows: distinct, then the group's highest number
    by a window on the keys; keep groups whose highest number is within the
    threshold (null keys always stay)."""
    nonnull = numbered.filter(keys_present()).dropDuplicates()
    top = F.max(_q(SEARCH_NO)).over(Window.partitionBy(*[_q(k) for k in GROUP_KEYS]))
    kept = nonnull.withColumn("__top", top).filter(F.coalesce(F.col("__top") <= threshold, F.lit(True)))
    nulls = numbered.filter(keys_missing()).dropDuplicates()
    return _project(kept).unionByName(_project(nulls))


def _oversized(keyed: DataFrame, threshold: int) -> DataFrame:
    """Group keys with more rows than the threshold (partial aggregate)."""
    return keyed.groupBy(*[_q(k) for k in GROUP_KEYS]).count().filter(F.col("count") > threshold).drop("count")


def clean_referrals(
    df: DataFrame,
    on_error: str = "raise",
    threshold: int = MAX_SEARCHES_PER_MINUTE,
    method: str = "ranked",
    dedup_first: bool = False,
) -> DataFrame:
    """process + clean in one plan.

    ``method``:
      * ``"ranked"`` (default): number the rows of a key up to threshold + 1;
        as the limit is on the number itself, Spark cuts every key to so many
        rows before the shuffle (``WindowGroupLimit``).  A key that still has
        threshold + 1 rows goes.  The keyed rows are scanned once and shuffled
        once, whatever the size of a key.
      * ``"presize"``: group sizes by partial aggregate, anti join the
        oversized keys, number the survivors (groups of <= threshold rows).
      * ``"window"``: number everything, then a max window on the same keys.
      * ``"antijoin"``: the reference's numbered -> distinct -> anti join.
    All give the same rows.  ``dedup_first`` drops copies of a whole row
    before anything is counted or numbered, so copies do not add up to an
    oversized group.
    """
    if dedup_first:
        df = df.dropDuplicates()
    base = parse_times(anonymise(df), on_error)
    if method == "window":
        # Oversized groups go first, so the window sees bounded groups only.
        keyed = base.filter(keys_present())
        keyed = keyed.join(_oversized(keyed, threshold), GROUP_KEYS, "left_anti")
        # numbering, distinct and the max window share one key partitioning
        numbered = _project(keyed.withColumn(SEARCH_NO, F.row_number().over(_number_window()).cast("bigint")))
        top = F.max(_q(SEARCH_NO)).over(Window.partitionBy(*[_q(k) for k in GROUP_KEYS]))
        kept = numbered.dropDuplicates().withColumn("__top", top).filter(F.col("__top") <= threshold)
        return _project(kept).unionByName(_null_key_rows(base, distinct=True))
    if method == "antijoin":
        numbered = _number_keyed(base)
        dedup = numbered.dropDuplicates()
        bad = dedup.filter(_q(SEARCH_NO) > threshold).select(*[_q(k) for k in GROUP_KEYS]).distinct()
        kept = dedup.join(bad, GROUP_KEYS, "left_anti")
        return _project(kept).unionByName(_null_key_rows(base, distinct=True))
    if method not in ("ranked", "presize"):
        raise ValueError(f"unknown method {method!r}")
    if on_error == "raise":
        # A parsed time is null exactly when its text is: test the keys on the
        # stored columns, so the null tests reach the Parquet scan (row groups
        # without nulls are skipped by the null-key branch).
        keyed = parse_times(anonymise(df.filter(keys_present())), on_error)
        null_part = _null_key_rows(
            parse_times(anonymise(df.filter(keys_missing())), on_error), distinct=True, filtered=True
        )
    else:
        keyed = base.filter(keys_present())
        null_part = _null_key_rows(base, distinct=True)
    if method == "ranked":
        ranked = keyed.withColumn("__n", F.row_number().over(_number_window())).filter(F.col("__n") <= threshold + 1)
        top = F.max("__n").over(Window.partitionBy(*[_q(k) for k in GROUP_KEYS]))
        kept = ranked.withColumn("__top", top).filter(F.col("__top") <= threshold)
        return _project(kept.withColumn(SEARCH_NO, F.col("__n").cast("bigint"))).unionByName(null_part)
    kept = keyed.join(_oversized(keyed, threshold), GROUP_KEYS, "left_anti")
    numbered = kept.withColumn(SEARCH_NO, F.row_number().over(_number_window()).cast("bigint"))
    return _project(numbered).unionByName(null_part)


def explode_filters(df: DataFrame, strict: bool = False, position: str | None = None, values: bool = False) -> DataFrame:
    """Rows with notes -> one row per element of a non-empty ``Filters`` list.

    The element (JSON text, or with ``values`` a VARIANT, which tells a text
    element from an object) replaces ``Notes``; rows without usable filters are
    dropped.  ``position`` names an optional 0-based element index column.
    """
    from sheetcraft.functions import jsonpath as J

    J.accept_repeated_keys(df.sparkSession)
    notes = _q(NOTES)
    if strict:
        from sheetcraft.session import ship_package

        ship_package(df.sparkSession)
    rest = [_q(c) for c in df.columns if c != NOTES]
    if values and not strict:
        # Parsed once, as a column; the explode takes the list itself, not a column
        # of it, as Spark filters on such a column and would parse again for that.
        df = df.select(*rest, J.parse_ended(notes).alias(NOTES))
        parsed = J.filters_ended(notes)
    else:
        df = df.filter(notes.isNotNull())
        if values:
            parsed = F.transform(J.filter_texts_strict(notes), F.try_parse_json)
        else:
            parsed = J.parse_filters_strict(notes) if strict else parse_filters(notes)
        df = df.select(*rest, parsed.alias(NOTES)).filter(notes.isNotNull())
        parsed = notes
    if position:
        return df.select(*rest, F.posexplode(parsed).alias(position, NOTES))
    return df.select(*rest, F.explode(parsed).alias(NOTES))


def _schema_leaves(df: DataFrame, schema: str) -> list[Leaf]:
    kind = df.sparkSession.range(0).select(F.lit(None).cast(schema).alias("x")).schema["x"].dataType
    if not isinstance(kind, T.StructType):
        raise ValueError(f"schema must be a struct type, got {schema!r}")
    leaves: list[Leaf] = []

    def walk(prefix: tuple[str, ...], fields: T.StructType) -> None:
        for f in fields.fields:
            if isinstance(f.dataType, T.StructType):
                walk((*prefix, f.name), f.dataType)
            else:
                text = isinstance(f.dataType, (T.VariantType, T.NullType))
                leaves.append(Leaf((*prefix, f.name), "string" if text else f.dataType.simpleString()))

    walk((), kind)
    return leaves


def flatten_json(
    df: DataFrame,
    column: str = NOTES,
    schema: str | None = None,
    clash_suffix: str = "_filter",
    on_clash: str = "suffix",
) -> DataFrame:
    """Replace a column of JSON objects (VARIANT, or text) by one column per
    leaf (nested objects become dotted names such as ``b.c``; lists stay whole).

    The leaf set is the union over all rows, a trie of paths (``json_trie``),
    unless ``schema`` (a Spark DDL type such as
    ``struct<a: bigint, b: struct<c: bigint>>``) is given.  Keys that differ in
    case are leaves of their own; the column of the later gets a number, as
    tables cannot hold both names.  Values that are no objects, a text that
    looks like one included, give an all-null row.  A leaf named like an
    existing column gets ``clash_suffix``, or raises with ``on_clash="error"``.
    """
    from sheetcraft.functions.jsonpath import accept_repeated_keys, parse_whole, path_segment

    accept_repeated_keys(df.sparkSession)
    rest = [c for c in df.columns if c != column]
    own = _q(column) if dict(df.dtypes)[column] == "variant" else parse_whole(_q(column))
    leaves = json_leaves(df.select(own.alias("v")), "v") if schema is None else _schema_leaves(df, schema)
    obj = F.when(is_object(own), own)
    names, cells = list(rest), [_q(c) for c in rest]
    for leaf in leaves:
        name = ".".join(leaf.path)
        if name in names:
            if on_clash == "error":
                raise ValueError(f"leaf {name!r} of {column!r} is named like a column")
            name = name + clash_suffix
        names.append(name)
        cells.append(F.try_variant_get(obj, "$" + "".join(path_segment(p) for p in leaf.path), leaf.kind))
    return with_headers(df.select(*[c.alias(f"c{i}") for i, c in enumerate(cells)]), names)


def process_referral_notes(df: DataFrame, strict: bool = False, schema: str | None = None) -> DataFrame:
    """Rows with notes -> one row per filter -> filter leaves as columns."""
    return flatten_json(explode_filters(df, strict=strict, values=True), NOTES, schema=schema)
