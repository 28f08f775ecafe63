"""Reshape and table hygiene: wide->long by group, empty row/column drops,
type inference over text cells, union of differently shaped tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetcraft.functions.names import (
    ColumnDictionary,
    any_present,
    by_position,
    fields_by_position,
    headers_of,
    quoted,
    with_headers,
)
from sheetcraft.operators.lattice import text_states, with_types

AGE_GROUP = "Age Group"
Place = str | tuple[str, str]  # of a measure: a column, or a struct column and its field


# --- wide -> long ------------------------------------------------------------


def groups_from_structs(df: DataFrame, keys: Sequence[str]) -> dict[str, dict[str, Place]]:
    """Group layout of a header-inferred table: each non-key struct column is a
    group, its fields are the measures."""
    out: dict[str, dict[str, Place]] = {}
    for f, header in zip(df.schema.fields, headers_of(df)):
        if f.name in keys or header in keys:
            continue
        if not isinstance(f.dataType, T.StructType):
            raise ValueError(f"column {f.name!r} is not a group (struct) column")
        out[header] = {m.name: (f.name, m.name) for m in f.dataType.fields}
    return out


class _Places:
    """Measures of a table by place: no name is resolved by Spark."""

    def __init__(self, df: DataFrame):
        self.own, headers = by_position(df)
        self.names = {n: i for i, n in reversed(list(enumerate(df.columns)))}
        self.names = {h: i for i, h in reversed(list(enumerate(headers)))} | self.names
        self.kinds = [f.dataType for f in df.schema.fields]

    def __call__(self, place: Place) -> tuple[Column, T.DataType]:
        if isinstance(place, str) and place not in self.names and "." in place:
            place = next(((a, place[len(a) + 1 :]) for a in sorted(self.names, key=len) if place.startswith(a + ".")), place)
        column, *field = (place,) if isinstance(place, str) else place
        i = self.names[column]
        if not field:
            return F.col(f"c{i}"), self.kinds[i]
        at = next(k for k, f in enumerate(self.kinds[i].fields) if f.name == field[0])
        return fields_by_position(F.col(f"c{i}"), self.kinds[i]).getField(f"f{at}"), self.kinds[i].fields[at].dataType


def unstack_groups(
    df: DataFrame,
    keys: Sequence[str],
    groups: Mapping[str, Mapping[str, Place]] | None = None,
    group_col: str = AGE_GROUP,
    drop_all_null: bool = True,
    key_casts: Mapping[str, str] | None = None,
) -> DataFrame:
    """Move the top header level (group) from columns to a key column.

    ``groups`` maps group -> {measure -> column}; by default it is read from
    struct columns.  Rows whose measures are all null are dropped first
    (``drop_all_null``); after that every (row, group) pair is kept, and a
    measure missing from a group is null.  Narrow: one ``Generate`` (inline),
    no exchange, the input is scanned once.
    """
    if groups is None:
        groups = groups_from_structs(df, keys)
    at = _Places(df)
    measures = list(dict.fromkeys(name for m in groups.values() for name in m))
    found = {(g, name): at(place) for g, m in groups.items() for name, place in m.items()}
    src = at.own
    if drop_all_null:
        src = src.filter(any_present([c for c, _ in found.values()]))
    # Common type per measure across groups (e.g. int capacity vs bigint).
    types: dict[str, T.DataType] = {}
    for (_, name), (_, kind) in found.items():
        types[name] = _wider(types[name], kind) if name in types else kind
    rows = []
    for g in groups:
        values = [found.get((g, name), (F.lit(None), None))[0].cast(types[name]) for name in measures]
        rows.append(F.struct(F.lit(g).alias("g"), *[v.alias(f"m{i}") for i, v in enumerate(values)]))
    casts = key_casts or {}
    key_cols = [at(k)[0].cast(casts[k]) if k in casts else at(k)[0] for k in keys]
    long = src.select(*[k.alias(f"k{i}") for i, k in enumerate(key_cols)], F.inline(F.array(*rows)))
    return with_headers(long, [*keys, group_col, *measures])


def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b:
        return a
    order = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()]
    if a in order and b in order:
        return order[max(order.index(a), order.index(b))]
    return T.StringType()


# --- empty rows and columns ----------------------------------------------------


def drop_all_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Without the rows that hold no value (in the columns of ``subset``)."""
    own, headers = by_position(df)
    wanted = None if subset is None else set(subset)
    cells = [F.col(f"c{i}") for i, (n, h) in enumerate(zip(df.columns, headers)) if wanted is None or n in wanted or h in wanted]
    return with_headers(own.filter(any_present(cells)), headers) if cells else df


def drop_empty(df: DataFrame) -> DataFrame:
    """Drop all-null columns, then all-null rows; column names may hold
    anything and repeat.

    The live-column test is one aggregate (a single result row reaches the
    driver); pass the output through a written table when the input is
    expensive, since the rows are read again.
    """
    if not df.columns:
        return df
    own, headers = by_position(df)
    counts = own.agg(*[F.count(c).alias(c) for c in own.columns]).first()
    live = [i for i, c in enumerate(own.columns) if counts[c] > 0]
    if not live:
        return df.sparkSession.createDataFrame([], T.StructType([]))
    cells = [F.col(f"c{i}") for i in live]
    return with_headers(own.select(*cells).filter(any_present([F.col(f"c{i}") for i in live])), [headers[i] for i in live])


# --- types of texts ---------------------------------------------------------------


def infer_text_types(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, str]:
    """The type of each text column that keeps every value, from one aggregate
    (see ``lattice``).  All-null columns stay text."""
    places = None if columns is None else [df.columns.index(c) for c in columns]
    return {df.columns[i]: state.type() for i, state in text_states(df, places).items()}


def apply_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return with_types(df, {df.columns.index(c): t for c, t in types.items()})


def retype(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Infer and apply the types of text columns (one extra pass); no value
    changes its text."""
    return apply_types(df, infer_text_types(df, columns))


def nan_text_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Mixed columns as text with the literal ``nan`` as null."""
    own, headers = by_position(df)
    cols = set(columns) if columns is not None else {c for c, t in df.dtypes if t == "string"}
    cells = [F.nullif(F.col(f"c{i}"), F.lit("nan")) if c in cols else F.col(f"c{i}") for i, c in enumerate(df.columns)]
    return with_headers(own.select(*[c.alias(f"c{i}") for i, c in enumerate(cells)]), headers)


# --- union -----------------------------------------------------------------------


def _text(c: Column, kind: T.DataType) -> Column:
    """A value as it reads in a mixed column: booleans as True and False."""
    if isinstance(kind, T.BooleanType):
        return F.when(c, F.lit("True")).when(~c, F.lit("False"))
    return c.cast("string")


def union_mixed(frames: Sequence[DataFrame], infer: bool = False) -> DataFrame:
    """Vertical union by header text, case included; a column missing from a
    frame is null, and one that repeats in a frame counts as the next column of
    that name.

    Number columns of several types get the widest; columns whose kinds differ
    otherwise are text, with the text ``nan`` as null, and no text changes.
    With ``infer`` such columns are typed again where that loses nothing.
    """
    if not frames:
        raise ValueError("no frames")
    order, own, kinds = ColumnDictionary(), [], {}
    for frame in frames:
        times: dict[str, int] = {}
        places = {}
        for i, (header, field) in enumerate(zip(headers_of(frame), frame.schema.fields)):
            times[header] = times.get(header, 0) + 1
            at = order.add(header if times[header] == 1 else f"{header}.{times[header] - 1}")
            places[at] = i, field.dataType
            kinds.setdefault(at, []).append(field.dataType)
        own.append(places)
    final, mixed = {}, []
    for at, found in kinds.items():
        kind = found[0]
        for other in found[1:]:
            kind = _wider(kind, other)
        final[at] = kind
        if kind == T.StringType() and any(f != kind for f in found):
            mixed.append(at)
    aligned = []
    for frame, places in zip(frames, own):
        cells = []
        for at in range(len(order)):
            c = F.lit(None).cast(final[at])
            if at in places:
                i, kind = places[at]
                c = F.col(f"c{i}")
                c = F.nullif(_text(c, kind), F.lit("nan")) if at in mixed else c.cast(final[at])
            cells.append(c.alias(f"u{at}"))
        aligned.append(by_position(frame)[0].select(*cells))
    out = aligned[0]
    for frame in aligned[1:]:
        out = out.union(frame)
    out = order.named(out)
    return retype(out, [out.columns[at] for at in mixed]) if infer and mixed else out


# --- forward fill ---------------------------------------------------------------------


def distinct_rows(df: DataFrame) -> DataFrame:
    """Each row once, as ``dropDuplicates`` gives it, for rows with long texts:
    a digest of 128 bits is counted (16 bytes a row are shuffled, summed up on
    the map side), and only rows whose digest comes again are compared in full.
    The others pass by the join with these digests, which AQE broadcasts where
    they are few."""
    headers = df.columns
    rows = df.toDF(*[f"c{i}" for i in range(len(headers))])
    columns = [F.col(c) for c in rows.columns]
    # Two hashes of different column orders and seeds make up the digest.
    digest = {"h1": F.xxhash64(*columns), "h2": F.xxhash64(F.lit(1), *reversed(columns))}
    keyed = rows.withColumns(digest)
    again = keyed.groupBy("h1", "h2").count().filter("count > 1").select("h1", "h2")
    alone = keyed.join(again, ["h1", "h2"], "left_anti").select(*columns)
    several = keyed.join(again, ["h1", "h2"], "left_semi").select(*columns).dropDuplicates()
    return alone.unionAll(several).toDF(*headers)


def forward_fill(
    df: DataFrame,
    columns: Sequence[str],
    partition_by: Sequence[str],
    order_by: Sequence[str],
) -> DataFrame:
    """Fill nulls downward with the last non-null value in ``order_by`` order
    (ascending, nulls first) within ``partition_by``; a null there is a value
    like any other.

    Rows are range-partitioned as for numbering: each partition fills its part
    of a group, and the last value of the group's earlier partitions (a row a
    group and partition) is carried in.  One plan for every group size.
    """
    from sheetcraft.operators.numbering import KEY, PART, PLACE, earlier_parts, in_order, within_part

    rows = in_order(df, partition_by, order_by)
    running = within_part().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = rows.withColumns({c: F.last(quoted(c), ignorenulls=True).over(running) for c in columns})
    ends = rows.groupBy(PART, KEY).agg(
        *[F.max_by(quoted(c), F.when(quoted(c).isNotNull(), F.col(PLACE))).alias(f"__end{i}") for i, c in enumerate(columns)]
    )
    carried = ends.select(
        PART,
        KEY,
        *[F.last(f"__end{i}", ignorenulls=True).over(earlier_parts()).alias(f"__in{i}") for i in range(len(columns))],
    )
    out = filled.join(carried, [PART, KEY]).withColumns(
        {c: F.coalesce(quoted(c), F.col(f"__in{i}")) for i, c in enumerate(columns)}
    )
    return out.select(*[quoted(c) for c in df.columns])
