"""Workbook sources and sink on Spark.

* ``list_workbooks``: directory listing (``binaryFile`` with ``content``
  pruned, so only file metadata is read).
* ``scan_workbooks``: one row per sheet row, parsed in Python workers by
  ``mapInArrow`` (one task handles many files; each file is parsed once with
  all wanted sheets; output is streamed in bounded Arrow batches).
* ``sheet_catalog``: sheet names per file from one zip entry.
* ``to_table``: scanned cells -> typed table (pandas-style header names, type
  inference from cell tags, empty column/row drop).  The only data reaching the
  driver: one header row per distinct layout and one row of tag counters.
* ``write_workbooks``: DataFrame -> xlsx files written by the tasks into a
  shared folder (atomic rename; a retried task rewrites the same names).

Scale notes: a workbook is one ``binaryFile`` row (Spark caps a file at 2 GB)
and is held in one task's memory while parsed; Arrow batches are bounded by
``spark.sql.execution.arrow.maxBytesPerBatch``.  Parse once and materialize
(``sheetcraft.sources.refresh``): every later step reads Parquet.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetcraft.functions.names import any_present, with_headers
from sheetcraft.session import local_path, ship_package

CELL = T.StructType([T.StructField("t", T.StringType()), T.StructField("v", T.StringType())])
SCAN_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("mtime", T.TimestampType()),
        T.StructField("sheet_pos", T.IntegerType()),
        T.StructField("sheet", T.StringType()),
        T.StructField("_row", T.IntegerType()),
        T.StructField("_line", T.IntegerType()),
        T.StructField("layout", T.StringType()),
        T.StructField("cells", T.ArrayType(CELL)),
        T.StructField("error", T.StringType()),
    ]
)
CATALOG_SCHEMA = "path string, sheet_pos int, sheet string, error string"
_CHUNK = 4096
_PA_CELL = pa.list_(pa.struct([("t", pa.string()), ("v", pa.string())]))
_PA_SCAN = pa.schema(
    [
        ("path", pa.string()),
        ("mtime", pa.timestamp("us", tz="UTC")),
        ("sheet_pos", pa.int32()),
        ("sheet", pa.string()),
        ("_row", pa.int32()),
        ("_line", pa.int32()),
        ("layout", pa.string()),
        ("cells", _PA_CELL),
        ("error", pa.string()),
    ]
)


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _null_tokens():
    from sheetcraft.sources.files import NULL_TOKENS

    return NULL_TOKENS


def cell_value(cell: Column, null_tokens: bool = True) -> Column:
    """The text of a ``struct<t, v>`` cell; with ``null_tokens`` a string or
    error cell holding one of the pandas default NA texts is null."""
    v = cell.getField("v")
    if not null_tokens:
        return v
    is_token = cell.getField("t").isin("s", "e") & v.isin(*_null_tokens())
    return F.when(~is_token | is_token.isNull(), v)


# --- listing -----------------------------------------------------------------------


def _reader(spark: SparkSession, glob: str, recursive: bool):
    r = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    return r.option("recursiveFileLookup", "true" if recursive else "false")


def list_workbooks(
    spark: SparkSession,
    path: str,
    glob: str = "*.xlsx",
    recursive: bool = False,
    exclude: Sequence[str] = (),
) -> DataFrame:
    """Files under ``path`` (a directory or one file): path, mtime, length.

    Only metadata is read (the ``content`` column is pruned from the scan).
    """
    df = _reader(spark, glob, recursive).load(path)
    df = df.select("path", F.col("modificationTime").alias("mtime"), "length")
    return _exclude(df, exclude)


def _exclude(df: DataFrame, exclude: Sequence[str]) -> DataFrame:
    if not exclude:
        return df
    names = [os.path.basename(e) for e in exclude]
    return df.filter(~F.element_at(F.split("path", "/"), -1).isin(*names))


# --- scan ----------------------------------------------------------------------------


def _wanted(sheet_name) -> set | None:
    if sheet_name is None:
        return None
    if isinstance(sheet_name, (list, tuple, set)):
        return set(sheet_name)
    return {sheet_name}


def _layout_key(cells: list) -> str:
    text = json.dumps([c[1] if c else None for c in cells], ensure_ascii=False)
    return hashlib.sha1(text.encode("utf-8")).hexdigest()[:16]


class _ScanBuffer:
    """Column-wise buffers for scan output; cells become a list<struct> Arrow
    array built from flat arrays (no per-cell Python dicts)."""

    def __init__(self) -> None:
        self.cols = {k: [] for k in ("path", "mtime", "sheet_pos", "sheet", "_row", "_line", "layout", "error")}
        self.offsets = [0]
        self.tags: list = []
        self.vals: list = []
        self.valid: list = []
        self.row_valid: list = []

    def __len__(self) -> int:
        return len(self.cols["path"])

    def add(self, p, mtime, pos, name, row, line, layout, cells, error=None) -> None:
        c = self.cols
        c["path"].append(p)
        c["mtime"].append(mtime)
        c["sheet_pos"].append(pos)
        c["sheet"].append(name)
        c["_row"].append(row)
        c["_line"].append(line)
        c["layout"].append(layout)
        c["error"].append(error)
        if cells is None:
            self.row_valid.append(False)
        else:
            self.row_valid.append(True)
            for cell in cells:
                if cell is None:
                    self.tags.append(None)
                    self.vals.append(None)
                    self.valid.append(False)
                else:
                    self.tags.append(cell[0])
                    self.vals.append(cell[1])
                    self.valid.append(True)
        self.offsets.append(len(self.tags))

    def mark(self) -> tuple[int, int]:
        return len(self), len(self.tags)

    def rollback(self, mark: tuple[int, int]) -> None:
        rows, cells = mark
        for v in self.cols.values():
            del v[rows:]
        del self.row_valid[rows:]
        del self.offsets[rows + 1:]
        del self.tags[cells:]
        del self.vals[cells:]
        del self.valid[cells:]

    def flush(self) -> pa.RecordBatch:
        structs = pa.StructArray.from_arrays(
            [pa.array(self.tags, pa.string()), pa.array(self.vals, pa.string())],
            names=["t", "v"],
            mask=pa.array([not v for v in self.valid], pa.bool_()),
        )
        cells = pa.ListArray.from_arrays(
            pa.array(self.offsets, pa.int32()), structs, mask=pa.array([not v for v in self.row_valid], pa.bool_())
        )
        arrays = []
        for f in _PA_SCAN:
            arrays.append(cells if f.name == "cells" else pa.array(self.cols[f.name], f.type))
        batch = pa.RecordBatch.from_arrays(arrays, schema=_PA_SCAN)
        self.__init__()
        return batch


def _scan_batches(wanted, errors: str = "raise"):
    from sheetcraft.sources.xlsx import read_workbook

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buf = _ScanBuffer()
        for batch in batches:
            paths = batch.column("path").to_pylist()
            mtimes = batch.column("modificationTime")
            contents = batch.column("content")
            for i, p in enumerate(paths):
                mtime = mtimes[i].as_py()
                mark = buf.mark()
                try:
                    current, line, layout = None, 0, None
                    for pos, name, row, cells in read_workbook(contents[i].as_py(), wanted):
                        if (pos, name) != current:
                            current, line, layout = (pos, name), 0, _layout_key(cells)
                        buf.add(p, mtime, pos, name, row, line, layout, cells)
                        line += 1
                        if len(buf) >= _CHUNK and errors == "raise":
                            yield buf.flush()
                except Exception as e:  # noqa: BLE001
                    if errors == "raise":
                        raise RuntimeError(f"cannot read workbook {p}: {type(e).__name__}: {e}") from e
                    buf.rollback(mark)
                    buf.add(p, mtime, None, None, -1, None, None, None, f"{type(e).__name__}: {e}")
                if errors != "raise" and len(buf) >= _CHUNK:
                    yield buf.flush()
        if len(buf):
            yield buf.flush()

    return run


def scan_files(files: DataFrame, sheet_name=0, errors: str = "raise") -> DataFrame:
    """Parse a ``binaryFile`` frame (path, modificationTime, content).

    ``errors="reject"``: a file that cannot be read gives one row with
    ``_row = -1`` and ``error`` set instead of failing the job.
    """
    ship_package(files.sparkSession)
    return files.select("path", "modificationTime", "content").mapInArrow(
        _scan_batches(_wanted(sheet_name), errors), SCAN_SCHEMA
    )


def scan_workbooks(
    spark: SparkSession,
    path: str,
    sheet_name=0,
    glob: str = "*.xlsx",
    recursive: bool = False,
    exclude: Sequence[str] = (),
) -> DataFrame:
    """One row per present sheet row of every matching workbook.

    ``sheet_name``: position (0-based) or name, a list of them, or None for all
    sheets.  ``_row`` is the sheet row index, ``_line`` the ordinal among present
    rows (0 = header row), ``layout`` a key of the sheet's header row.
    """
    files = _exclude(_reader(spark, glob, recursive).load(path), exclude)
    return scan_files(files, sheet_name)


# --- catalog ---------------------------------------------------------------------------


def _catalog_batches(on_error: str):
    from sheetcraft.sources.xlsx import sheet_names

    def run(batches):
        for batch in batches:
            out = {"path": [], "sheet_pos": [], "sheet": [], "error": []}
            paths = batch.column("path").to_pylist()
            contents = batch.column("content")
            for i, p in enumerate(paths):
                try:
                    names = sheet_names(p, contents[i].as_py())
                except Exception as e:  # noqa: BLE001
                    if on_error == "raise":
                        raise
                    out["path"].append(p)
                    out["sheet_pos"].append(None)
                    out["sheet"].append(None)
                    out["error"].append(f"{type(e).__name__}: {e}")
                    continue
                for pos, n in enumerate(names):
                    out["path"].append(p)
                    out["sheet_pos"].append(pos)
                    out["sheet"].append(n)
                    out["error"].append(None)
            yield pa.RecordBatch.from_pydict(
                out,
                schema=pa.schema(
                    [("path", pa.string()), ("sheet_pos", pa.int32()), ("sheet", pa.string()), ("error", pa.string())]
                ),
            )

    return run


def sheet_catalog(
    spark: SparkSession,
    path: str,
    glob: str = "*.xls[xmb]",
    recursive: bool = False,
    on_error: str = "raise",
) -> DataFrame:
    """Sheet names per workbook in workbook order (xlsx: ``xl/workbook.xml``;
    xlsm/xlsb: ``docProps/app.xml``).  Other suffixes raise, or give a row with
    ``error`` set when ``on_error="reject"``."""
    ship_package(spark)
    files = _reader(spark, glob, recursive).load(path).select("path", "content")
    return files.mapInArrow(_catalog_batches(on_error), CATALOG_SCHEMA)


# --- typed table ------------------------------------------------------------------------


def pandas_names(texts: Sequence[str | None]) -> list[str]:
    """Header texts -> unique column names the way the pandas reader makes
    them: blank -> ``Unnamed: i``; a repeat of ``x`` -> ``x.1``, ``x.2``...
    (the first free suffix)."""
    names = [t if t is not None and t != "" else f"Unnamed: {i}" for i, t in enumerate(texts)]
    taken: set[str] = set()
    next_suffix: dict[str, int] = {}
    out = []
    for n in names:
        cand = n
        if cand in taken:
            k = next_suffix.get(n, 1)
            while f"{n}.{k}" in taken:
                k += 1
            cand = f"{n}.{k}"
            next_suffix[n] = k + 1
        taken.add(cand)
        out.append(cand)
    return out


_NAMES = T.ArrayType(T.StringType())


def layout_names(cells: DataFrame, header: bool = True) -> DataFrame:
    """One row a layout: ``layout, first`` (its first file and sheet) and
    ``names``, a column name for every cell of its widest row."""
    ship_package(cells.sparkSession)
    # A row a sheet by hash aggregate, its header row apart: no sort of the cells.
    sheets = cells.groupBy("layout", "path", "sheet_pos").agg(F.max(F.size("cells")).alias("width"))
    texts = F.transform("cells", lambda c: c.getField("v"))
    tops = cells.filter(F.col("_line") == 0).select("layout", texts.alias("head"))
    heads = (
        sheets.groupBy("layout")
        .agg(F.min(F.struct("path", "sheet_pos")).alias("first"), F.max("width").alias("width"))
        .join(tops.groupBy("layout").agg(F.any_value("head").alias("head")), "layout", "left")
    )

    def unique(head: pd.Series, width: pd.Series) -> pd.Series:
        out = []
        for own, n in zip(head, width):
            own = [] if own is None else list(own)
            out.append(pandas_names(own + [None] * (n - len(own))))
        return pd.Series(out)

    if header:
        names = F.pandas_udf(unique, _NAMES)("head", "width")
    else:
        names = F.transform(F.sequence(F.lit(0), F.col("width") - 1), lambda i: i.cast("string"))
        names = F.when(F.col("width") > 0, names).otherwise(F.array().cast(_NAMES))
    return heads.select("layout", "first", names.alias("names"))


def by_name(cells: DataFrame) -> DataFrame:
    """Adds ``named``: a map from the row's ``names`` to its cells (null where
    the row is short); cells without a name are left out."""
    pairs = F.arrays_zip("names", "cells")
    return cells.withColumn(
        "named",
        F.map_from_entries(
            F.filter(
                F.transform(pairs, lambda x: F.struct(x["names"].alias("key"), x["cells"].alias("value"))),
                lambda x: x["key"].isNotNull(),
            )
        ),
    )


def column_order(named: DataFrame, order: Sequence[str] = ()) -> list[str]:
    """Distinct names of ``first, names`` rows, by where they first occur: what
    reaches the driver is one row a column of the table."""
    places = named.select("first", F.posexplode("names").alias("pos", "name"), *order)
    firsts = places.groupBy("name").agg(F.min(F.struct(*order, "first", "pos")).alias("at"))
    return [r["name"] for r in firsts.orderBy("at", "name").collect()]


def column_types(named: DataFrame, null_tokens: bool = True) -> dict[str, tuple[str | None, bool]]:
    """Best type of each name over the maps of ``by_name``, and whether it
    mixes texts with other cells, from one aggregate: integral numbers ->
    bigint, numbers -> double, booleans -> boolean, dates -> timestamp_ntz,
    else string; None if there is no value."""
    cell = named.select(F.explode("named").alias("name", "c"))
    return _kinds(cell.groupBy("name").agg(*_counters(F.col("c"), null_tokens)))


def _counters(c: Column, null_tokens: bool) -> list[Column]:
    t = c.getField("t")
    num = F.when(t == "n", c.getField("v").try_cast("double"))
    whole = (num == F.floor(num)) & (F.abs(num) < 9.2e18)
    return [
        F.count(cell_value(c, null_tokens)).alias("all"),
        F.count_if(t == "n").alias("n"),
        F.count_if(whole).alias("i"),
        F.count_if(t == "b").alias("b"),
        F.count_if(t == "d").alias("d"),
    ]


def _kinds(counts: DataFrame) -> dict[str, tuple[str | None, bool]]:
    out = {}
    for r in counts.collect():
        kind = _decide(r["all"], r["n"], r["i"], r["b"], r["d"])
        out[r["name"]] = kind, kind == "string" and r["n"] + r["b"] + r["d"] > 0
    return out


def _place_types(cells: DataFrame, layouts: DataFrame, first: int, null_tokens: bool) -> dict[str, tuple[str | None, bool]]:
    """As ``column_types``, from the cells themselves: counters a layout and
    position first, so only these meet the names."""
    cell = cells.filter(F.col("_line") >= first).select("layout", F.posexplode("cells").alias("pos", "c"))
    places = cell.groupBy("layout", "pos").agg(*_counters(F.col("c"), null_tokens))
    named = layouts.select("layout", F.posexplode("names").alias("pos", "name"))
    sums = [F.sum(c).alias(c) for c in ("all", "n", "i", "b", "d")]
    return _kinds(named.join(places, ["layout", "pos"]).groupBy("name").agg(*sums))


def typed_value(c: Column, dtype: str | None, null_tokens: bool = True) -> Column:
    v = cell_value(c, null_tokens)
    if dtype is None or dtype == "string":
        # in a mixed text column a boolean cell reads as Python prints it
        t = c.getField("t")
        return F.when(t == "b", F.when(v == "true", F.lit("True")).otherwise(F.lit("False"))).otherwise(v)
    if dtype == "bigint":
        # through double only for texts such as 3.0 or 1E3: 2**53 + 1 is no double
        return F.coalesce(v.try_cast("bigint"), v.try_cast("double").try_cast("bigint"))
    # A filter on the value may run on header rows too, before they are left out.
    return v.try_cast(dtype)


def _decide(all_, n, i, b, d) -> str | None:
    if all_ == 0:
        return None
    if i == all_:
        return "bigint"
    if n == all_:
        return "double"
    if b == all_:
        return "boolean"
    if d == all_:
        return "timestamp_ntz"
    return "string"


def to_table(
    cells: DataFrame,
    header: bool = True,
    infer_types: bool = True,
    drop_empty: bool = True,
    with_source: bool = False,
    null_tokens: bool = True,
) -> DataFrame:
    """Scanned cells -> one typed table for all files and sheets.

    ``header``: the first present row of each sheet names the columns (pandas
    names); otherwise columns are ``0, 1, ...``.  Files with different headers
    are unioned by header text, case included; texts that differ in case alone
    get a suffix (``names.stored_names``), as tables could not be written
    otherwise.  ``drop_empty`` drops all-null columns, then all-null
    rows.  ``with_source`` keeps ``path, sheet_pos, sheet, _row``.
    ``null_tokens``: string cells with a pandas default NA text are null.
    The plan joins the cells to a table with a row a layout, whatever their
    number; column names and types come from one aggregate each.  That table is
    written first: of known size, it is broadcast where small, and cells of one
    layout are not dealt to one task.  In columns that mix texts with other
    cells the text ``nan`` is null.
    """
    first = 1 if header else 0
    layouts = _written(layout_names(cells, header))
    order = column_order(layouts)
    if not order:
        return cells.sparkSession.createDataFrame([], T.StructType([]))
    found = _place_types(cells, layouts, first, null_tokens)
    kinds = {n: found.get(n, (None, False)) for n in order}
    if not infer_types:
        kinds = {n: ("string", False) for n in order}
    src = ["path", "sheet_pos", "sheet", "_row"] if with_source else []
    return _typed_rows(cells, layouts, first, [(n, *kinds[n]) for n in order], src, drop_empty, null_tokens)


def _written(layouts: DataFrame) -> DataFrame:
    from sheetcraft.sources.files import materialize

    return materialize(layouts, "layouts")


def _typed_rows(
    cells: DataFrame,
    layouts: DataFrame,
    first: int,
    columns: Sequence[tuple[str, str | None, bool]],
    src: Sequence[str],
    drop_empty: bool,
    null_tokens: bool,
) -> DataFrame:
    """Cells -> typed columns ``(name, type, mixed)`` after ``src``: a layout
    holds the position of each column in its rows, null where it has none."""
    keep = [c for c in columns if not (drop_empty and c[1] is None)]
    at = [F.nullif(F.array_position("names", F.lit(c[0])), F.lit(0)).cast("int") - 1 for c in keep]
    at = F.array(*at).cast("array<int>").alias("__at")
    rows = cells.filter(F.col("_line") >= first).join(layouts.select("layout", at), "layout")
    values = []
    for i, (_, kind, mixed) in enumerate(keep):
        value = typed_value(F.get(F.col("cells"), F.get(F.col("__at"), F.lit(i))), kind, null_tokens)
        values.append(F.nullif(value, F.lit("nan")) if mixed else value)
    places = [f"c{i}" for i in range(len(keep))]
    out = rows.select(*[F.col(c).alias(f"s{i}") for i, c in enumerate(src)], *[v.alias(c) for v, c in zip(values, places)])
    if drop_empty and keep:
        out = out.filter(any_present([F.col(c) for c in places]))
    return with_headers(out, [*src, *[c[0] for c in keep]])


# --- typed table from states of its files -------------------------------------------------


STATE_SCHEMA = (
    "src string, layout string, path string, sheet_pos int, pos int, head string,"
    " `all` bigint, n bigint, i bigint, b bigint, d bigint"
)


def file_states(cells: DataFrame, header: bool = True, null_tokens: bool = True) -> DataFrame:
    """What a file adds to the columns of the table: a row a file, sheet and
    cell position, with the header text and the counters that decide a type.
    The states of all files together give ``collected_columns``, so a file can
    change without the cells of the others being read.  ``cells`` has a
    column ``src`` that names the file."""
    c, data = F.col("c"), F.col("_line") >= (1 if header else 0)
    t, num = F.col("c.t"), F.col("c.v").try_cast("double")
    whole = (num == F.floor(num)) & (F.abs(num) < 9.2e18)
    key = ["src", "layout", "path", "sheet_pos"]
    cell = cells.select(*key, "_line", F.posexplode("cells").alias("pos", "c"))
    return cell.groupBy(*key, "pos").agg(
        F.max(F.when(F.col("_line") == 0, F.col("c.v"))).alias("head"),
        F.count(F.when(data, cell_value(c, null_tokens))).alias("all"),
        F.count_if(data & (t == "n")).alias("n"),
        F.count_if(data & (t == "n") & whole).alias("i"),
        F.count_if(data & (t == "b")).alias("b"),
        F.count_if(data & (t == "d")).alias("d"),
    )


def collected_columns(states: DataFrame, header: bool = True) -> tuple[DataFrame, list[tuple[str, str | None, bool]]]:
    """``(layout, names)`` and the columns ``(name, type, mixed)``, in order,
    of the table of all files with these states, as ``to_table`` finds them in
    the cells.  Counters are added up a layout and position first, so what is
    grouped is no larger than the header; the driver gets a row a column."""
    ship_package(states.sparkSession)
    places = states.groupBy("layout", "pos").agg(
        F.max("head").alias("head"),
        F.min(F.struct("path", "sheet_pos")).alias("first"),
        *[F.sum(c).alias(c) for c in ("all", "n", "i", "b", "d")],
    )
    whole = places.groupBy("layout").agg(
        F.array_sort(F.collect_list(F.struct("pos", "head"))).alias("heads"), F.min("first").alias("first")
    )
    heads = F.transform("heads", lambda h: h["head"])

    def unique(head: pd.Series) -> pd.Series:
        return pd.Series([pandas_names(list(own)) for own in head])

    names = F.pandas_udf(unique, _NAMES)(heads) if header else F.transform("heads", lambda h: h["pos"].cast("string"))
    layouts = _written(whole.select("layout", "first", names.alias("names")))
    named = layouts.select("layout", "first", F.posexplode("names").alias("pos", "name"))
    sums = [F.sum(c).alias(c) for c in ("all", "n", "i", "b", "d")]
    found = named.join(places.drop("first"), ["layout", "pos"]).groupBy("name").agg(F.min(F.struct("first", "pos")).alias("at"), *sums)
    columns = []
    for r in found.orderBy("at", "name").collect():
        kind = _decide(r["all"], r["n"], r["i"], r["b"], r["d"])
        columns.append((r["name"], kind, kind == "string" and r["n"] + r["b"] + r["d"] > 0))
    return layouts.select("layout", "names"), columns


def to_table_of(
    cells: DataFrame,
    layouts: DataFrame,
    columns: Sequence[tuple[str, str | None, bool]],
    header: bool = True,
    src: Sequence[str] = (),
    null_tokens: bool = True,
) -> DataFrame:
    """The rows that ``cells``, of any of the files, give in the table of
    ``collected_columns``; ``src`` are columns of the cells to keep."""
    if not columns:
        return cells.select(*src).limit(0)
    return _typed_rows(cells, layouts, 1 if header else 0, columns, list(src), True, null_tokens)


# --- sink ---------------------------------------------------------------------------------


def _write_batches(out_dir, columns, header, header_rows, rows_per_file, sheet, sheet_col, prefix):
    def run(batches):
        from pyspark import TaskContext

        from sheetcraft.sources.xlsx import WorkbookWriter

        pid = TaskContext.get().partitionId()
        base = local_path(out_dir)
        st = {"w": None, "fh": None, "tmp": None, "final": None, "rows": 0, "chunk": 0, "sheet": None}
        written = {"path": [], "rows": []}

        def start_sheet(name):
            st["w"].start_sheet(str(name))
            st["w"].write_row(header)
            for extra in header_rows or ():
                st["w"].write_row(extra)
            st["sheet"] = name

        def open_new(name):
            final = os.path.join(base, f"{prefix}-{pid:05d}-{st['chunk']:04d}.xlsx")
            tmp = final + f".{uuid.uuid4().hex[:8]}.tmp"
            st["fh"] = open(tmp, "wb")  # noqa: SIM115
            st["w"] = WorkbookWriter(st["fh"])
            st.update(tmp=tmp, final=final, rows=0)
            start_sheet(name)

        def close():
            if st["w"] is None:
                return
            st["w"].close()
            st["fh"].close()
            os.replace(st["tmp"], st["final"])
            written["path"].append("file:" + st["final"])
            written["rows"].append(st["rows"])
            st["chunk"] += 1
            st["w"] = None

        for batch in batches:
            data = batch.to_pydict()
            sheets = data[sheet_col] if sheet_col else None
            for i in range(batch.num_rows):
                name = sheets[i] if sheet_col else sheet
                if st["w"] is None:
                    open_new(name)
                elif name != st["sheet"]:
                    start_sheet(name)
                st["w"].write_row([data[c][i] for c in columns])
                st["rows"] += 1
                if st["rows"] >= rows_per_file:
                    close()
        close()
        yield pa.RecordBatch.from_pydict(written, schema=pa.schema([("path", pa.string()), ("rows", pa.int64())]))

    return run


def write_workbooks(
    df: DataFrame,
    out_dir: str,
    rows_per_file: int = 100_000,
    sheet: str = "Sheet1",
    header: Sequence | None = None,
    header_rows: Sequence[Sequence] | None = None,
    sheet_col: str | None = None,
    prefix: str = "part",
) -> DataFrame:
    """Write each partition's rows as xlsx files of at most ``rows_per_file``
    rows: the header row (``header`` or the column names), then
    ``header_rows``, then data.

    ``sheet_col``: one sheet per value of that column (rows are sorted by it
    within each partition, no shuffle; the column itself is not written).
    Runs when the returned manifest (path, rows) is evaluated.  ``out_dir``
    must be a folder every executor can write (a shared mount).  Files appear
    under their final names only when complete, and a retried task rewrites
    the same names.
    """
    base = local_path(out_dir)
    if base is None:
        raise ValueError("write_workbooks needs a file: or POSIX path")
    os.makedirs(base, exist_ok=True)
    columns = [c for c in df.columns if c != sheet_col]
    header = list(header) if header is not None else columns
    src = df.sortWithinPartitions(sheet_col) if sheet_col else df
    ship_package(df.sparkSession)
    return src.mapInArrow(
        _write_batches(out_dir, columns, header, header_rows, rows_per_file, sheet, sheet_col, prefix),
        "path string, rows bigint",
    )
