"""Refresh-if-stale materialization of a workbook directory.

Layout under ``target`` (any Hadoop path; the shared folder in tests):

* ``cells/g=<n>/``     cells of all files that refresh n parsed (one Parquet
  table); a generation goes when no file of the manifest refers to it, and
  many generations are merged into one;
* ``table/v=<n>/``     the collected table (pre-processors applied), in the
  chosen format;
* ``parts/g=<n>/``     instead of it, with ``row_wise``: the table's rows of the
  files that refresh n processed, with a column ``_src`` naming the file;
* ``states-<h>/g=<n>/`` with ``row_wise``: what each file of a generation adds to
  the names and types of the columns (``workbooks.file_states``);
* ``manifest/v=<n>/``  one row per source file: path, src, mtime, length, ops
  fingerprint, status, error, generation of its cells, generation of its rows,
  and fingerprint and columns of the table they belong to.

A refresh writes generation n, then table n, then manifest n.  The manifest is
the commit: readers take the newest complete one and the table it names, so a
refresh that fails at any point leaves the previous state as it was, and stale.

A file is fresh when its (path, mtime, length) and what it was parsed with equal
the manifest's.  The table is stale when a file is, when one was deleted, or when
the fingerprint of options and pre-processors differs.  Only stale files are
parsed; the table is rebuilt from the cells (Parquet), never by re-parsing fresh
workbooks, also where a processor changed.  The fingerprint covers a processor's
source, the values it captured, its defaults, the plain module values it names and
an object's class and attributes; a processor that cannot be described that way
counts as changed.

``row_wise=True`` declares that the pre-processors treat each row by itself and
keep the column ``_src``.  Then a refresh adds the rows of the files that changed
and leaves those of the others: names and types follow from the files' states, and
only where a column's name, place or type changes is every row made again.

Policies (``refresh(policy=...)``):
  ``check`` (default)  reuse when fresh, else parse stale files and rebuild;
  ``fallback``         as check, but a file that fails to parse keeps its
                       previous cells (error if it has none);
  ``force``            parse every file and rebuild;
  ``skip``             read the sources directly, write nothing;
  ``only_cached``      read the materialized table only;
  any callable         ``policy(refresher) -> DataFrame``.
Post-processors run on every returned table and are never persisted.
"""

from __future__ import annotations

import functools
import hashlib
import inspect
import json
import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetcraft.sources import files as FS
from sheetcraft.sources import workbooks as W
from sheetcraft.sources.files import materialize

Processor = Callable[[DataFrame], DataFrame]
MAX_GENERATIONS = 16  # cell tables before they are merged into one
POLICIES = ("check", "fallback", "force", "skip", "only_cached")
MANIFEST_SCHEMA = (
    "path string, src string, mtime timestamp, length bigint, ops_fingerprint string, status string, error string,"
    " generation int, part int, table_fingerprint string, table_columns string"
)
SRC = "_src"  # the file a row of a row-wise table comes from


def _listify(p) -> list[Processor]:
    if p is None:
        return []
    if callable(p):
        return [p]
    return list(p)


_PLAIN = (str, bytes, int, float, bool, complex, type(None), re.Pattern)


def _describe(value, seen: tuple = ()) -> str:
    """A text that is equal for equal values; new each time for values that
    cannot be told apart by their parts."""
    if isinstance(value, _PLAIN):
        return f"{type(value).__name__}:{value!r}"
    if isinstance(value, (list, tuple)):
        return f"{type(value).__name__}({','.join(_describe(v, seen) for v in value)})"
    if isinstance(value, (set, frozenset)):
        return f"set({','.join(sorted(_describe(v, seen) for v in value))})"
    if isinstance(value, dict):
        return f"dict({','.join(sorted(_describe(k, seen) + '=' + _describe(v, seen) for k, v in value.items()))})"
    if isinstance(value, functools.partial):
        return f"partial({_describe(value.func, seen)},{_describe(value.args, seen)},{_describe(value.keywords, seen)})"
    if inspect.ismodule(value) or inspect.isclass(value) or inspect.isbuiltin(value):
        return f"named:{getattr(value, '__module__', '')}.{getattr(value, '__qualname__', value.__name__)}"
    if inspect.ismethod(value):
        return f"method({_describe(value.__func__, seen)},{_describe(vars(value.__self__), seen)})"
    if inspect.isfunction(value):
        return _fingerprint_of(value, seen)
    kind = type(value)
    if hasattr(value, "__dict__") and not kind.__module__.startswith(("pyspark", "py4j")):
        if any(value is s for s in seen):
            return f"again:{kind.__qualname__}"
        methods = [f for c in kind.__mro__ for f in vars(c).values() if inspect.isfunction(f)]
        seen = (*seen, value)
        return f"object:{kind.__module__}.{kind.__qualname__}:{_describe(methods, seen)}:{_describe(vars(value), seen)}"
    return f"unknown:{uuid.uuid4()}"


def _fingerprint_of(fn: Callable, seen: tuple = ()) -> str:
    if not inspect.isfunction(fn):
        return _describe(fn, seen)
    if any(fn is s for s in seen):
        return f"again:{fn.__qualname__}"
    seen = (*seen, fn)
    try:
        body = inspect.getsource(fn)
    except (OSError, TypeError):
        body = fn.__code__.co_code.hex() + _describe([c for c in fn.__code__.co_consts if isinstance(c, _PLAIN)])
    captured = [_describe(c.cell_contents, seen) for c in fn.__closure__ or ()]
    defaults = _describe([fn.__defaults__, fn.__kwdefaults__], seen)
    local = fn.__module__ and not fn.__module__.startswith("pyspark")
    named = {n: fn.__globals__[n] for n in fn.__code__.co_names if local and n in fn.__globals__}
    named = {n: v for n, v in named.items() if isinstance(v, (*_PLAIN, list, tuple, set, dict)) or inspect.isfunction(v)}
    return f"{fn.__module__}.{fn.__qualname__}:{body}:{captured}:{defaults}:{_describe(named, seen)}"


class _FS:
    """Hadoop FileSystem metadata calls (driver side: exists, list, delete)."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        jvm = spark.sparkContext._jvm
        self._jvm = jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._path = jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self._path.getFileSystem(self._conf)

    def p(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return bool(self.fs.exists(self.p(path)))

    def children(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return [s.getPath().getName() for s in self.fs.listStatus(self.p(path))]

    def delete(self, path: str) -> None:
        if self.exists(path):
            self.fs.delete(self.p(path), True)


class WorkbookRefresher:
    """Materialized, incrementally refreshed table over a workbook directory."""

    def __init__(
        self,
        spark: SparkSession,
        source: str,
        target: str,
        glob: str = "*.xlsx",
        sheet_name=0,
        header: bool = True,
        pre_process: Processor | Sequence[Processor] | None = None,
        post_process: Processor | Sequence[Processor] | None = None,
        fmt: str = "parquet",
        options: dict[str, str] | None = None,
        recursive: bool = False,
        exclude: Sequence[str] = (),
        with_source: bool = False,
        row_wise: bool = False,
    ) -> None:
        if row_wise and fmt != "parquet":
            raise ValueError("row_wise needs the parquet format")
        self.spark = spark
        self.row_wise = row_wise
        self.with_source = with_source
        self.source = source
        self.target = target.rstrip("/")
        self.glob = glob
        self.sheet_name = sheet_name
        self.header = header
        self._pre = _listify(pre_process)
        self._post = _listify(post_process)
        self.fmt = fmt
        self.options = dict(options or {})
        self.read_options, self.write_options = dict(self.options), dict(self.options)
        if fmt == "csv":  # read back with the schema that the manifest keeps
            self.read_options = FS.CSV_READ_OPTIONS | self.options
            self.write_options = FS.CSV_WRITE_OPTIONS | self.options
        self.recursive = recursive
        self.exclude = tuple(exclude)
        self.fs = _FS(spark, self.target)
        self.last_parsed: list[str] = []  # paths parsed by the last refresh ("*" = all)
        self.parsed_count = 0

    # --- processors (F1, F2) --------------------------------------------------------

    def register_pre_process(self, fn: Processor) -> None:
        self._pre.append(fn)

    def register_post_process(self, fn: Processor) -> None:
        self._post.append(fn)

    def pre_process(self, df: DataFrame) -> DataFrame:
        for fn in self._pre:
            df = df.transform(fn)
        return df

    def post_process(self, df: DataFrame) -> DataFrame:
        for fn in self._post:
            df = df.transform(fn)
        return df

    @property
    def scan_fingerprint(self) -> str:
        """Of what decides the cells of a file."""
        return hashlib.sha1(f"cells:{self.sheet_name!r}".encode()).hexdigest()[:16]

    @property
    def fingerprint(self) -> str:
        """Of what decides the table, the files aside."""
        parts = [repr(self.sheet_name), repr(self.header), repr(self.with_source), repr(self.row_wise), self.fmt,
                 repr(sorted(self.options.items()))]
        parts += [_fingerprint_of(f) for f in self._pre]
        return hashlib.sha1("\n".join(parts).encode()).hexdigest()[:16]

    # --- paths -----------------------------------------------------------------------

    def _versions(self) -> list[int]:
        """Complete manifests, oldest first."""
        names = [n for n in self.fs.children(f"{self.target}/manifest") if re.fullmatch(r"v=\d+", n)]
        done = [n for n in names if self.fs.exists(f"{self.target}/manifest/{n}/_SUCCESS")]
        return sorted(int(n[2:]) for n in done)

    @property
    def table_path(self) -> str | None:
        """Where the table of the newest manifest is (row-wise tables are read
        by ``read_cache``); None before the first."""
        versions = self._versions()
        return f"{self.target}/table/v={versions[-1]}" if versions else None

    def manifest(self) -> DataFrame:
        versions = self._versions()
        if not versions:
            return self.spark.createDataFrame([], MANIFEST_SCHEMA)
        return self.spark.read.schema(MANIFEST_SCHEMA).parquet(f"{self.target}/manifest/v={versions[-1]}")

    # --- staleness (K3, K4) ------------------------------------------------------------

    def listing(self) -> DataFrame:
        files = W.list_workbooks(self.spark, self.source, self.glob, self.recursive, self.exclude)
        return files.select(
            "path",
            F.substring(F.sha1(F.col("path")), 1, 16).alias("src"),
            "mtime",
            "length",
            F.lit(self.scan_fingerprint).alias("ops_fingerprint"),
        )

    def stale_files(self) -> DataFrame:
        """Listed files without an identical successful manifest entry: to be parsed."""
        ok = self.manifest().filter(F.col("status") == "ok").select("path", "mtime", "length", "ops_fingerprint")
        return self.listing().join(ok, ["path", "mtime", "length", "ops_fingerprint"], "left_anti")

    def deleted_files(self) -> DataFrame:
        return self.manifest().select("path", "src").join(self.listing().select("path"), "path", "left_anti")

    def is_stale(self) -> bool:
        """No table yet, made in another way, any file new or changed, or any
        file deleted."""
        if self.table_path is None:
            return True
        if self.manifest().filter(~F.col("table_fingerprint").eqNullSafe(self.fingerprint)).limit(1).count():
            return True
        return bool(self.stale_files().limit(1).count() or self.deleted_files().limit(1).count())

    # --- reading ---------------------------------------------------------------------------

    def read_cache(self) -> DataFrame:
        """Materialized table + post-processors (K2)."""
        path = self.table_path
        if path is None:
            raise FileNotFoundError(f"no materialized table below {self.target}")
        if not self.fs.exists(path):
            rows = self._live("parts", self.manifest().withColumnRenamed("src", SRC), "part")
            if rows is None:  # a refresh without any usable input
                rows = self.spark.createDataFrame([], f"{SRC} string")
            return self.post_process(rows.drop(SRC))
        reader = self.spark.read.format(self.fmt).options(**self.read_options)
        if self.fmt == "csv" and (kept := self.manifest().select("table_columns").first()):
            reader = reader.schema(T.StructType.fromJson(json.loads(kept[0])))
        return self.post_process(reader.load(path))

    def _from_sources(self) -> DataFrame:
        cells = W.scan_workbooks(self.spark, self.source, self.sheet_name, self.glob, self.recursive, self.exclude)
        return self.pre_process(W.to_table(cells, header=self.header, with_source=self.with_source))

    # --- writing ----------------------------------------------------------------------------

    def _files(self, stale: DataFrame, every: bool) -> DataFrame:
        """Contents of the stale files.  Spark's reader takes their names as a
        list; when every file is stale the directory is read as such."""
        self.last_parsed = ["*"] if every else [r["path"] for r in stale.select("path").collect()]
        if every:
            return W._exclude(W._reader(self.spark, self.glob, self.recursive).load(self.source), self.exclude)
        return self.spark.read.format("binaryFile").load(self.last_parsed)

    def _refuse(self, bad: DataFrame, what: str) -> None:
        some = [f"{r['path']}: {r['error']}" for r in bad.select("path", "error").limit(5).collect()]
        if some:
            raise RuntimeError(f"{what}: {'; '.join(some)}{' ...' if len(some) == 5 else ''}")

    def _live(self, kind: str, entries: DataFrame, generation: str = "generation") -> DataFrame | None:
        """Rows of the files of a manifest, from the generations it names."""
        generations = [r[0] for r in entries.where(f"{generation} is not null").select(generation).distinct().collect()]
        if not generations:
            return None
        tables = [
            self.spark.read.parquet(f"{self.target}/{kind}/g={g}").withColumn("g", F.lit(g)) for g in sorted(generations)
        ]
        rows = functools.reduce(DataFrame.unionByName, tables)
        src = SRC if SRC in entries.columns else "src"
        # A short row a file, which the driver's listing holds too: no shuffle of the cells.
        live = F.broadcast(entries.select(src, F.col(generation).alias("g")))
        return rows.join(live, [src, "g"], "left_semi").drop("g")

    def _live_cells(self, entries: DataFrame) -> DataFrame | None:
        cells = self._live("cells", entries)
        return None if cells is None else cells.filter(F.col("_row") >= 0)

    @property
    def _states(self) -> str:
        return f"states-{int(self.header)}"

    def _write_cells(self, cells: DataFrame, version: int) -> DataFrame:
        for name in ("states-0", "states-1"):  # of a refresh that was not committed
            self.fs.delete(f"{self.target}/{name}/g={version}")
        path = f"{self.target}/cells/g={version}"
        cells.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def _live_states(self, entries: DataFrame) -> DataFrame | None:
        """States of the files, made first for the generations without any."""
        for g in [r[0] for r in entries.where("generation is not null").select("generation").distinct().collect()]:
            path = f"{self.target}/{self._states}/g={g}"
            if not self.fs.exists(f"{path}/_SUCCESS"):
                cells = self.spark.read.parquet(f"{self.target}/cells/g={g}").filter(F.col("_row") >= 0)
                W.file_states(cells, self.header).write.mode("overwrite").parquet(path)
        return self._live(self._states, entries)

    def _write_parts(self, entries: DataFrame, fingerprint: str, version: int) -> DataFrame:
        """Make the rows of the files that have none of this table yet; the
        manifest entries with the generation of each file's rows."""
        states = self._live_states(entries)
        if states is None:
            return entries
        layouts, columns = W.collected_columns(states, self.header)
        made_of = hashlib.sha1(repr(columns).encode()).hexdigest()[:16]
        same = F.col("table_fingerprint").eqNullSafe(fingerprint) & F.col("table_columns").eqNullSafe(made_of)
        kept = entries.withColumn("part", F.when(same, F.col("part")))
        if kept.select("part").distinct().count() > MAX_GENERATIONS:
            kept = entries.withColumn("part", F.lit(None).cast("int"))
        todo = kept.filter("part is null")
        cells = self._live_cells(todo)
        if cells is not None and columns:
            src = [SRC, *(["path", "sheet_pos", "sheet", "_row"] if self.with_source else [])]
            rows = self.pre_process(W.to_table_of(cells.withColumnRenamed("src", SRC), layouts, columns, self.header, src))
            if SRC not in rows.columns:
                raise ValueError(f"a row-wise processor must keep the column {SRC}")
            rows.write.mode("overwrite").parquet(f"{self.target}/parts/g={version}")
            kept = kept.withColumn("part", F.coalesce("part", F.lit(version)))
        return kept.withColumn("table_columns", F.lit(made_of))

    def _rebuild(self, errors: str, every: bool = False) -> DataFrame:
        """Parse what is stale (or every file), write cells, table, manifest."""
        key = ["path", "mtime", "length", "ops_fingerprint"]
        listing = materialize(self.listing(), "refresh-listing")
        before = self.manifest().filter(F.col("status") == "ok")
        stale = listing if every else listing.join(before.select(*key), key, "left_anti")
        fresh = before.join(listing.select(*key), key, "left_semi") if not every else before.limit(0)
        self.parsed_count, self.last_parsed = stale.count(), []
        version, fingerprint = (self._versions() or [0])[-1] + 1, self.fingerprint
        columns = [f.split()[0] for f in MANIFEST_SCHEMA.split(", ")]
        entries = fresh.select(*columns)
        if self.parsed_count:
            files = self._files(stale, self.parsed_count == listing.count())
            src = F.substring(F.sha1(F.col("path")), 1, 16)
            # Straight into the new generation: nothing refers to it before the commit.
            staged = self._write_cells(W.scan_files(files, self.sheet_name, errors).withColumn("src", src), version)
            parsed = stale.select(
                "path", "src", "mtime", "length", "ops_fingerprint", F.lit("ok").alias("status"),
                F.lit(None).cast("string").alias("error"), F.lit(version).alias("generation"),
            )
            if errors != "raise":
                bad = staged.filter(F.col("_row") == -1).select("path", "error")
                self._refuse(bad.join(before, "path", "left_anti"), "unreadable workbooks without previous data")
                parsed = parsed.join(bad, "path", "left_anti")
                entries = entries.unionByName(before.join(bad.select("path"), "path", "left_semi").select(*columns))
            entries = entries.unionByName(parsed, allowMissingColumns=True)
        entries = materialize(entries, "refresh-manifest")
        cells = self._live_cells(entries)
        if cells is not None and entries.select("generation").distinct().count() > MAX_GENERATIONS:
            self._write_cells(materialize(cells, "refresh-merge"), version)
            entries = entries.withColumn("generation", F.lit(version))
            cells = self._live_cells(entries)
        if self.row_wise:
            entries = self._write_parts(entries, fingerprint, version)
        else:
            schema = None
            if cells is not None:
                table = self.pre_process(W.to_table(cells, header=self.header, with_source=self.with_source))
                schema = table.schema.json() if self.fmt == "csv" else None  # a format without types
                if table.columns:
                    writer = table.write.mode("overwrite").format(self.fmt).options(**self.write_options)
                    writer.save(f"{self.target}/table/v={version}")
            kept = {"part": F.lit(None).cast("int"), "table_columns": F.lit(schema).cast("string")}
            entries = entries.withColumns(kept)
        entries = entries.withColumn("table_fingerprint", F.lit(fingerprint)).select(*columns)
        entries.write.mode("overwrite").parquet(f"{self.target}/manifest/v={version}")  # the commit
        self._sweep(version)
        return self.read_cache()

    def _sweep(self, version: int) -> None:
        """Drop what the two newest manifests do not need."""
        for kind in ("manifest", "table"):
            for name in self.fs.children(f"{self.target}/{kind}"):
                if re.fullmatch(r"v=\d+", name) and int(name[2:]) < version - 1:
                    self.fs.delete(f"{self.target}/{kind}/{name}")
        newest = [v for v in self._versions() if v >= version - 1]
        held = self.spark.read.schema(MANIFEST_SCHEMA).parquet(*[f"{self.target}/manifest/v={v}" for v in newest])
        used = held.select("generation", "part").distinct().collect()
        cells, parts = {r["generation"] for r in used}, {r["part"] for r in used}
        for kind, generations in (("cells", cells), ("states-0", cells), ("states-1", cells), ("parts", parts)):
            for name in self.fs.children(f"{self.target}/{kind}"):
                if re.fullmatch(r"g=\d+", name) and int(name[2:]) not in generations:
                    self.fs.delete(f"{self.target}/{kind}/{name}")

    # --- policies (K5-K10, F3) ---------------------------------------------------------------

    def refresh(self, policy: str | Callable[[WorkbookRefresher], DataFrame] = "check") -> DataFrame:
        if callable(policy):
            return policy(self)
        if policy == "only_cached":
            self.last_parsed, self.parsed_count = [], 0
            return self.read_cache()
        if policy == "skip":
            self.last_parsed = []
            return self.post_process(self._from_sources())
        if policy == "force":
            return self._rebuild("raise", every=True)
        if policy in ("check", "fallback"):
            if not self.is_stale():
                self.last_parsed, self.parsed_count = [], 0
                return self.read_cache()
            return self._rebuild("raise" if policy == "check" else "reject")
        raise ValueError(f"unknown policy {policy!r}; one of {POLICIES} or a callable")
