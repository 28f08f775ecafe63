"""Exact numbering within groups, with one plan for every group size.

Rows are range-partitioned and sorted by (keys, order, tie breaker) and written,
a file a partition, so a group of any size, null keys included, lies in as many
consecutive files as its rows fill, and copies of a row may lie in several.  A
row's place in its file (``_metadata.row_index``) less that of the first row of
its key there, plus the rows of the key in earlier files, is its number: the rows
are shuffled and sorted once, and joined to a row a key and file, which AQE
broadcasts only where it is small.  The numbers equal those of ``row_number() over
(partition by keys order by order)``; no task sees more of a key than one file holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheetcraft.session import scratch_dir

KEY, ORDER, TIE, COPY, PART, PLACE = "__key", "__order", "__tie", "__copy", "__part", "__place"
HELPERS = (KEY, ORDER, TIE, COPY, PART, PLACE)


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _struct(columns: Sequence[str]) -> Column:
    """Columns as one value: compares by column, nulls first and equal."""
    return F.struct(*[_q(c).alias(f"c{i}") for i, c in enumerate(columns)])


def in_order(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df``, written in range partitions of (keys, order): adds the key and
    order structs, two tie breakers (a hash of the row, and a number that
    tells copies apart), the partition number, increasing in that order, and the
    row's place among the rows of its partition."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plain = [c for c, t in df.dtypes if t != "variant" and not t.startswith("map<")]
    ranged = df.withColumns(
        {
            KEY: _struct(keys),
            ORDER: _struct(order),
            TIE: F.xxhash64(*[_q(c) for c in plain]),
            COPY: F.monotonically_increasing_id(),
        }
    ).repartitionByRange(partitions, KEY, ORDER, TIE, COPY).sortWithinPartitions(KEY, ORDER, TIE, COPY)
    path = scratch_dir(df.sparkSession, "in-order")
    # one file a partition, whatever the session's limit of rows a file
    ranged.withColumn(PART, F.spark_partition_id()).write.option("maxRecordsPerFile", 0).parquet(path, mode="overwrite")
    return df.sparkSession.read.parquet(path).select("*", F.col("_metadata.row_index").alias(PLACE))


def within_part() -> Window:
    """A key's rows of one partition, in order."""
    return Window.partitionBy(PART, KEY).orderBy(PLACE)


def earlier_parts() -> Window:
    """The partitions of a key before the current one."""
    return Window.partitionBy(KEY).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """Add ``out`` (bigint, from 1) numbering rows within ``keys`` by ``order``
    ascending, nulls first; null keys are values like any other.  Rows equal
    in ``order`` are numbered in the order of a hash of all their columns.
    Writes one table to the shared folder."""
    rows = in_order(df, keys, order)
    counts = rows.groupBy(PART, KEY).agg(F.count(F.lit(1)).alias("__n"), F.min(PLACE).alias("__first"))
    before = F.coalesce(F.sum("__n").over(earlier_parts()), F.lit(0))
    starts = counts.select(PART, KEY, (before - F.col("__first") + 1).alias("__start"))
    return rows.join(starts, [PART, KEY]).select(
        *[_q(c) for c in df.columns if c != out], (F.col("__start") + F.col(PLACE)).cast("bigint").alias(out)
    )
