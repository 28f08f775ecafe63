"""Parquet / CSV sources and sinks, and materialization into the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sheetcraft.session import scratch_dir

# Text the public pandas readers turn into null by default.
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
               "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


# One set of options for both directions: a field may hold line breaks, quotes
# and outer blanks; an empty text is written quoted and a null is not.  Files
# with line breaks in fields cannot be split, so the writer bounds their rows.
CSV_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
}
# What an unquoted empty field reads as; a text never holds it.
CSV_READ_OPTIONS = CSV_OPTIONS | {"nullValue": "\0", "emptyValue": ""}
CSV_WRITE_OPTIONS = CSV_OPTIONS | {"nullValue": "", "emptyValue": '""', "maxRecordsPerFile": "1000000"}


def read_csv(
    spark: SparkSession,
    path: str,
    infer_schema: bool = True,
    null_tokens: bool = True,
    schema: StructType | str | None = None,
) -> DataFrame:
    """Header row, inferred types or ``schema``; with ``null_tokens`` the pandas
    null texts become null (one extra projection, no extra pass)."""
    reader = spark.read.options(**CSV_READ_OPTIONS)
    df = (reader.schema(schema) if schema is not None else reader.option("inferSchema", infer_schema)).csv(path)
    if not null_tokens:
        return df
    cols = []
    for c, t in df.dtypes:
        col = F.col(f"`{c}`")
        cols.append(F.when(~col.isin(*NULL_TOKENS), col).alias(c) if t == "string" else col)
    return df.select(*cols)


def with_row_index(df: DataFrame, order_by: list[str], name: str = "index") -> DataFrame:
    """A 0-based row index in ``order_by`` order: the whole table is one group
    for ``number_rows``, which spreads it over range partitions."""
    from sheetcraft.operators.numbering import number_rows

    one = df.withColumn("__all", F.lit(0))
    out = number_rows(one, ["__all"], order_by, "__n")
    return out.withColumn(name, F.col("__n") - 1).drop("__all", "__n")


def write_csv(df: DataFrame, path: str, index: bool = False, order_by: list[str] | None = None) -> None:
    """CSV that ``read_csv`` reads back as it was; ``index=True`` adds a leading
    0-based ``index`` column in ``order_by`` order (computed without a global
    single-partition window).  Booleans print ``true``/``false``."""
    out = df
    if index:
        if not order_by:
            raise ValueError("index=True needs order_by (a Spark table has no row order)")
        out = with_row_index(df, order_by)
        out = out.select("index", *[F.col(f"`{c}`") for c in df.columns])
    out.write.mode("overwrite").options(**CSV_WRITE_OPTIONS).csv(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into a fresh folder of the shared folder and
    read it back: later jobs read the table instead of recomputing it, and
    the lineage is cut (survives executor loss)."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
