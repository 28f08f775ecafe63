"""The leaves of a JSON column as a trie of (path, kind).

A level of the trie unfolds the objects of the level before with
``variant_explode``: one row a key, which an aggregate with map-side combine
merges to one row a path, with the merged kind of its values.  Keys are compared
as they are, so ``a`` and ``A`` are two paths.  Only paths below which objects
stand are unfolded further; what reaches the driver is a row a path.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True, order=True)
class Leaf:
    """A path of keys and the type its values have in common: text for values
    of different kinds, for objects beside other values, and where there are
    only JSON nulls."""

    path: tuple[str, ...]
    kind: str


def is_object(v):
    return F.schema_of_variant(v).startswith("OBJECT")


def json_leaves(values: DataFrame, column: str) -> list[Leaf]:
    """The leaves of the objects in a VARIANT column, in the order of their
    paths.  Lists are leaves; values that are no objects are left out."""
    spark = values.sparkSession
    names = T.ArrayType(T.StringType())
    v = F.col(f"`{column}`")
    level = values.select(F.array().cast(names).alias("path"), v.alias("v")).where(is_object(v))
    found: list[Leaf] = []
    while True:
        below = level.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select(
            F.concat("path", F.array("key")).alias("path"), F.col("value").alias("v"), is_object(F.col("value")).alias("object")
        )
        other = F.when(~F.col("object"), F.col("v"))
        rows = (
            below.groupBy("path")
            .agg(
                F.count_if("object").alias("objects"),
                F.count_if(~F.col("object") & ~F.is_variant_null("v")).alias("values"),
                F.schema_of_variant_agg(other).alias("kind"),
            )
            .collect()
        )
        deeper = []
        for r in rows:
            if r["objects"] and not r["values"]:
                deeper.append(r["path"])
            else:
                mixed = r["objects"] or not r["values"] or "VARIANT" in r["kind"] or "OBJECT" in r["kind"]
                found.append(Leaf(tuple(r["path"]), _kind(r["kind"], bool(mixed))))
        if not deeper:
            return sorted(found)
        wanted = F.col("path").isin([F.array(*map(F.lit, p)) for p in deeper])
        level = below.where(wanted & F.col("object")).select("path", "v")


def _kind(kind: str, mixed: bool) -> str:
    if not mixed:
        return kind.lower()
    # Lists keep their type where one can be named.
    return kind.lower().replace("object<", "struct<") if kind.startswith("ARRAY") and "VARIANT" not in kind else "string"
