"""Columns by position: header texts that are no column names.

A header cell may hold dots, back-ticks, the text of another header, or the
same in other case; Spark resolves names by none of these.  So operators work
on columns ``c0, c1, ...`` in the order of the table, found by their place, and
a ``ColumnDictionary`` keeps the header text of each.  Header texts are matched
exactly, letter case included, within and across tables.  Only at the end do
columns get names again: the header text, or for a text that differs from an
earlier one in case alone (Parquet and Spark take them for one) the text with a
suffix.  The header text itself stays in the field's metadata.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEADER = "header"


def quoted(name: str) -> Column:
    """The column of exactly this name."""
    return F.col("`" + name.replace("`", "``") + "`")


def stored_names(headers: Sequence[str]) -> list[str]:
    """A column name for each header text: the text, with ``_2``, ``_3``, ...
    where a text before it is the same but for case."""
    exact = {h.lower() for h in headers}
    taken: set[str] = set()
    out = []
    for header in headers:
        name, k = header, 2
        while name.lower() in taken or (name != header and name.lower() in exact):
            name, k = f"{header}_{k}", k + 1
        taken.add(name.lower())
        out.append(name)
    return out


class ColumnDictionary:
    """Header texts in order, each once, and the physical column of each."""

    def __init__(self, headers: Iterable[str] = ()):
        self.headers: list[str] = []
        self._place: dict[str, int] = {}
        for header in headers:
            self.add(header)

    def add(self, header: str) -> int:
        """The place of a header text, which is new or known."""
        if header not in self._place:
            self._place[header] = len(self.headers)
            self.headers.append(header)
        return self._place[header]

    def __len__(self) -> int:
        return len(self.headers)

    def __contains__(self, header: str) -> bool:
        return header in self._place

    def column(self, header: str) -> Column:
        return F.col(f"c{self._place[header]}")

    def named(self, df: DataFrame) -> DataFrame:
        """A table of the columns ``c0 ...`` under its final names."""
        return with_headers(df, self.headers)


def headers_of(df: DataFrame) -> list[str]:
    """The header text of each column: from its metadata, else its name."""
    return [f.metadata.get(HEADER, f.name) for f in df.schema.fields]


def by_position(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """The table with columns ``c0, c1, ...``, and their header texts."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]), headers_of(df)


def with_headers(df: DataFrame, headers: Sequence[str]) -> DataFrame:
    """The columns, in order, under names for the given header texts."""
    physical, _ = by_position(df)
    named = zip(headers, stored_names(headers))
    return physical.select(*[F.col(f"c{i}").alias(n, metadata={HEADER: h}) for i, (h, n) in enumerate(named)])


def fields_by_position(c: Column, kind: T.StructType) -> Column:
    """A struct column with its fields renamed ``f0, f1, ...``."""
    return c.cast(T.StructType([T.StructField(f"f{i}", f.dataType, True) for i, f in enumerate(kind.fields)]))


def any_present(columns: Sequence[Column]) -> Column:
    """Whether any of the columns has a value."""
    out = F.lit(False)
    for c in columns:
        out = out | c.isNotNull()
    return out
