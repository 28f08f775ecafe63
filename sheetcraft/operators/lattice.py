"""Types of text columns without loss.

A column's state counts, for each kind of value, how many texts print back as
they are, and keeps the digits they need.  States of parts of a column (files,
partitions, days) join by sums and maxima, so they can be kept and merged; a
state that nothing has been added to is the neutral one.

A text column becomes a number only if every value, printed, gives the text
back: ``01234``, ``+5``, ``1.50`` and ``1e3`` are texts; 9223372036854775808
keeps all its digits as a decimal.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import astuple, dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetcraft.functions.names import by_position, with_headers

DIGITS = 38  # of a decimal
WHOLE = r"^(0|-?[1-9][0-9]*)$"


@dataclass(frozen=True)
class TextState:
    """What has been seen of a text column."""

    values: int = 0
    longs: int = 0  # texts that a bigint prints
    wholes: int = 0  # whole numbers without leading zeros, of any size
    doubles: int = 0  # texts that a double prints
    booleans: int = 0  # true and false
    zeros: int = 0  # whole numbers with leading zeros
    digits: int = 0  # of the longest whole number

    def joined(self, other: TextState) -> TextState:
        """The state of both parts together: associative, commutative."""
        sums = [a + b for a, b in zip(astuple(self), astuple(other))]
        return TextState(*sums[:-1], max(self.digits, other.digits))

    def type(self) -> str:
        """The type that keeps every value; text if there is no other."""
        if not self.values:
            return "string"
        if self.longs == self.values:
            return "bigint"
        if self.wholes == self.values and self.digits <= DIGITS:
            return f"decimal({self.digits},0)"
        if self.doubles == self.values:
            return "double"
        if self.booleans == self.values:
            return "boolean"
        return "string"


def state_columns(text: Column) -> dict[str, Column]:
    """Aggregates that make up the state of a text column, by field."""
    whole = text.rlike(WHOLE)
    return {
        "values": F.count(text),
        "longs": F.count_if(text.try_cast("bigint").cast("string") == text),
        "wholes": F.count_if(whole),
        "doubles": F.count_if(text.try_cast("double").cast("string") == text),
        "booleans": F.count_if(text.isin("true", "false")),
        "zeros": F.count_if(text.rlike("^-?0[0-9]+$")),
        "digits": F.coalesce(F.max(F.when(whole, F.length(F.ltrim(text, F.lit("-"))))), F.lit(0)),
    }


def text_states(df: DataFrame, places: Sequence[int] | None = None) -> dict[int, TextState]:
    """The state of each text column (or of those at the given places), from
    one aggregate; one row reaches the driver."""
    own, _ = by_position(df)
    kinds = dict(own.dtypes)
    places = [i for i in range(len(own.columns)) if kinds[f"c{i}"] == "string"] if places is None else list(places)
    if not places:
        return {}
    names = [f.name for f in fields(TextState)]
    row = own.agg(*[c.alias(f"{n}{i}") for i in places for n, c in state_columns(F.col(f"c{i}")).items()]).first()
    return {i: TextState(*[row[f"{n}{i}"] for n in names]) for i in places}


def with_types(df: DataFrame, types: dict[int, str]) -> DataFrame:
    """The table with the text columns at the given places cast."""
    own, headers = by_position(df)
    cast = {i: t for i, t in types.items() if t != "string"}
    return with_headers(own.select(*[F.col(f"c{i}").cast(cast[i]) if i in cast else F.col(f"c{i}") for i in range(len(headers))]), headers)
