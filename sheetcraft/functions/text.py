"""String Column builders: white-space strip, case-insensitive contains,
upper-cased prefix compare, null-as-false."""

from __future__ import annotations

import re
import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Python's str.strip() removes every code point for which str.isspace() holds;
# SQL trim() without a set removes blanks only.  The set, built from that rule:
WHITESPACE = "".join(chr(i) for i in range(sys.maxunicode + 1) if chr(i).isspace())


def strip_ws(c: ColumnOrName) -> Column:
    """Strip leading and trailing white space, as Python's ``str.strip``
    (``trim`` with an explicit character set: a code-point scan, no regex)."""
    return F.trim(_col(c), F.lit(WHITESPACE))


def or_false(c: Column) -> Column:
    """Null -> false (the reference's ``fillna(False)`` on masks)."""
    return F.coalesce(c, F.lit(False))


def icontains(c: ColumnOrName, needle: str) -> Column:
    """Case-insensitive literal substring test; null stays null."""
    return F.upper(_col(c)).contains(needle.upper())


def prefix_upper_eq(c: ColumnOrName, prefix: str) -> Column:
    """``upper(first len(prefix) characters) == prefix``; null stays null."""
    return F.upper(F.substring(_col(c), 1, len(prefix))) == prefix.upper()


def xor(a: Column, b: Column) -> Column:
    """Exclusive or of two non-null booleans."""
    return a != b


def snake(name: str) -> str:
    """Display name -> snake_case identifier (``Head Start (OPK)`` -> ``head_start_opk``)."""
    out = re.sub(r"[^0-9a-zA-Z]+", "_", name).strip("_").lower()
    return out
