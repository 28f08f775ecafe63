"""JSON Column builders: the notes ``Filters`` parse and nested lookup with a
default for absent keys."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILTERS_SCHEMA = "struct<Filters:array<string>>"
_END = "end of the text 5f3a"
_NUMBERS = r'(?:NaN|-?Infinity)(?=(?:[^"\\]|"(?:[^"\\]|\\.)*")*$)'


def accept_repeated_keys(spark: SparkSession) -> None:
    """Of a key that an object holds twice the last value counts, as for
    ``json.loads``; without this such a text does not parse."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def _plain(text: Column) -> Column:
    """JSON text with null in place of NaN and infinities outside strings."""
    odd = text.contains("NaN") | text.contains("Infinity")
    return F.when(odd, F.regexp_replace(text, _NUMBERS, "null")).otherwise(text)


def parse_ended(text: Column) -> Column:
    """A text parsed as the first of two elements of a list: the parser does
    not look at what follows a value, so the second must come out again."""
    return F.try_parse_json(F.concat(F.lit("["), _plain(text), F.lit(f',"{_END}"]')))


def _whole(both: Column) -> Column:
    return (F.try_variant_get(both, "$[1]", "string") == _END) & F.try_variant_get(both, "$[2]", "variant").isNull()


def parse_whole(text: Column) -> Column:
    """A text as VARIANT if all of it is one JSON value, else null."""
    both = parse_ended(text)
    return F.when(_whole(both), F.try_variant_get(both, "$[0]", "variant"))


def filters_ended(both: Column) -> Column:
    """``filter_values`` of a text from its ``parse_ended``.  With that in a
    column of its own a text is parsed once, however often it is looked at."""
    values = F.try_variant_get(both, "$[0].Filters", "array<variant>")
    return F.when(_whole(both) & (F.size(values) > 0), values)


def filter_values(c: Column | str) -> Column:
    """``{"Filters": [...]}`` with a non-empty list -> its elements, each a
    VARIANT that keeps its kind; anything else (bad JSON, text after it, not an
    object, no or empty ``Filters``, ``Filters`` not a list) -> null."""
    return filters_ended(parse_ended(F.col(c) if isinstance(c, str) else c))


def parse_filters(c: Column | str) -> Column:
    """As ``filter_values``, with the JSON text of each element (a text element
    as it is).  Runs JVM-side; ``parse_filters_strict`` uses ``json.loads``."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(filter_values(col).isNotNull(), F.from_json(_plain(col), FILTERS_SCHEMA).getField("Filters"))


def _loaded(text: str | None) -> list | None:
    """The elements of ``Filters`` by ``json.loads``; NaN and infinities are null."""
    import json
    from collections.abc import Mapping

    if text is None:
        return None
    try:
        data = json.loads(text, parse_constant=lambda _: None)
    except (ValueError, RecursionError):
        return None
    found = data.get("Filters") if isinstance(data, Mapping) else None
    return found if isinstance(found, list) and found else None


def _dumped(value) -> str | None:
    import json

    return None if value is None else json.dumps(value, separators=(",", ":"))


@F.pandas_udf(T.ArrayType(T.StringType()))
def parse_filters_strict(s: pd.Series) -> pd.Series:
    """Arrow-batched exact ``json.loads`` variant of :func:`parse_filters`."""

    def one(text):
        found = _loaded(text)
        return None if found is None else [e if isinstance(e, str) else _dumped(e) for e in found]

    return s.map(one)


@F.pandas_udf(T.ArrayType(T.StringType()))
def filter_texts_strict(s: pd.Series) -> pd.Series:
    """As :func:`parse_filters_strict`, text elements as JSON strings too."""

    def one(text):
        found = _loaded(text)
        return None if found is None else ["null" if e is None else _dumped(e) for e in found]

    return s.map(one)


def path_segment(key) -> str:
    """One variant-path segment for an object key.  The path syntax has no
    escapes: a key with a double quote is single-quoted; a key with both kinds
    of quote cannot be addressed."""
    text = str(key)
    if '"' not in text:
        return f'["{text}"]'
    if "'" not in text:
        return f"['{text}']"
    raise ValueError(f"key {text!r} contains both quote characters")


def _path(keys: Iterable) -> str:
    return "$" + "".join(path_segment(k) for k in keys)


def json_path(c: Column | str, keys: Iterable, default=None, as_type: str = "string") -> Column:
    """Nested lookup by a key chain.

    Returns ``default`` when a key is absent or a parent is not an object;
    a present JSON null stays null.  ``c`` is JSON text (invalid text counts
    as "not an object") or a VARIANT column.
    """
    col = F.col(c) if isinstance(c, str) else c
    return json_path_variant(F.try_parse_json(col), keys, default, as_type)


def json_path_variant(v: Column, keys: Iterable, default=None, as_type: str = "string") -> Column:
    """As :func:`json_path` on an already parsed VARIANT column."""
    path = _path(keys)
    located = F.try_variant_get(v, path, "variant")
    value = F.try_variant_get(v, path, as_type)
    dflt = F.lit(default).cast(as_type) if default is not None else F.lit(None).cast(as_type)
    return F.when(located.isNull(), dflt).otherwise(value)
