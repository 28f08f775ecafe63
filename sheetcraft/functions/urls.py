"""URL Column builders: absolute-URL test and relative-path join.

Semantics follow Python's ``urllib.parse.urlsplit`` + ``PurePosixPath``:
the joined path is normalised (empty and ``.`` segments dropped, ``..`` kept,
trailing ``/`` dropped), an absolute operand replaces the base path, and the
query and fragment of the base are kept.
"""

from __future__ import annotations

from urllib.parse import urlsplit

from pyspark.sql import Column
from pyspark.sql import functions as F

# Generic URI split (scheme, authority, path, query, fragment).
_SPLIT = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(\?[^#]*)?(#.*)?$"
_ABSOLUTE = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]+"


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def is_absolute_url(c: Column | str) -> Column:
    """True when the URL has both a scheme and a non-empty host part."""
    return F.regexp_like(_col(c), F.lit(_ABSOLUTE))


def url_parts(c: Column | str) -> dict[str, Column]:
    col = _col(c)
    return {
        "scheme": F.regexp_extract(col, _SPLIT, 1),
        "netloc": F.regexp_extract(col, _SPLIT, 2),
        "path": F.regexp_extract(col, _SPLIT, 3),
        "query": F.regexp_extract(col, _SPLIT, 4),
        "fragment": F.regexp_extract(col, _SPLIT, 5),
    }


def _segments(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda s: (s != "") & (s != "."))


def _check_relative(rel: str) -> None:
    sp = urlsplit(rel)
    if sp.scheme or sp.netloc or sp.query or sp.fragment:
        raise ValueError(f"Can only join a purely relative path but got {sp}")


def join_url_path(c: Column | str, rel: str, on_error: str = "raise") -> Column:
    """``URL(c) / rel``.  ``rel`` is validated on the driver (a parameter).

    A base that is not an absolute URL raises (``on_error="raise"``) or gives
    null (``"null"``).
    """
    _check_relative(rel)
    p = url_parts(c)
    base_path = p["path"]
    if rel.startswith("/"):
        # PurePosixPath('/x') / '/b' == '/b'
        joined = F.lit(rel)
        head = F.lit(rel)
    else:
        joined = F.concat(base_path, F.lit("/" + rel))
        head = base_path
    segs = F.array_join(_segments(joined), "/")
    # PurePosixPath keeps exactly two leading slashes of the left operand, and
    # collapses one or three and more to one.
    lead = (
        F.when(head.startswith("//") & ~head.startswith("///"), F.lit("//"))
        .when(head.startswith("/"), F.lit("/"))
        .otherwise(F.lit(""))
    )
    norm = F.concat(lead, segs)
    # An empty relative result is '.' for PurePosixPath.
    norm = F.when(norm == "", F.lit(".")).otherwise(norm)
    # urlunsplit puts '/' in front of a path that lacks one when a host exists.
    path_out = F.when(~norm.startswith("/"), F.concat(F.lit("/"), norm)).otherwise(norm)
    url = F.concat(p["scheme"], F.lit("://"), p["netloc"], path_out, p["query"], p["fragment"])
    ok = is_absolute_url(c)
    if on_error == "null":
        return F.when(ok, url)
    return F.when(ok, url).otherwise(
        F.raise_error(F.concat(F.lit("not an absolute URL: "), F.coalesce(_col(c), F.lit("NULL"))))
    )


def url_text(c: Column | str, on_error: str = "raise") -> Column:
    """Text form of an absolute URL as ``urlunsplit(urlsplit(url))`` gives it:
    the scheme lower-cased, an empty query or fragment marker dropped.  A URL
    without scheme or host raises (``on_error="raise"``) or gives null."""
    p = url_parts(c)
    q, frag = p["query"], p["fragment"]
    text = F.concat(
        F.lower(p["scheme"]),
        F.lit("://"),
        p["netloc"],
        p["path"],
        F.when(q == "?", F.lit("")).otherwise(q),
        F.when(frag == "#", F.lit("")).otherwise(frag),
    )
    ok = is_absolute_url(c)
    if on_error == "null":
        return F.when(ok, text)
    return F.when(ok, text).otherwise(
        F.raise_error(F.concat(F.lit("could not be interpreted as an absolute URL: "), F.coalesce(_col(c), F.lit("NULL"))))
    )
