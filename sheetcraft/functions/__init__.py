"""Column builders (pure expressions, JVM-side)."""

from sheetcraft.functions.jsonpath import json_path, json_path_variant, parse_filters, parse_filters_strict
from sheetcraft.functions.regions import REGIONS, counties, regions
from sheetcraft.functions.text import icontains, or_false, prefix_upper_eq, snake, strip_ws, xor
from sheetcraft.functions.timeparse import ACTION_TIME_FORMAT, format_action_time, parse_action_time
from sheetcraft.functions.urls import is_absolute_url, join_url_path, url_parts, url_text

__all__ = [
    "ACTION_TIME_FORMAT",
    "REGIONS",
    "counties",
    "format_action_time",
    "icontains",
    "is_absolute_url",
    "join_url_path",
    "json_path",
    "json_path_variant",
    "or_false",
    "parse_action_time",
    "parse_filters",
    "parse_filters_strict",
    "prefix_upper_eq",
    "regions",
    "snake",
    "strip_ws",
    "url_parts",
    "url_text",
    "xor",
]
