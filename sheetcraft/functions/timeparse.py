"""Action-time parsing: text ``%m/%d/%Y %I:%M %p`` -> TIMESTAMP_NTZ."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the export's time layout (strftime %m/%d/%Y %I:%M %p) in
# Spark's datetime pattern language.  One-digit month/day/hour and lower-case
# am/pm are accepted; a two-digit year, month 13 and hour 13 are rejected.
ACTION_TIME_FORMAT = "M/d/yyyy h:mm a"
# Layout used when writing such text (two-digit month/day/hour, as exported).
ACTION_TIME_WRITE_FORMAT = "MM/dd/yyyy hh:mm a"


def parse_action_time(c: Column | str, on_error: str = "raise", fmt: str = ACTION_TIME_FORMAT) -> Column:
    """Parse text to TIMESTAMP_NTZ.

    ``on_error="raise"`` fails the job on the first malformed value (the
    reference's behaviour); ``"null"`` turns it into null.
    """
    col = F.col(c) if isinstance(c, str) else c
    if on_error == "null":
        return F.try_to_timestamp(col, F.lit(fmt)).cast("timestamp_ntz")
    if on_error != "raise":
        raise ValueError(f"on_error must be 'raise' or 'null', got {on_error!r}")
    return F.to_timestamp_ntz(col, F.lit(fmt))


def format_action_time(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.date_format(col, ACTION_TIME_WRITE_FORMAT)
