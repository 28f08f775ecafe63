"""Program action logs: rename two columns and keep the seven output columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Renames and output columns of the program action-log export.
RENAMES = {"WLS ID": "Program ID", "Date of Action": "Action Date"}
OUT_COLUMNS = [
    "Program ID",
    "Recorded By",
    "Recorded Date",
    "Action Date",
    "Action Log Name",
    "Action Log Type",
    "Notes",
]


def rename_program_action_log(df: DataFrame) -> DataFrame:
    """Rename then project; extra input columns are pruned (and never read
    from a columnar source, since the projection reaches the scan)."""
    return df.withColumnsRenamed(RENAMES).select(*[F.col(f"`{c}`") for c in OUT_COLUMNS])
