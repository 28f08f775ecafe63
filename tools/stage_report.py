"""Per-stage task balance from Spark's event log (no UI).

Runs a callable with event logging into a fresh scratch folder, then reads
the log: for each stage, the number of tasks, the largest and median shuffle
records read per task, and the largest task's share of the stage's records.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def session_with_event_log(master: str = "local[8]", shuffle_partitions: int = 32, coalesce: bool = False):
    """A local diagnostic session logging events into a fresh folder; with
    ``coalesce=False`` AQE keeps every shuffle partition, so per-task balance
    is visible even on small data."""
    from sheetcraft.session import build_session

    log_dir = tempfile.mkdtemp(prefix="sheetcraft-eventlog-")
    spark = build_session(
        master=master,
        shuffle_partitions=shuffle_partitions,
        extra={
            "spark.sql.adaptive.coalescePartitions.enabled": str(coalesce).lower(),
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": "file://" + log_dir,
            "spark.eventLog.compress": "false",
        },
    )
    return spark, log_dir


def stage_balance(log_dir: str) -> list[dict]:
    files = [f for f in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True) if os.path.isfile(f)]
    tasks: dict[int, list[int]] = defaultdict(list)
    names: dict[int, str] = {}
    for f in files:
        with open(f) as fh:
            for line in fh:
                ev = json.loads(line)
                if ev.get("Event") == "SparkListenerTaskEnd":
                    m = ev.get("Task Metrics") or {}
                    sr = m.get("Shuffle Read Metrics") or {}
                    recs = sr.get("Total Records Read", 0)
                    tasks[ev["Stage ID"]].append(recs)
                elif ev.get("Event") == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    names[info["Stage ID"]] = info.get("Stage Name", "")
    out = []
    for sid, recs in sorted(tasks.items()):
        total = sum(recs)
        if total == 0:
            continue
        out.append(
            {
                "stage": sid,
                "name": names.get(sid, "")[:40],
                "tasks": len(recs),
                "max_records": max(recs),
                "median_records": statistics.median(recs),
                "max_share": round(max(recs) / total, 3),
            }
        )
    return out


def main() -> None:
    """Skew comparison on the skewed referral table of ``tests/test_skew.py``
    (one key with a third of the rows): the default cleaning plan versus a
    plain window over everything."""
    import time

    from pyspark.sql import Window
    from pyspark.sql import functions as F

    import tests.test_skew as TS
    from sheetcraft.operators import referrals as R

    spark, log_dir = session_with_event_log()
    logs = R.filter_search_logs(TS._skewed_spark(spark))
    R.clean_referrals(logs).write.format("noop").mode("overwrite").save()
    time.sleep(2)
    flagship = stage_balance(log_dir)
    base = R.parse_times(R.anonymise(logs))
    keys = [F.col(f"`{k}`") for k in R.GROUP_KEYS]
    w = Window.partitionBy(*keys).orderBy(*[F.col(f"`{c}`") for c in R._ORDER_COLUMNS])
    naive = base.withColumn("n", F.row_number().over(w)).withColumn("m", F.max("n").over(Window.partitionBy(*keys)))
    naive.filter("m <= 10").write.format("noop").mode("overwrite").save()
    time.sleep(2)
    seen = {s["stage"] for s in flagship}
    print(json.dumps({"flagship": flagship, "plain_window": [s for s in stage_balance(log_dir) if s["stage"] not in seen]}))
    spark.stop()


if __name__ == "__main__":
    main()
