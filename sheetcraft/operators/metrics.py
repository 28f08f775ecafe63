"""Row counts of job stages, taken while the stages run.

``RunReport.watch`` puts named counters on a DataFrame (``Observation``); the
counts arrive with the action that runs the stage, so nothing is computed
twice.  ``RunReport.run`` times an action and files one record a stage.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class StageRecord:
    stage: str
    seconds: float
    counts: dict[str, int]


@dataclass
class RunReport:
    """Records of one job's stages, in the order they ran."""

    job: str
    records: list[StageRecord] = field(default_factory=list)
    _pending: list[Observation] = field(default_factory=list)

    def watch(self, df: DataFrame, **counters: Column | None) -> DataFrame:
        """Count rows (``None``) or rows where a condition holds, under the
        given names, on a node that occurs once in the plan."""
        seen = Observation()
        self._pending.append(seen)
        every = {k: F.count(F.lit(1)) if c is None else F.count_if(c) for k, c in counters.items()}
        return df.observe(seen, *[v.alias(k) for k, v in every.items()])

    def run(self, stage: str, action: Callable[[], object]) -> StageRecord:
        """Run a stage's action, then file what its counters saw."""
        begun = time.monotonic()
        action()
        took = time.monotonic() - begun
        counts = {k: int(v) for seen in self._pending for k, v in seen.get.items()}
        self._pending.clear()
        record = StageRecord(stage, took, counts)
        self.records.append(record)
        log.info("%s/%s: %s (%.3f s)", self.job, stage, ", ".join(f"{k}={v}" for k, v in counts.items()), took)
        return record

    def count(self, name: str) -> int:
        """The latest value of a counter."""
        return next(r.counts[name] for r in reversed(self.records) if name in r.counts)
