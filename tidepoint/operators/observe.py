"""Counts and marks taken while rows are written, so that a source is evaluated once."""

from __future__ import annotations

import queue
import threading
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

WAIT_SECONDS = 120


class Observed:
    """``rows`` with metrics of the first action that reads them, such as a write."""

    def __init__(self, rows: DataFrame, *metrics: Column):
        self._observation = Observation()
        self.rows = rows.observe(self._observation, *metrics)

    @classmethod
    def progress(cls, points: DataFrame, time: Column, number: Column | None = None) -> Observed:
        """Number of points as ``n`` and the latest time and id at it as ``last``."""
        place = F.struct(
            time.alias("t"), (F.lit(None).cast("bigint") if number is None else number).alias("i")
        )
        return cls(
            points,
            F.count(F.lit(1)).alias("n"),
            F.max(F.when(time.isNotNull(), place)).alias("last"),
        )

    def get(self) -> dict[str, Any]:
        """The metrics; an error if nothing has read the rows."""
        found: queue.Queue = queue.Queue()

        def wait() -> None:
            found.put(self._observation.get)

        threading.Thread(target=wait, daemon=True).start()
        try:
            return found.get(timeout=WAIT_SECONDS)
        except queue.Empty:
            raise RuntimeError("the sink has read none of the rows it was given") from None
