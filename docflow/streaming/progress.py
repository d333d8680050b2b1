"""Counters of ingest jobs, and a periodic report of running streams."""

from __future__ import annotations

import json
import logging
import time

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

# Fixed value: seconds between two reports.
REPORT_SECONDS = 60.0

logger = logging.getLogger("docflow.progress")


def counted(df: DataFrame, name: str | Observation, **conditions: Column) -> DataFrame:
    """Count the rows that pass this point (``rows``) and those that meet each condition.

    Costs no extra pass: the numbers come with the job's own result, through the observation or,
    for a stream, with every progress event.
    """
    counts = [F.count(F.lit(1)).alias("rows")]
    counts += [F.count_if(condition).alias(key) for key, condition in conditions.items()]
    return df.observe(name, *counts)


class ProgressReport(StreamingQueryListener):
    """Logs the progress of all streams at most once per period and keeps every event until it is stored."""

    def __init__(self, seconds: float = REPORT_SECONDS):
        self.seconds = seconds
        self.events: list[dict] = []
        self._reported = float("-inf")

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        progress = event.progress
        self.events.append(
            {
                "query": progress.name or str(progress.id),
                "batch_id": progress.batchId,
                "input_rows": progress.numInputRows,
                "rows_per_second": progress.processedRowsPerSecond,
                "millis": dict(progress.durationMs),
                "observed": {k: v.asDict() for k, v in progress.observedMetrics.items()},
            }
        )
        if time.monotonic() - self._reported >= self.seconds:
            self._reported = time.monotonic()
            logger.info("progress %s", self.events[-1])

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def store(self, spark: SparkSession, folder: str) -> None:
        """Append the events so far to a table of JSON lines and forget them."""
        done, self.events = self.events, []
        if done:
            spark.createDataFrame([(json.dumps(e, default=str),) for e in done], "value string").write.mode("append").text(folder)

    def latencies(self) -> list[float]:
        """Milliseconds spent on adding each remembered batch to the sink."""
        return [e["millis"].get("addBatch", 0) for e in self.events]
