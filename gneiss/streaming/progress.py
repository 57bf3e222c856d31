"""Progress of streaming queries as data."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

# The part of Spark's progress document that the report reads.
PROGRESS_SCHEMA = (
    "name STRING, batchId BIGINT, timestamp STRING, numInputRows BIGINT, inputRowsPerSecond DOUBLE, "
    "processedRowsPerSecond DOUBLE, durationMs MAP<STRING, BIGINT>, "
    "stateOperators ARRAY<STRUCT<numRowsDroppedByWatermark: BIGINT, numRowsTotal: BIGINT>>"
)


class ProgressLog(StreamingQueryListener):
    """Appends the progress document of every micro-batch to a folder, one per line.

    Spark itself keeps the last few documents only. Register it with ``spark.streams.addListener``
    before a query starts, and ``flush`` after it ended, as documents arrive a little later.
    Read them back with ``spark.read.text(path)``; the column is called ``value``.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.ended = spark, path, set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        document = self.spark.createDataFrame([(event.progress.json,)], "document STRING")
        document.coalesce(1).write.mode("append").text(self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))

    def flush(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Wait until the documents of an ended query are stored."""
        until = time.monotonic() + seconds
        while str(query.runId) not in self.ended:
            if time.monotonic() > until:
                raise TimeoutError(f"no end of query {query.runId} was reported")
            time.sleep(0.05)


def observed_counts(documents: DataFrame, name: str, column: str = "document") -> DataFrame:
    """The counts observed under a name, summed over all micro-batches: (metric, total)."""
    kept = F.from_json(column, "observedMetrics MAP<STRING, MAP<STRING, BIGINT>>")["observedMetrics"][name]
    each = documents.select(F.explode_outer(kept).alias("metric", "n")).filter("metric IS NOT NULL")
    return each.groupBy("metric").agg(F.sum("n").alias("total"))


def progress_table(documents: DataFrame, column: str = "document") -> DataFrame:
    """One row per micro-batch; ``falling_behind`` when rows arrive faster than they are processed."""
    p = documents.select(F.from_json(column, PROGRESS_SCHEMA).alias("p")).select("p.*")
    late = F.aggregate(
        F.coalesce("stateOperators", F.array()),
        F.lit(0).cast("bigint"),
        lambda total, op: total + F.coalesce(op["numRowsDroppedByWatermark"], F.lit(0)),
    )
    return p.select(
        F.col("name").alias("query_name"),
        F.col("batchId").alias("batch_id"),
        F.col("timestamp").cast("timestamp").alias("started_at"),
        F.col("numInputRows").alias("input_rows"),
        F.col("inputRowsPerSecond").alias("input_rate"),
        F.col("processedRowsPerSecond").alias("processed_rate"),
        F.col("durationMs").getItem("triggerExecution").alias("duration_ms"),
        late.alias("late_rows"),
        F.coalesce(F.col("inputRowsPerSecond") > F.col("processedRowsPerSecond"), F.lit(False)).alias("falling_behind"),
    )
