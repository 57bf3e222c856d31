"""Run times of updates on a stream, and rows that arrive once however often they are sent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gneiss.operators.keys import key_list
from gneiss.plans.event_log import update_events
from gneiss.plans.runs import FINAL_STATES


def stream_update_runtimes(log: DataFrame, delay: str = "1 hour", longest: str = "1 day") -> DataFrame:
    """Each start of an update with the ends that follow it within ``longest``, or with none.

    Starts and ends are two streams of one log, each with a watermark ``delay`` behind. A start waits in
    state until the watermark has passed the time by which it must have ended; then it is given out without an
    end, as unfinished. The state so holds the updates of about one ``longest`` and no more. An update that ends
    in several states has a row for each. On a batch, every start without an end is unfinished.
    """
    events = update_events(log).select("pipeline_id", "pipeline_name", "update_id", "event_time", "update_state")
    starts = events.filter(F.col("update_state") == "RUNNING").select(
        "pipeline_id", "pipeline_name", "update_id", F.col("event_time").alias("update_start_time"))
    ends = events.filter(F.col("update_state").isin(FINAL_STATES)).select(
        F.col("pipeline_id").alias("_pipeline"), F.col("update_id").alias("_update"), F.col("update_state").alias("final_state"),
        F.col("event_time").alias("update_end_time"))
    starts, ends = starts.withWatermark("update_start_time", delay), ends.withWatermark("update_end_time", delay)
    after = (F.col("update_end_time") >= F.col("update_start_time")) & (
        F.col("update_end_time") <= F.col("update_start_time") + F.expr(f"INTERVAL {longest}"))
    same = (F.col("pipeline_id") == F.col("_pipeline")) & (F.col("update_id") == F.col("_update"))
    minutes = (F.unix_timestamp("update_end_time") - F.unix_timestamp("update_start_time")) / F.lit(60.0)
    return starts.join(ends, same & after, "left_outer").select(
        "pipeline_id", "pipeline_name", "update_id", "update_start_time", "update_end_time", "final_state", minutes.alias("runtime_minutes"))


def once(stream: DataFrame, keys, time: str, delay: str) -> DataFrame:
    """The first row of every key, across micro-batches, while its repeats come within ``delay`` of it.

    State holds the keys of the last ``delay`` only. A repeat that comes later than that is older than the watermark
    of ``time`` if it carries the time of the first, and so goes too.
    """
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(key_list(keys))
