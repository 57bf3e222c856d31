"""Cost of pipelines: cleaned usage with anomalies and forecast, daily summary, KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gneiss.functions.values import day, ratio, steady_round
from gneiss.operators.merge import merge_upsert
from gneiss.operators.ordered import rolling_mean

def runs_per_job(runs: DataFrame) -> DataFrame:
    """One row per pipeline and job out of one per update, with the number of pipelines of the job.

    A pipeline's name may be missing on some updates; the greatest one counts.
    """
    jobs = runs.filter(F.col("job_id").isNotNull()).groupBy("pipeline_id", "job_id").agg(
        F.max("pipeline_name").alias("pipeline_name"),
        F.max("output_table").alias("output_table"),
        F.max("cluster_type").alias("cluster_type"),
        F.sum("idle_minutes").alias("idle_minutes"),
        F.sum("active_minutes").alias("active_minutes"),
    )
    return jobs.withColumn("job_pipelines", F.count("*").over(Window.partitionBy("job_id")))


def cleaned_costs(usage: DataFrame, runs: DataFrame, as_of=None, order_by=("usage_id",), reduce_runs: bool = True) -> DataFrame:
    """Usage of the last seven days with pipeline, anomaly flag and forecast.

    A cost is an anomaly above twice the mean of the previous seven rows of its pipeline;
    the forecast is seven times the mean of the last seven rows, its own included. Rows are
    ordered by date, then ``order_by``, which has to make the order total. The date filter
    comes before the windows, so they never reach back further.

    The event-log summary has a row per update, which would repeat each usage row once per
    update of its job; it is reduced to a row per job first. A job that serves several
    pipelines has its usage split among them evenly, so the costs sum to those of the usage.
    ``reduce_runs=False`` says the runs already are one per job and joins them as they are.
    """
    today = day(as_of)
    date = F.col("usage_start_time").cast("date")
    recent = usage.filter(date.between(F.date_sub(today, 7), today)).withColumn("usage_date", date)
    jobs = runs_per_job(runs) if reduce_runs else runs.withColumn("job_pipelines", F.lit(1)).filter(F.col("job_id").isNotNull())
    joined = recent.join(jobs, "job_id").withColumns({
        "dbu_cost": F.col("dbu_cost") / F.col("job_pipelines"), "dbus": F.col("dbus") / F.col("job_pipelines")})
    rolled = rolling_mean(joined, ["pipeline_id"], ["usage_date", *order_by], "dbu_cost", {"_previous": (-7, -1), "_recent": (-6, 0)}, cut_by=recent)
    cost = F.col("dbu_cost")

    def share(kind):
        return F.when(F.col("compute_type") == kind, cost).otherwise(0.0)

    return rolled.select(
        "usage_date",
        "pipeline_id",
        "pipeline_name",
        cost.alias("cost_usd"),
        "dbus",
        "output_table",
        "cluster_type",
        "idle_minutes",
        "active_minutes",
        (cost > 2 * F.col("_previous")).alias("cost_anomaly_flag"),
        (F.col("_recent") * 7).alias("predicted_cost_7d"),
        share("job_compute").alias("job_compute_cost"),
        share("warehouse").alias("warehouse_cost"),
    )


def costs_by_runtime(usage: DataFrame, runtimes: DataFrame, jobs: DataFrame, hours: int = 1) -> DataFrame:
    """Usage charged to the pipelines whose updates ran meanwhile, by the seconds they overlap.

    ``usage`` has usage_id, job_id, usage_start_time, usage_end_time, dbu_cost and dbus; ``runtimes`` are run times of updates;
    ``jobs`` lists pipeline_id and job_id. Usage during which no update of its job ran is split evenly
    among the job's pipelines; that of a job without pipelines keeps a null pipeline. So totals are kept.

    Usage and updates are cut at the hours they touch and meet by job and hour, each adding the seconds they
    share within that hour: no usage meets an update of another time, and nothing has to be made distinct.
    """
    step = 3600 * hours
    seconds = {c: F.unix_micros(c) / F.lit(1e6) for c in ("usage_start_time", "usage_end_time", "update_start_time", "update_end_time")}

    def cut(df: DataFrame, start: str, end: str) -> DataFrame:
        """A row for each stretch of ``hours`` that an interval touches, with the part of it inside."""
        known = df.filter(F.col(end) > F.col(start)).withColumns({"_from": seconds[start], "_to": seconds[end]})
        slots = F.sequence(F.floor(F.col("_from") / step), F.floor(F.col("_to") / step))
        each = known.withColumn("_slot", F.explode(slots))
        return each.withColumns({"_from": F.greatest("_from", F.col("_slot") * step), "_to": F.least("_to", (F.col("_slot") + 1) * step)})

    updates = runtimes.groupBy("pipeline_id", "update_id").agg(F.min("update_start_time").alias("update_start_time"), F.max("update_end_time").alias("update_end_time"))
    members = jobs.filter(F.col("job_id").isNotNull()).select("pipeline_id", "job_id").distinct()
    ran = cut(updates.join(members, "pipeline_id"), "update_start_time", "update_end_time").select(
        "job_id", "_slot", "pipeline_id", F.col("_from").alias("_run_from"), F.col("_to").alias("_run_to"))
    used = cut(usage, "usage_start_time", "usage_end_time").select("usage_id", "job_id", "_slot", "_from", "_to")
    shared = F.least("_to", "_run_to") - F.greatest("_from", "_run_from")
    overlaps = used.join(ran, ["job_id", "_slot"]).withColumn("_shared", shared).filter("_shared > 0")
    per_pipeline = overlaps.groupBy("usage_id", "pipeline_id").agg(F.sum("_shared").alias("_shared"))
    # A usage row has as many parts as its job has pipelines at most.
    parts = per_pipeline.groupBy("usage_id").agg(
        F.collect_list(F.struct("pipeline_id", "_shared")).alias("_parts"), F.sum("_shared").alias("_all"))
    charged = usage.join(parts, "usage_id", "left")
    by_time = charged.filter("_parts IS NOT NULL").select("*", F.inline("_parts")).withColumn("_share", F.col("_shared") / F.col("_all")).drop("_shared")
    of_job = members.groupBy("job_id").agg(F.collect_list("pipeline_id").alias("_members"))
    evenly = charged.filter("_parts IS NULL").join(of_job, "job_id", "left").select(
        "*", F.explode_outer("_members").alias("pipeline_id"), (1 / F.coalesce(F.size("_members"), F.lit(1))).alias("_share")).drop("_members")
    both = by_time.withColumn("charged_by", F.lit("runtime")).unionByName(evenly.withColumn(
        "charged_by", F.when(F.col("pipeline_id").isNull(), "nothing").otherwise("even split")))
    return both.select(
        "usage_id", F.col("usage_start_time").cast("date").alias("usage_date"), "job_id", "pipeline_id", "charged_by",
        (F.col("dbu_cost") * F.col("_share")).alias("cost_usd"), (F.col("dbus") * F.col("_share")).alias("dbus"))


def cost_summary(costs: DataFrame, as_of=None) -> DataFrame:
    """The daily summary per pipeline; ``as_of=None`` gives every day in the data.

    The trend compares with the pipeline's previous day. Costliest pipeline and table are
    those with the highest cost of that day. Windows and joins see one row per pipeline
    and day.
    """
    # Numbers first, hashed by the few names of a pipeline's day; names are compared among the reduced rows.
    day_and_pipeline = [F.col("usage_date").alias("summary_date"), "pipeline_id"]
    sums = ["cost_usd", "dbus", "predicted_cost_7d", "job_compute_cost", "warehouse_cost", "idle_minutes"]
    reduced = costs.groupBy(*day_and_pipeline, "pipeline_name", "output_table", "cluster_type").agg(
        *[F.sum(c).alias(c) for c in sums],
        F.sum(F.col("idle_minutes") + F.col("active_minutes")).alias("_minutes"),
        F.count("cost_usd").alias("_costs"),
        F.sum(F.coalesce(F.col("cost_anomaly_flag").cast("int"), F.lit(0))).alias("_flags"),
        F.max("cost_usd").alias("_top"),
    )
    daily = reduced.groupBy("summary_date", "pipeline_id").agg(
        F.max("pipeline_name").alias("pipeline_name"),
        F.sum("cost_usd").alias("total_cost_usd"),
        F.sum("dbus").alias("dbus_7d"),
        steady_round(F.sum("cost_usd") / F.sum("_costs")).alias("avg_cost_per_pipeline"),
        (steady_round(ratio(F.sum("idle_minutes"), F.sum("_minutes"))) * 100).alias("idle_time_pct"),
        F.sum("_flags").alias("cost_anomaly_flag"),
        steady_round(F.sum("predicted_cost_7d")).alias("cost_forecast_7d"),
        steady_round(F.sum("job_compute_cost")).alias("job_compute_cost"),
        steady_round(F.sum("warehouse_cost")).alias("warehouse_cost"),
        F.min("cluster_type").alias("cost_by_cluster"),
        F.max(F.struct(F.col("_top").alias("cost_usd"), "output_table")).alias("_top_row"),
    )
    earlier = F.lag("total_cost_usd").over(Window.partitionBy("pipeline_id").orderBy("summary_date"))
    trend = steady_round(ratio(F.col("total_cost_usd") - earlier, earlier) * 100)
    daily = daily.withColumn("cost_trend_pct", trend)
    if as_of is not None:
        daily = daily.filter(F.col("summary_date") == day(as_of))
    leaders = daily.groupBy("summary_date").agg(
        F.max(F.struct("total_cost_usd", "pipeline_name"))["pipeline_name"].alias("highest_cost_pipeline"),
        F.max("_top_row")["output_table"].alias("most_expensive_table"),
    )
    return daily.join(leaders, "summary_date").select(
        "summary_date",
        "pipeline_id",
        "pipeline_name",
        "total_cost_usd",
        "dbus_7d",
        "avg_cost_per_pipeline",
        "highest_cost_pipeline",
        "idle_time_pct",
        "cost_anomaly_flag",
        "most_expensive_table",
        "cost_forecast_7d",
        "job_compute_cost",
        "warehouse_cost",
        "cost_by_cluster",
        "cost_trend_pct",
    )


def upsert_cost_summary(stored: DataFrame, summary: DataFrame) -> DataFrame:
    """The stored summary with the rows of ``summary`` updated or added, by day and pipeline.

    Merging the same rows again changes nothing.
    """
    return merge_upsert(stored, summary, ["summary_date", "pipeline_id"])


def cost_kpis(summary: DataFrame, as_of=None) -> DataFrame:
    """The headline cost numbers of one day in a single pass."""
    return summary.filter(F.col("summary_date") == day(as_of)).agg(
        F.sum("dbus_7d").alias("total_dbus"),
        steady_round(F.avg("avg_cost_per_pipeline")).alias("avg_cost_per_pipeline"),
        steady_round(F.avg("idle_time_pct")).alias("idle_time_pct"),
        F.sum("cost_anomaly_flag").alias("cost_anomalies"),
        steady_round(F.sum("cost_forecast_7d")).alias("cost_forecast_7d"),
        steady_round(F.sum("job_compute_cost")).alias("job_cost"),
        steady_round(F.sum("warehouse_cost")).alias("warehouse_cost"),
    )


def costliest_pipeline(summary: DataFrame, as_of=None) -> DataFrame:
    rows = summary.filter(F.col("summary_date") == day(as_of)).select("pipeline_name", "total_cost_usd")
    return rows.orderBy(F.col("total_cost_usd").desc(), "pipeline_name").limit(1)


def costliest_table(summary: DataFrame, as_of=None) -> DataFrame:
    rows = summary.filter(F.col("summary_date") == day(as_of))
    grouped = rows.groupBy("most_expensive_table").agg(F.max("total_cost_usd").alias("total_cost_usd"))
    return grouped.orderBy(F.col("total_cost_usd").desc(), "most_expensive_table").limit(1)


def cost_by_cluster(summary: DataFrame, as_of=None) -> DataFrame:
    rows = summary.filter(F.col("summary_date") == day(as_of))
    return rows.groupBy("cost_by_cluster").agg(F.sum("total_cost_usd").alias("total_cost"))


def cost_trend(summary: DataFrame, as_of=None, steps: int = 5) -> DataFrame:
    """Change in percent of the latest day's total against the one ``steps`` days of data before.

    Only the latest ``steps + 1`` daily totals are ordered.
    """
    totals = summary.filter(F.col("summary_date") <= day(as_of)).groupBy("summary_date").agg(
        F.sum("total_cost_usd").alias("total")
    )
    last = totals.orderBy(F.col("summary_date").desc()).limit(steps + 1)
    earlier = F.lag("total", steps).over(Window.orderBy("summary_date"))
    change = steady_round(ratio(F.col("total") - earlier, earlier) * 100).alias("cost_trend_pct")
    return last.select("summary_date", change).orderBy(F.col("summary_date").desc()).limit(1).select("cost_trend_pct")


def usage_by_sku(usage: DataFrame, job_id: str | None = None) -> DataFrame:
    """Usage and its rows per job and SKU, of one job or of all."""
    rows = usage.filter(F.col("job_id").isNotNull() if job_id is None else F.col("job_id") == str(job_id))
    return rows.groupBy("job_id", "sku_name").agg(
        F.sum("usage_quantity").alias("usage_quantity"), F.count("*").alias("record_count")
    )
