"""Queries over usage and cost. Sums of doubles are shown with four decimals."""

from __future__ import annotations

from pyspark.sql import functions as F

from gneiss.functions.values import steady_round
from gneiss.plans import cost, event_log, runs
from workload.registry import query
from workload.shapes import COST_DAY
from workload.sql_shapes import COST_SUMMARY, COSTS, LOG, RUNS_PER_UPDATE, USAGE, rounded

ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "dbu_cost"]


def costs(t):
    return cost.cleaned_costs(t.usage(), event_log.event_log_summary(t.event_log()), COST_DAY, ORDER)


def summary(t, as_of=None):
    return cost.cost_summary(costs(t), as_of)


def steady(df, *columns):
    return df.withColumns({c: steady_round(c, 4) for c in columns})


def with_costs(*parts: str) -> str:
    return "WITH " + ",".join([LOG, RUNS_PER_UPDATE, USAGE, COSTS, *parts])


SUMMARY = with_costs(COST_SUMMARY)
SHOWN = f"* REPLACE ({rounded('total_cost_usd', 4)} AS total_cost_usd)"


@query(with_costs() + f" SELECT * REPLACE ({rounded('predicted_cost_7d', 4)} AS predicted_cost_7d) FROM costs")
def cleaned_costs(t):
    return steady(costs(t), "predicted_cost_7d")


@query(SUMMARY + f" SELECT {SHOWN} FROM cost_summary")
def cost_summary(t):
    return steady(summary(t), "total_cost_usd")


@query(SUMMARY + f" SELECT {SHOWN} FROM cost_summary WHERE summary_date = DATE '1998-06-30'")
def cost_summary_today(t):
    return steady(summary(t, COST_DAY), "total_cost_usd")


@query(SUMMARY + f" SELECT {SHOWN} FROM cost_summary")
def cost_summary_upsert(t):
    """A stored summary, outdated on the last day and without one pipeline there, brought up to date twice."""
    rows = summary(t)
    last = F.col("summary_date") == F.lit(COST_DAY).cast("date")
    outdated = rows.filter(~(last & (F.col("pipeline_id") == "p0"))).withColumn("dbus_7d", F.when(last, 0.0).otherwise(F.col("dbus_7d")))
    today = summary(t, COST_DAY)
    merged = cost.upsert_cost_summary(cost.upsert_cost_summary(outdated, today), today)
    return steady(merged, "total_cost_usd")


@query(SUMMARY + f""" SELECT sum(dbus_7d) AS total_dbus, {rounded('avg(avg_cost_per_pipeline)')} AS avg_cost_per_pipeline,
    {rounded('avg(idle_time_pct)')} AS idle_time_pct, CAST(sum(cost_anomaly_flag) AS BIGINT) AS cost_anomalies,
    {rounded('sum(cost_forecast_7d)')} AS cost_forecast_7d, {rounded('sum(job_compute_cost)')} AS job_cost,
    {rounded('sum(warehouse_cost)')} AS warehouse_cost FROM cost_summary WHERE summary_date = DATE '1998-06-30'""")
def cost_kpis(t):
    return cost.cost_kpis(summary(t, COST_DAY), COST_DAY)


@query(SUMMARY + f""" SELECT pipeline_name, {rounded('total_cost_usd', 4)} AS total_cost_usd FROM cost_summary
    WHERE summary_date = DATE '1998-06-30' ORDER BY 2 DESC, 1 NULLS FIRST LIMIT 1""")
def costliest_flow(t):
    return steady(cost.costliest_pipeline(summary(t, COST_DAY), COST_DAY), "total_cost_usd")


@query(SUMMARY + f""" SELECT most_expensive_table, {rounded('max(total_cost_usd)', 4)} AS total_cost_usd FROM cost_summary
    WHERE summary_date = DATE '1998-06-30' GROUP BY ALL ORDER BY 2 DESC, 1 LIMIT 1""")
def costliest_table(t):
    return steady(cost.costliest_table(summary(t, COST_DAY), COST_DAY), "total_cost_usd")


@query(SUMMARY + f""" SELECT cost_by_cluster, {rounded('sum(total_cost_usd)', 4)} AS total_cost FROM cost_summary
    WHERE summary_date = DATE '1998-06-30' GROUP BY ALL""")
def cost_by_cluster(t):
    return steady(cost.cost_by_cluster(summary(t, COST_DAY), COST_DAY), "total_cost")


@query(SUMMARY + f""", totals AS (SELECT summary_date, sum(total_cost_usd) AS total FROM cost_summary GROUP BY ALL),
  lagged AS (SELECT *, lag(total, 5) OVER (ORDER BY summary_date) AS earlier FROM totals)
  SELECT {rounded('(total - earlier) / nullif(earlier, 0) * 100')} AS cost_trend_pct FROM lagged ORDER BY summary_date DESC LIMIT 1""")
def cost_trend(t):
    return cost.cost_trend(summary(t), COST_DAY)


@query("WITH " + USAGE + " SELECT job_id, sku_name, sum(usage_quantity) AS usage_quantity, count(*) AS record_count FROM usage GROUP BY ALL")
def usage_by_sku(t):
    return cost.usage_by_sku(t.usage())


# By definition: every usage row is compared with every update of its job.
BY_RUNTIME = "WITH " + LOG + f""",
  used AS (SELECT event_id AS usage_id, ts AS s, ts + (event_id % 180) * INTERVAL 1 MINUTE AS e, 'job_' || (user_id % 4) AS job_id, value AS cost, (event_id % 7)::DOUBLE AS dbus FROM events),
  spans AS (SELECT pipeline_id, 'job_' || (CAST(pipeline_id[2:] AS INT) % 3) AS job_id, update_id, min(update_start_time) AS us, max(update_end_time) AS ue FROM update_runtimes GROUP BY ALL),
  members AS (SELECT DISTINCT pipeline_id, 'job_' || pipe % 3 AS job_id FROM log),
  shared AS (SELECT usage_id, pipeline_id, sum(epoch_us(least(e, ue)) - epoch_us(greatest(s, us))) AS overlap FROM used JOIN spans USING (job_id) WHERE least(e, ue) > greatest(s, us) GROUP BY ALL),
  timed AS (SELECT usage_id, pipeline_id, overlap::DOUBLE / sum(overlap) OVER (PARTITION BY usage_id)::DOUBLE AS share, 'runtime' AS charged_by FROM shared),
  even AS (SELECT usage_id, pipeline_id, 1.0::DOUBLE / count(*) OVER (PARTITION BY usage_id) AS share, CASE WHEN pipeline_id IS NULL THEN 'nothing' ELSE 'even split' END AS charged_by
    FROM used LEFT JOIN members USING (job_id) WHERE usage_id NOT IN (SELECT usage_id FROM shared)),
  charged AS (SELECT CAST(s AS DATE) AS usage_date, pipeline_id, charged_by, share * cost AS cost_usd, share * dbus AS dbus, usage_id
    FROM (FROM timed UNION ALL FROM even) JOIN used USING (usage_id))
  SELECT usage_date, pipeline_id, charged_by, count(*) AS parts, {rounded('sum(cost_usd)', 4)} AS cost_usd, {rounded('sum(dbus)', 4)} AS dbus FROM charged GROUP BY ALL"""


@query(BY_RUNTIME)
def costs_by_runtime(t):
    """Daily cost of each pipeline, by the time its updates ran."""
    charged = cost.costs_by_runtime(t.timed_usage(), runs.update_runtimes(t.event_log()), t.shared_jobs())
    daily = charged.groupBy("usage_date", "pipeline_id", "charged_by").agg(
        F.count("*").alias("parts"), F.sum("cost_usd").alias("cost_usd"), F.sum("dbus").alias("dbus"))
    return steady(daily, "cost_usd", "dbus")
