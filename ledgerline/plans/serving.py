"""Queries behind the dashboards. Dates come in as arguments, never from the clock."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.calc import change_pct, money, percent, tag, trend_sign
from ledgerline.plans.facts import TAGS
from ledgerline.plans.gold import rollup_cost


def _month(date: str) -> Column:
    return F.date_format(date, "yyyy-MM")


def _months(as_of: dt.date) -> tuple[str, str]:
    last = as_of.replace(day=1) - dt.timedelta(days=1)
    return as_of.strftime("%Y-%m"), last.strftime("%Y-%m")


def _reduced(fact: DataFrame, extra: Sequence = ()) -> DataFrame:
    """The cost fact by month, workspace, user and job: distinct counts then run over few rows."""
    return rollup_cost(fact, [_month("usage_date").alias("month"), "workspace_id", "user_id", "job_id", *extra])


def executive_kpis(fact: DataFrame, audit: DataFrame, anomalies: DataFrame, as_of: dt.date) -> DataFrame:
    """Nine figures in one row: one pass per input, joined as scalar subqueries."""
    now, before = _months(as_of)
    cost = _reduced(fact).agg(
        money(F.sum(F.when(F.col("month") == now, F.col("estimated_cost")))).alias("current_month_cost"),
        money(F.sum(F.when(F.col("month") == before, F.col("estimated_cost")))).alias("previous_month_cost"),
        money(F.sum("usage_quantity")).alias("total_usage"),
        F.count_distinct("workspace_id").alias("active_workspaces"),
        F.count_distinct("user_id").alias("active_users"),
        F.count_distinct("job_id").alias("total_jobs"),
    )
    events = audit.agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.count_if(F.col("response_status") >= 400).alias("bad"))
    ).scalar()
    unresolved = anomalies.agg(F.count_if(F.col("status") == "Open")).scalar()
    return cost.withColumns({"_e": events, "open_anomalies": unresolved}).select(
        *cost.columns,
        F.col("_e.n").alias("total_audit_events"),
        F.col("_e.bad").alias("failed_audit_events"),
        "open_anomalies",
    )


def kpi_compare(fact: DataFrame, as_of: dt.date) -> DataFrame:
    """Figures of the month of ``as_of`` and of the month before, with change and direction."""
    now, before = _months(as_of)
    r = _reduced(fact).filter(F.col("month").isin(now, before))
    measures = {
        "cost": F.sum("estimated_cost"), "usage": F.sum("usage_quantity"),
        "workspaces": F.count_distinct("workspace_id"), "users": F.count_distinct("user_id"),
        "jobs": F.count_distinct("job_id"),
    }
    per = r.groupBy("month").agg(*[money(m).alias(n) for n, m in measures.items()])
    rows = F.array(*[F.struct(F.lit(n).alias("kpi"), F.col(n).alias("value")) for n in measures])
    flat = per.select("month", F.explode(rows).alias("x")).groupBy(F.col("x.kpi").alias("kpi")).agg(
        F.max(F.when(F.col("month") == now, F.col("x.value"))).alias("current_value"),
        F.max(F.when(F.col("month") == before, F.col("x.value"))).alias("previous_value"),
    )
    cur, prev = F.col("current_value"), F.col("previous_value")
    return flat.withColumns({"change_percentage": change_pct(cur, prev), "trend": trend_sign(cur, prev)})


def cost_trend(daily: DataFrame, grain: str = "day") -> DataFrame:
    """Cost and usage per day, week or month."""
    period = F.date_trunc(grain, "usage_date").cast("date").alias("period")
    return daily.groupBy(period).agg(
        money(F.sum("total_cost")).alias("total_cost"), money(F.sum("total_usage")).alias("total_usage")
    ).orderBy("period")


def cost_by_environment(daily: DataFrame) -> DataFrame:
    return daily.groupBy("environment").agg(money(F.sum("total_cost")).alias("total_cost")).orderBy(
        F.desc("total_cost"), "environment"
    )


def cost_by_sku(sku: DataFrame) -> DataFrame:
    """Cost per SKU with its share of the whole; the total is a scalar, not a one-task window."""
    per = sku.groupBy("sku").agg(
        money(F.sum("usage_quantity")).alias("usage_quantity"), money(F.sum("estimated_cost")).alias("estimated_cost")
    )
    total = sku.agg(F.sum("estimated_cost").cast("double")).scalar()
    return per.withColumn("_total", total).select(
        *per.columns, percent(F.col("estimated_cost").cast("double") / F.col("_total")).alias("cost_pct")
    ).orderBy(F.desc("estimated_cost"), "sku")


def top_users(user: DataFrame, n: int = 20, by: str = "total_cost") -> DataFrame:
    return (
        user.groupBy("user_name")
        .agg(money(F.sum("usage_quantity")).alias("total_usage"), money(F.sum("estimated_cost")).alias("total_cost"))
        .orderBy(F.desc(by), "user_name")
        .limit(n)
    )


def workspace_ranking(
    workspace: DataFrame, daily: DataFrame, monthly: DataFrame, user: DataFrame, job: DataFrame, audit: DataFrame,
    month: str,
) -> DataFrame:
    """One row per workspace. ``mom_pct`` is the change of ``month``; ``max_daily_pct`` the largest daily one."""
    d = daily.groupBy("workspace_id").agg(
        money(F.sum("total_cost")).alias("cost"), money(F.sum("total_usage")).alias("usage"),
        F.max("cost_change_percentage").alias("max_daily_pct"),
    )
    m = monthly.filter(F.col("month") == month).select("workspace_id", F.col("month_over_month_percentage").alias("mom_pct"))
    u = user.groupBy("workspace_id").agg(F.count_distinct("user_name").alias("users"))
    j = job.groupBy("workspace_id").agg(F.count_distinct("job_id").alias("jobs"))
    a = audit.groupBy("workspace_id").agg(F.sum("event_count").alias("audit_events"))
    out = workspace.select("workspace_id", "workspace_name", "environment")
    for side in (d, m, u, j, a):
        out = out.join(side, "workspace_id", "left")
    return out.fillna(0, ["cost", "usage", "max_daily_pct", "mom_pct", "users", "jobs", "audit_events"]).orderBy(
        F.desc("cost"), "workspace_id"
    )


def audit_by_action(audit: DataFrame) -> DataFrame:
    return audit.groupBy("action_name").agg(
        F.count(F.lit(1)).alias("event_count"), F.count_if(F.col("response_status") >= 400).alias("failed_events")
    ).orderBy(F.desc("event_count"), "action_name")


def audit_by_hour(audit: DataFrame) -> DataFrame:
    return audit.groupBy(F.hour("event_time").alias("hour")).agg(
        F.count(F.lit(1)).alias("event_count"), F.count_if(F.col("response_status") >= 400).alias("failed_events")
    )


def audit_overview(audit: DataFrame) -> DataFrame:
    """Totals of the audit page in one pass."""
    return audit.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_distinct("user_name").alias("unique_users"),
        F.count_distinct("workspace_id").alias("unique_workspaces"),
        F.count_if(F.col("response_status") >= 400).alias("failed_events"),
        F.count_if(F.col("audit_level") == "ACCOUNT").alias("admin_events"),
        F.count_if(F.col("user_type") == "servicePrincipal").alias("principal_events"),
    )


def audit_breakdowns(audit: DataFrame) -> DataFrame:
    """Events by day, address, principal, workspace and action from one scan."""
    by = {"day": "event_date", "source_ip": "source_ip", "principal": "service_principal", "workspace": "workspace_id",
          "action": "action_name"}
    failed = F.count_if(F.col("response_status") >= 400)
    base = audit.groupBy(*by.values()).agg(F.count(F.lit(1)).alias("n"), failed.alias("bad"))
    pairs = F.array(*[F.struct(F.lit(k).alias("dimension"), F.col(c).cast("string").alias("member")) for k, c in by.items()])
    flat = base.select(F.explode(pairs).alias("x"), "n", "bad").filter("x.member IS NOT NULL")
    return flat.groupBy("x.dimension", "x.member").agg(F.sum("n").alias("event_count"), F.sum("bad").alias("failed_events"))


COMPARE = ("cost", "usage", "users", "jobs", "events", "failed_events", "cost_per_user", "cost_per_job")


def workspace_compare(fact: DataFrame, audit: DataFrame, workspace_ids: Sequence[str]) -> DataFrame:
    """Measures as rows, the chosen workspaces as columns."""
    ids = list(workspace_ids)
    r = _reduced(fact.filter(F.col("workspace_id").isin(ids))).groupBy("workspace_id").agg(
        F.sum("estimated_cost").cast("double").alias("cost"),
        F.sum("usage_quantity").cast("double").alias("usage"),
        F.count_distinct("user_id").cast("double").alias("users"),
        F.count_distinct("job_id").cast("double").alias("jobs"),
    )
    a = audit.filter(F.col("workspace_id").isin(ids)).groupBy("workspace_id").agg(
        F.count(F.lit(1)).cast("double").alias("events"),
        F.count_if(F.col("response_status") >= 400).cast("double").alias("failed_events"),
    )
    j = r.join(a, "workspace_id", "full_outer").withColumns({
        "cost_per_user": F.col("cost") / F.nullif("users", F.lit(0.0)),
        "cost_per_job": F.col("cost") / F.nullif("jobs", F.lit(0.0)),
    })
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in COMPARE])
    flat = j.select("workspace_id", F.explode(rows).alias("x")).select("workspace_id", "x.*")
    out = flat.groupBy("metric").pivot("workspace_id", ids).agg(F.max("value"))
    # A workspace without rows has no cost, but it has zero users, jobs and events.
    counted = F.col("metric").isin("users", "jobs", "events", "failed_events")
    return out.select("metric", *[F.when(counted, F.coalesce(F.col(f"`{w}`"), F.lit(0.0))).otherwise(F.col(f"`{w}`")).alias(w) for w in ids])


DRILL = ["workspace_id", "sku", "job_id", "cluster_id", "user_id"]


def drill_rollup(fact: DataFrame, path: Sequence[str] = DRILL) -> DataFrame:
    """Totals for every level of a drill path; ``level`` is the number of columns fixed.

    The rollup runs over rows already grouped by the full path.
    """
    path = list(path)
    base = rollup_cost(fact, path)
    levels = len(path) - sum((F.grouping(c) for c in path), F.lit(0))
    return base.rollup(*path).agg(
        levels.cast("int").alias("level"),
        money(F.sum("usage_quantity")).alias("usage_quantity"),
        money(F.sum("estimated_cost")).alias("estimated_cost"),
    )


FILTERS = ("workspace_id", "workspace_name", "environment", "cloud", "region", "business_unit", "department",
           "cost_center", "application", "project", "sku", "user_id", "service_principal_id")


def filtered(df: DataFrame, filters: Mapping[str, object], date: str = "usage_date") -> DataFrame:
    """Global filters: a value, a list of values, or ``date_range`` as (first, last)."""
    for name, value in filters.items():
        if name == "date_range":
            df = df.filter(F.col(date).between(F.lit(value[0]).cast("date"), F.lit(value[1]).cast("date")))
        elif name not in FILTERS:
            raise ValueError(f"unknown filter {name}")
        else:
            values = value if isinstance(value, (list, tuple, set)) else [value]
            column = tag(F.col("custom_tags"), *TAGS[name]) if name in TAGS and name not in df.columns else F.col(name)
            df = df.filter(column.isin(list(values)))
    return df


def user_activity(fact: DataFrame, audit: DataFrame) -> DataFrame:
    """Usage, cost and events per workspace and user; mail domains are ignored."""
    c = rollup_cost(fact.filter("user_id IS NOT NULL"), ["workspace_id", F.col("user_id").alias("user_name")], "total_usage", "total_cost")
    a = audit.filter("user_name IS NOT NULL").groupBy(
        "workspace_id", F.split_part("user_name", F.lit("@"), F.lit(1)).alias("user_name")
    ).agg(
        F.count(F.lit(1)).alias("audit_events"),
        F.count_if(F.col("response_status") >= 400).alias("failed_events"),
        F.max("event_time").alias("last_activity"),
    )
    return c.join(a, ["workspace_id", "user_name"], "full_outer").fillna(0, ["audit_events", "failed_events"])


def job_table(fact: DataFrame, runs: DataFrame) -> DataFrame:
    """Runs, cost and cost per run of each job, with failures and mean duration from the run log."""
    j = fact.filter("job_id IS NOT NULL")
    # Reduced by run first, so the distinct count meets each run once per task.
    per_run = rollup_cost(j, ["workspace_id", "job_id", "job_run_id"], carry={"job_name": "job_name"})
    t = per_run.groupBy("workspace_id", "job_id").agg(
        F.max("job_name").alias("job_name"),
        F.count("job_run_id").alias("run_count"),
        money(F.sum("usage_quantity")).alias("total_usage"),
        money(F.sum("estimated_cost")).alias("total_cost"),
    )
    r = runs.groupBy("job_id").agg(
        F.count_if(F.col("result_state") != "SUCCESS").alias("failure_count"),
        F.round(F.avg("duration_seconds"), 4).alias("avg_duration"),
    )
    cost_per_run = F.col("total_cost").cast("double") / F.nullif("run_count", F.lit(0))
    return t.join(r, "job_id", "left").withColumn("avg_cost_per_run", cost_per_run)


def compute_table(fact: DataFrame, key: str, workspace: DataFrame) -> DataFrame:
    """Cost of each cluster or warehouse with its owner and environment."""
    used = fact.filter(F.col(key).isNotNull())
    t = used.groupBy("workspace_id", key).agg(
        F.max("node_type").alias("node_type"),
        F.count(F.lit(1)).alias("usage_records"),
        money(F.sum("usage_quantity")).alias("total_usage"),
        money(F.sum("estimated_cost")).alias("total_cost"),
    )
    return t.join(workspace.select("workspace_id", "environment", "owner"), "workspace_id", "left")


def two_measure_summary(df: DataFrame, key: str, first: str, second: str, n: str, first_out: str, second_out: str) -> DataFrame:
    """Rows and two rounded means per group."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias(n), F.round(F.avg(first), 1).alias(first_out), F.round(F.avg(second), 2).alias(second_out)
    ).orderBy(key)
