"""Gold aggregates of the cost and audit facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.calc import money
from ledgerline.operators.baseline import period_change


def rollup_cost(
    fact: DataFrame, keys: Sequence, usage: str = "usage_quantity", cost: str = "estimated_cost",
    not_null: str | None = None, carry: dict[str, str] | None = None,
) -> DataFrame:
    """Usage and cost summed by ``keys``; ``carry`` adds the largest value of a column."""
    if not_null:
        fact = fact.filter(F.col(not_null).isNotNull())
    return fact.groupBy(*keys).agg(
        *[F.max(src).alias(out) for out, src in (carry or {}).items()],
        money(F.sum("usage_quantity")).alias(usage),
        money(F.sum("estimated_cost")).alias(cost),
    )


def workspace_day(fact: DataFrame) -> DataFrame:
    """The sums per workspace and day, under the fact's own column names."""
    return rollup_cost(fact, ["usage_date", "workspace_id"], carry={"workspace_name": "workspace_name", "environment": "environment"})


def workspace_daily(fact: DataFrame) -> DataFrame:
    """One row per workspace and day with the change against its previous day."""
    daily = rollup_cost(
        fact, ["usage_date", "workspace_id"], "total_usage", "total_cost",
        carry={"workspace_name": "workspace_name", "environment": "environment"},
    )
    return period_change(
        daily, ["workspace_id"], "usage_date", "total_cost", "previous_day_cost", "cost_change", "cost_change_percentage"
    )


def workspace_monthly(fact: DataFrame) -> DataFrame:
    monthly = rollup_cost(
        fact, [F.date_format("usage_date", "yyyy-MM").alias("month"), "workspace_id"], "total_usage", "total_cost",
        carry={"workspace_name": "workspace_name"},
    )
    return period_change(
        monthly, ["workspace_id"], "month", "total_cost", "previous_month_cost", None, "month_over_month_percentage"
    )


def sku_daily(fact: DataFrame) -> DataFrame:
    return rollup_cost(fact, ["usage_date", "workspace_id", "sku"], not_null="sku")


def user_daily(fact: DataFrame) -> DataFrame:
    return rollup_cost(fact, ["usage_date", "workspace_id", F.col("user_id").alias("user_name")], not_null="user_id")


def job_daily(fact: DataFrame) -> DataFrame:
    return rollup_cost(fact, ["usage_date", "workspace_id", "job_id"], not_null="job_id", carry={"job_name": "job_name"})


def cluster_daily(fact: DataFrame) -> DataFrame:
    out = rollup_cost(fact, ["usage_date", "workspace_id", "cluster_id"], not_null="cluster_id")
    return out.withColumn("cluster_name", F.lit(None).cast("string"))


def audit_summary(audit: DataFrame) -> DataFrame:
    return audit.groupBy("event_date", "workspace_id", "action_name", "user_name").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count_if(F.col("response_status") >= 400).alias("failed_event_count"),
    )


BREAKDOWNS = {
    "product": "billing_origin_product", "business_unit": "business_unit", "cost_center": "cost_center",
    "environment": "environment", "region": "region", "warehouse": "warehouse_id", "department": "department",
}


def breakdowns(fact: DataFrame, by: dict[str, str] | None = None) -> DataFrame:
    """Cost by several single dimensions in one scan.

    The fact is first reduced by all dimensions together, then grouped per dimension set.
    """
    by = by or BREAKDOWNS
    base = rollup_cost(fact, list(by.values()))
    pairs = F.array(*[F.struct(F.lit(n).alias("dimension"), F.col(c).cast("string").alias("member")) for n, c in by.items()])
    flat = base.select(F.explode(pairs).alias("x"), "usage_quantity", "estimated_cost")
    return rollup_cost(
        flat.select("x.dimension", "x.member", "usage_quantity", "estimated_cost"), ["dimension", "member"]
    )
