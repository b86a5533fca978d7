"""Cost, usage and activity anomalies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.baseline import off_pattern, spike


def daily_spikes(fact: DataFrame) -> DataFrame:
    return spike(fact, ["workspace_id"], "usage_date", "estimated_cost", anomaly_type="daily_cost_spike",
                 metric="daily_cost", carry=["workspace_name"])


def sku_spikes(fact: DataFrame) -> DataFrame:
    return spike(fact, ["workspace_id", "sku"], "usage_date", "estimated_cost", anomaly_type="sku_spike",
                 metric="sku_daily_cost", carry=["workspace_name"])


def usage_spikes(fact: DataFrame) -> DataFrame:
    return spike(fact, ["workspace_id"], "usage_date", "usage_quantity", anomaly_type="usage_spike",
                 metric="daily_usage", carry=["workspace_name"])


# Resource column → anomaly type.
RESOURCES = {"job_id": "job_cost", "cluster_id": "cluster_cost", "warehouse_id": "warehouse_cost"}


def resource_spikes(fact: DataFrame, resource: str) -> DataFrame:
    kind = RESOURCES[resource]
    return spike(fact, ["workspace_id", resource], "usage_date", "estimated_cost", anomaly_type=kind, metric=kind)


def activity_spikes(audit: DataFrame) -> DataFrame:
    """Users with unusually many events on a day."""
    return spike(audit.withColumn("_one", F.lit(1)), ["user_name"], "event_date", "_one",
                 anomaly_type="user_activity", metric="daily_events")


def weekend_usage(fact: DataFrame) -> DataFrame:
    return off_pattern(fact, ["workspace_id"], "usage_date", "estimated_cost", F.dayofweek("usage_date").isin(1, 7),
                       anomaly_type="weekend_usage", metric="weekend_cost")


def after_hours(df: DataFrame, keys: list[str], ts: str, date: str, measure: str, first: int = 8, last: int = 18) -> DataFrame:
    """Measure outside ``first``:00 to ``last``:00 against the mean total inside."""
    off = ~F.hour(ts).between(first, last - 1)
    return off_pattern(df, keys, date, measure, off, anomaly_type="after_hours_usage", metric="after_hours_total")


# Detected again: numbers are refreshed, the triage status stays.
KEEP_STATUS = {
    "update": {
        c: (lambda c: lambda t, s: s(c))(c)
        for c in ("baseline_value", "actual_value", "deviation_percentage", "severity", "detected_timestamp")
    }
}


def anomaly_rows(*frames: DataFrame) -> DataFrame:
    """The common columns of several detectors."""
    cols = ["anomaly_id", "detection_date", "workspace_id", "anomaly_type", "metric", "baseline_value", "actual_value",
            "deviation_percentage", "severity", "status"]
    out = None
    for f in frames:
        one = f.select(*[c if c in f.columns else F.lit(None).cast("string").alias(c) for c in cols])
        out = one if out is None else out.unionByName(one)
    return out


def anomaly_summary(anomalies: DataFrame) -> DataFrame:
    rank = F.when(F.col("severity") == "Critical", 1).when(F.col("severity") == "High", 2).when(
        F.col("severity") == "Medium", 3).otherwise(4)
    return (
        anomalies.groupBy("severity")
        .agg(F.count(F.lit(1)).alias("anomaly_count"), F.sum(F.when(F.col("status") == "Open", 1).otherwise(0)).alias("open_count"))
        .orderBy(rank, "severity")
    )


def failed_activity(audit: DataFrame) -> DataFrame:
    """Failed events by user, address and action."""
    return (
        audit.filter(F.col("response_status") >= 400)
        .groupBy("user_name", "source_ip", "action_name")
        .agg(F.count(F.lit(1)).alias("failed_events"), F.max("event_time").alias("last_failure"))
    )
