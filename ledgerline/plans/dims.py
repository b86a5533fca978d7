"""Dimensions: calendar, environment, workspace, SKU, user."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.merge import dedup_latest

# Bounds of the calendar and the environments.
CALENDAR_FROM = dt.date(2020, 1, 1)
CALENDAR_TO = dt.date(2030, 12, 31)
ENVIRONMENTS = [
    ("DEV", "Development environment for experimentation and testing"),
    ("TEST", "Quality assurance and integration testing"),
    ("UAT", "User acceptance testing"),
    ("PROD", "Production environment"),
]


def calendar(
    spark: SparkSession,
    start: dt.date = CALENDAR_FROM,
    end: dt.date = CALENDAR_TO,
    fiscal_start_month: int = 1,
) -> DataFrame:
    """One row per day. The fiscal year carries the number of the year it ends in."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("date"))
    d = F.col("date")
    fiscal = F.add_months(d, (13 - fiscal_start_month) % 12)
    return days.select(
        d,
        F.dayofmonth(d).alias("day"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        F.year(fiscal).alias("fiscal_year"),
        F.month(fiscal).alias("fiscal_month"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        (F.dayofmonth(d) == 1).alias("is_month_start"),
        (d == F.last_day(d)).alias("is_month_end"),
    )


def environments(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ENVIRONMENTS, "environment string, description string")


def _occurring(rows: DataFrame, key: str) -> DataFrame:
    """Each row once. Each task finds them by hashes, where the largest text of a key would have all its rows sorted.

    They are dealt by the key, without which Spark would leave the step out before such an aggregate.
    """
    return rows.distinct().repartition(key)


def discovered_workspaces(usage: DataFrame, audit: DataFrame) -> DataFrame:
    """Workspaces seen in usage or audit, one row each; attributes are the largest present value."""
    u = usage.select("workspace_id", "account_id", "cloud")
    a = audit.filter("workspace_id <> '0'").select("workspace_id", "account_id", F.lit(None).cast("string").alias("cloud"))
    seen = _occurring(u.unionByName(a).filter("workspace_id IS NOT NULL"), "workspace_id").groupBy("workspace_id")
    return seen.agg(F.max("account_id").alias("account_id"), F.max("cloud").alias("cloud")).withColumn(
        "status", F.lit("Active")
    )


# Refresh of known workspaces: only active ones, and only where the discovery has a value.
WORKSPACE_REFRESH = {
    "when_matched": lambda t, s: t("status") == "Active",
    "update": {
        "cloud": lambda t, s: F.coalesce(s("cloud"), t("cloud")),
        "account_id": lambda t, s: F.coalesce(s("account_id"), t("account_id")),
    },
}


def skus(usage: DataFrame) -> DataFrame:
    """One row per SKU with the largest product, cloud and unit seen."""
    return (
        _occurring(usage.filter("sku_name IS NOT NULL").select("sku_name", "billing_origin_product", "cloud", "usage_unit"), "sku_name")
        .groupBy(F.col("sku_name").alias("sku"))
        .agg(
            F.max("billing_origin_product").alias("product"),
            F.max("billing_origin_product").alias("billing_origin_product"),
            F.max("cloud").alias("cloud"),
            F.max("usage_unit").alias("usage_unit"),
        )
        .withColumn("description", F.lit(None).cast("string"))
    )


def billing_users(usage: DataFrame) -> DataFrame:
    """Acting users and service principals of usage; an id seen as both is a principal."""
    ids = usage.select(
        F.explode(
            F.array(
                F.struct(F.col("identity_metadata.run_by").alias("id"), F.lit("user").alias("kind")),
                F.struct(F.col("identity_metadata.run_as").alias("id"), F.lit("servicePrincipal").alias("kind")),
            )
        ).alias("x")
    )
    people = _occurring(ids.filter("x.id IS NOT NULL").select(F.col("x.id").alias("user_id"), F.col("x.kind").alias("kind")), "user_id")
    # 'servicePrincipal' sorts before 'user'.
    return _user_row(people.groupBy("user_id").agg(F.min("kind").alias("user_type")), F.lit(None).cast("string"))


def audit_users(audit: DataFrame) -> DataFrame:
    """E-mail identities of audit events, with the largest display name."""
    seen = audit.select(
        F.col("user_identity.email").alias("user_id"), F.col("user_identity.subject_name").alias("user_name")
    ).filter("user_id IS NOT NULL")
    one = _occurring(seen, "user_id").groupBy("user_id").agg(F.max("user_name").alias("user_name")).withColumn("user_type", F.lit("user"))
    return _user_row(one, F.col("user_name"))


def _user_row(df: DataFrame, name) -> DataFrame:
    empty = F.lit(None).cast("string")
    return df.select(
        "user_id",
        name.alias("user_name"),
        F.col("user_id").alias("email"),
        "user_type",
        empty.alias("department"),
        empty.alias("business_unit"),
        F.lit("Active").alias("status"),
    )


def latest_workspace(df: DataFrame) -> DataFrame:
    """Newest row per workspace of a master feed."""
    return dedup_latest(df, ["workspace_id"], [F.desc("_ingestion_timestamp"), F.desc("workspace_name")])
