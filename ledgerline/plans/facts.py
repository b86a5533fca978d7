"""Silver usage and the cost, audit and allocation facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.calc import QUANTITY, estimated_cost, money, surrogate_key, tag
from ledgerline.operators.joins import price_lookup

_METADATA = (
    "job_id", "cluster_id", "warehouse_id", "instance_pool_id", "node_type", "job_name", "job_run_id",
    "notebook_id", "notebook_path", "dlt_pipeline_id", "app_name",
)
_FEATURES = ("is_serverless", "is_photon", "serving_type", "jobs_tier", "sql_tier", "dlt_tier")

# The spellings of the tags that costs are allocated and filtered by.
TAGS = {"project": ("project", "Project"), "application": ("application", "app")}


def silver_usage(usage: DataFrame, workspace: DataFrame) -> DataFrame:
    """Flat usage records with workspace attributes."""
    w = workspace.select("workspace_id", "workspace_name", "environment", "region")
    j = usage.join(w, "workspace_id", "left")
    return j.select(
        "usage_date", "usage_start_time", "usage_end_time", "workspace_id", "workspace_name", "environment",
        "cloud", "region", F.col("sku_name").alias("sku"), "usage_unit", "usage_quantity", "record_type",
        "billing_origin_product",
        *[F.col(f"usage_metadata.{c}").alias(c) for c in _METADATA],
        F.col("identity_metadata.run_by").alias("user_id"),
        F.col("identity_metadata.run_as").alias("service_principal_id"),
        "custom_tags",
        F.struct(*[F.col(f"product_features.{c}").alias(c) for c in _FEATURES]).alias("product_features"),
        "usage_type", "record_id",
    )


def price_list(prices: DataFrame) -> DataFrame:
    """The applicable price of each period: the effective list price, else the list price."""
    return prices.select(
        "sku_name", "cloud", "price_start_time", "price_end_time",
        F.coalesce("pricing.effective_list.default", "pricing.default").cast(QUANTITY).alias("unit_price"),
        F.col("currency_code").alias("currency"),
    )


def cost_fact(silver: DataFrame, prices: DataFrame, workspace: DataFrame) -> DataFrame:
    """One cost row per usage row, priced by SKU, cloud and time. No price gives no cost."""
    priced = price_lookup(
        silver, price_list(prices), {"sku": "sku_name", "cloud": "cloud"}, "usage_start_time",
        "price_start_time", "price_end_time", ["unit_price", "currency"],
    )
    w = workspace.select("workspace_id", "cost_center", "business_unit", "department")
    j = priced.join(w, "workspace_id", "left")
    return j.select(
        F.col("record_id").alias("cost_id"),
        "usage_date", "usage_start_time", "usage_end_time", "workspace_id", "workspace_name", "sku", "usage_unit",
        "usage_quantity", "unit_price", "currency",
        estimated_cost(F.col("usage_quantity"), F.col("unit_price")).alias("estimated_cost"),
        "record_type", "billing_origin_product", "job_id", "job_name", "job_run_id", "cluster_id", "node_type",
        "warehouse_id", "user_id", "service_principal_id", "custom_tags", "cost_center", "environment",
        "business_unit", "department", "region", "cloud",
    )


def cost_summary(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("unit_price").isNull()).alias("missing_price"),
        money(F.sum("usage_quantity")).alias("total_usage"),
        money(F.sum("estimated_cost")).alias("total_estimated_cost"),
    )


def with_invoice(fact: DataFrame, invoices: DataFrame, keys: list[str]) -> DataFrame:
    """Estimated and invoiced amounts side by side; an absent invoice stays NULL."""
    est = fact.groupBy(*keys).agg(money(F.sum("estimated_cost")).alias("estimated_cost"))
    inv = invoices.groupBy(*keys).agg(money(F.sum("invoiced_amount")).alias("invoiced_amount"))
    return est.join(inv, keys, "left").withColumn(
        "difference", F.col("invoiced_amount") - F.col("estimated_cost")
    )


def user_kind(run_by: Column, run_as: Column) -> Column:
    """Principal when acting as somebody else; an unknown actor counts as a user."""
    return F.when(run_as.isNotNull() & (run_as != run_by), "servicePrincipal").otherwise("user")


def audit_fact(audit: DataFrame, workspace: DataFrame) -> DataFrame:
    """Flat audit events; ``audit_details`` keeps the whole source row as JSON."""
    payload = F.to_json(F.struct(*[c for c in audit.columns if not c.startswith("_")]))
    w = workspace.select("workspace_id", "workspace_name")
    j = audit.withColumn("audit_details", payload).join(w, "workspace_id", "left")
    params = F.col("request_params")

    def param(*names: str) -> Column:
        return tag(params, *names)

    return j.select(
        F.col("event_id").alias("audit_event_id"), "event_time", "event_date", "workspace_id", "workspace_name",
        F.coalesce(
            "user_identity.email", "user_identity.subject_name", "identity_metadata.run_by", "identity_metadata.run_as"
        ).alias("user_name"),
        user_kind(F.col("identity_metadata.run_by"), F.col("identity_metadata.run_as")).alias("user_type"),
        F.col("identity_metadata.run_as").alias("service_principal"),
        "action_name", "service_name", "request_id", F.col("source_ip_address").alias("source_ip"), "user_agent",
        param("object_type").alias("object_type"),
        param("object_id").alias("object_id"),
        param("object_name", "name").alias("object_name"),
        F.col("response.status_code").alias("response_status"),
        F.col("response.error_message").alias("response_error"),
        "audit_level", F.col("request_params").alias("request_parameters"), "audit_details",
    )


ALLOCATION_KEYS = [
    "usage_date", "workspace_id", "workspace_name", "cost_center", "business_unit", "department", "environment",
    "cloud", "sku",
]


def allocate(fact: DataFrame, tag_map: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Cost by workspace attributes and, with ``tag_map``, by tags (column → tag spellings).

    ``tag_source`` tells whether any tag was found; the id covers all grouping columns.
    """
    tag_cols = {c: tag(F.col("custom_tags"), *names) for c, names in (tag_map or {}).items()}
    if tag_cols:
        found = F.coalesce(*tag_cols.values()).isNotNull()
    else:
        found = F.lit(False)
    df = fact.withColumns({**tag_cols, "tag_source": F.when(found, "custom_tags").otherwise("workspace_metadata")})
    keys = [*ALLOCATION_KEYS, *tag_cols, "tag_source"]
    out = df.groupBy(*keys).agg(
        money(F.sum("usage_quantity")).alias("usage_quantity"), money(F.sum("estimated_cost")).alias("estimated_cost")
    )
    for c in ("project", "application"):
        if c not in tag_cols:
            out = out.withColumn(c, F.lit(None).cast("string"))
    return out.withColumn("allocation_id", surrogate_key(*keys)).withColumnRenamed("usage_date", "allocation_date")
