"""The driver tables seen as usage, price, audit and workspace sources.

Only the joins that the wanted columns need are made: a usage frame without users never reads
orders. All derived attributes are plain expressions on the keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.calc import QUANTITY

ALL_PARTS = ("sku", "workspace", "user")


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def _cloud(key: Column) -> Column:
    return F.element_at(F.array(F.lit("AWS"), F.lit("AZURE"), F.lit("GCP")), (key % 3 + 1).cast("int"))


def workspaces(spark: SparkSession, root: str) -> DataFrame:
    """nation joined with region."""
    n, r = table(spark, root, "nation"), table(spark, root, "region")
    k = F.col("n_nationkey")
    env = F.element_at(F.array(*[F.lit(e) for e in ("DEV", "TEST", "UAT", "PROD")]), (k % 4 + 1).cast("int"))
    return n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
        k.cast("string").alias("workspace_id"),
        F.when(k % 8 != 7, F.col("n_name")).alias("workspace_name"),
        F.lit(None).cast("string").alias("workspace_url"),
        F.lit("acct").alias("account_id"),
        _cloud(k).alias("cloud"),
        F.col("r_name").alias("region"),
        env.alias("environment"),
        F.concat(F.lit("BU"), k % 5).alias("business_unit"),
        F.concat(F.lit("DEP"), k % 6).alias("department"),
        F.when(k % 10 != 9, F.concat(F.lit("CC"), k % 7)).alias("cost_center"),
        F.concat(F.lit("owner"), k % 5).alias("owner"),
        F.when(k == 24, "Inactive").otherwise("Active").alias("status"),
        F.lit(None).cast("date").alias("created_date"),
    )


def usage(spark: SparkSession, root: str, parts=ALL_PARTS) -> DataFrame:
    """lineitem as usage records, with sku from part, workspace from supplier, user from orders."""
    u = table(spark, root, "lineitem")
    sku = workspace = cloud = user = F.lit(None).cast("string")
    # The largest table first: what the others add is then not shuffled with the rows.
    if "user" in parts:
        o = table(spark, root, "orders").select("o_orderkey", "o_custkey")
        u = u.join(o, u.l_orderkey == o.o_orderkey, "left")
        user = F.when(F.col("l_linenumber") != 7, F.concat(F.lit("user"), F.col("o_custkey") % 200))
    if "sku" in parts:
        p = table(spark, root, "part").select("p_partkey", "p_type", "p_brand")
        u, sku = u.join(p, u.l_partkey == p.p_partkey, "left"), F.col("p_type")
    if "workspace" in parts:
        s = table(spark, root, "supplier").select("s_suppkey", "s_nationkey")
        u, workspace = u.join(s, u.l_suppkey == s.s_suppkey, "left"), F.col("s_nationkey").cast("string")
        cloud = _cloud(F.col("s_nationkey"))
    order = F.col("l_orderkey")
    null = F.lit(None).cast("string")
    job = F.when(order % 4 == 0, F.concat(F.lit("job"), F.col("l_partkey") % 50))
    brand = F.col("p_brand") if "sku" in parts else null
    tags = F.when(F.col("l_partkey") % 3 == 0, F.create_map(F.lit("project"), brand, F.lit("owner"), F.col("l_returnflag")))
    start = F.col("l_shipdate")
    return u.select(
        F.lit("acct").alias("account_id"),
        workspace.alias("workspace_id"),
        F.concat_ws("-", order.cast("string"), F.col("l_linenumber").cast("string")).alias("record_id"),
        sku.alias("sku_name"),
        cloud.alias("cloud"),
        start.alias("usage_start_time"),
        (start + F.expr("INTERVAL 1 HOUR")).alias("usage_end_time"),
        start.cast("date").alias("usage_date"),
        tags.alias("custom_tags"),
        F.lit("UNIT").alias("usage_unit"),
        F.col("l_quantity").cast(QUANTITY).alias("usage_quantity"),
        F.struct(
            F.when(order % 4 == 1, F.concat(F.lit("cl"), F.col("l_suppkey") % 20)).alias("cluster_id"),
            job.alias("job_id"),
            F.when(order % 4 == 2, F.concat(F.lit("wh"), F.col("l_suppkey") % 7)).alias("warehouse_id"),
            null.alias("instance_pool_id"),
            F.concat(F.lit("node"), F.col("l_linenumber")).alias("node_type"),
            F.concat(job, F.lit("-name")).alias("job_name"),
            F.when(job.isNotNull(), order.cast("string")).alias("job_run_id"),
            null.alias("notebook_id"),
            null.alias("notebook_path"),
            null.alias("dlt_pipeline_id"),
            null.alias("app_name"),
        ).alias("usage_metadata"),
        F.struct(
            F.when(F.col("l_returnflag") == "R", F.concat(F.lit("sp"), F.col("l_suppkey") % 10)).alias("run_as"),
            null.alias("created_by"),
            null.alias("owned_by"),
            user.alias("run_by"),
        ).alias("identity_metadata"),
        F.lit("ORIGINAL").alias("record_type"),
        start.cast("date").alias("ingestion_date"),
        F.col("l_linestatus").alias("billing_origin_product"),
        F.struct(
            (F.col("l_linestatus") == "O").alias("is_serverless"),
            F.lit(None).cast("boolean").alias("is_photon"),
            null.alias("serving_type"),
            null.alias("jobs_tier"),
            null.alias("sql_tier"),
            null.alias("dlt_tier"),
        ).alias("product_features"),
        F.lit("COMPUTE").alias("usage_type"),
    )


def prices(spark: SparkSession, root: str) -> DataFrame:
    """One price period per part type, cloud and year; the first type has none for 1996."""
    p = table(spark, root, "part").groupBy("p_type").agg(F.min("p_size").alias("size"))
    first = p.agg(F.min("p_type")).scalar()
    p = p.withColumn("_first", first)
    grid = p.select("p_type", "size", "_first", F.explode(F.sequence(F.lit(1995), F.lit(2001))).alias("year")).select(
        "*", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("k")
    )
    grid = grid.filter(~((F.col("p_type") == F.col("_first")) & (F.col("year") == 1996)))
    price = F.round((100 + F.col("size") + 3 * (F.col("year") - 1995) + F.col("k")) / 1000, 3).cast(QUANTITY)
    none = F.lit(None).cast(QUANTITY)
    return grid.select(
        F.lit("acct").alias("account_id"),
        F.make_timestamp_ntz(F.col("year"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("price_start_time"),
        F.when(
            F.col("year") < 2001,
            F.make_timestamp_ntz(F.col("year") + 1, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)),
        ).alias("price_end_time"),
        F.col("p_type").alias("sku_name"),
        _cloud(F.col("k")).alias("cloud"),
        F.lit("USD").alias("currency_code"),
        F.lit("UNIT").alias("usage_unit"),
        F.struct(
            price.alias("default"),
            F.struct(none.alias("default")).alias("promotional"),
            F.struct(F.when(F.col("k") != 2, price).alias("default")).alias("effective_list"),
        ).alias("pricing"),
    )


def audit(spark: SparkSession, root: str) -> DataFrame:
    """events as audit records."""
    e = table(spark, root, "events")
    u = F.col("user_id")
    text = u.cast("string")
    return e.select(
        F.lit("acct").alias("account_id"),
        (u % 25).cast("string").alias("workspace_id"),
        F.lit("1").alias("version"),
        F.col("ts").alias("event_time"),
        F.col("ts").cast("date").alias("event_date"),
        F.concat(F.lit("10.0."), u % 4, F.lit("."), u % 50).alias("source_ip_address"),
        F.lit("client").alias("user_agent"),
        F.lit(None).cast("string").alias("session_id"),
        F.struct(
            F.when(u % 10 != 3, F.concat(F.lit("user"), text, F.lit("@corp.test"))).alias("email"),
            F.when((u % 10 == 3) & (u % 20 != 3), F.concat(F.lit("subject"), text)).alias("subject_name"),
        ).alias("user_identity"),
        F.lit("service").alias("service_name"),
        F.col("event_type").alias("action_name"),
        F.concat(F.lit("rq"), F.col("event_id")).alias("request_id"),
        F.from_json("props", "map<string,string>").alias("request_params"),
        F.struct(
            F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status_code"),
            F.when(F.col("event_type") == "error", "failed").alias("error_message"),
            F.lit(None).cast("string").alias("result"),
        ).alias("response"),
        F.when(u % 25 == 0, "ACCOUNT").otherwise("WORKSPACE").alias("audit_level"),
        F.col("event_id").cast("string").alias("event_id"),
        F.struct(
            F.when(u % 11 != 0, F.concat(F.lit("user"), text)).alias("run_by"),
            F.when(u % 7 == 0, F.concat(F.lit("sp"), text)).when(u % 7 < 4, F.concat(F.lit("user"), text)).alias("run_as"),
        ).alias("identity_metadata"),
        F.col("value").alias("_value"),
    )
