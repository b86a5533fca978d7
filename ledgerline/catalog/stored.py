"""Queries over written tables: merges, versions, loads, layers, layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.catalog.registry import DATE, NOW, D, TS, Inputs, query, using
from ledgerline.operators import layout
from ledgerline.operators.merge import action_counts, change_feed, deactivate_missing, dedup_latest, insert_missing, update_where, upsert
from ledgerline.plans.daily import DailyBatch, Sources
from ledgerline.plans.medallion import control_frame, demo_control, run_medallion
from ledgerline.sources import files, watermarks
from ledgerline.sources.tables import Lake, upsert_partitions, write_rows

# The first load ends where the second has long begun: the overlap is updated, the rest inserted.
FIRST_END, SECOND_START = "2000-07-01", "2000-01-01"
_SHOW = f"o_orderkey, o_custkey, o_orderstatus, o_totalprice, {DATE('o_orderdate')} AS o_orderdate"


def _first(i: Inputs) -> DataFrame:
    return i.table("orders").filter(F.col("o_orderdate") < FIRST_END)


def _second(i: Inputs) -> DataFrame:
    late = i.table("orders").filter(F.col("o_orderdate") >= SECOND_START)
    return late.withColumns({"o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") + 1})


def _shown(df: DataFrame) -> DataFrame:
    return df.select("o_orderkey", "o_custkey", "o_orderstatus", F.round("o_totalprice", 2).alias("o_totalprice"),
                     F.col("o_orderdate").cast("date").alias("o_orderdate"))


_MERGED = f"""merged AS (
  SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate >= DATE '{SECOND_START}' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
         ROUND(o_totalprice + CASE WHEN o_orderdate >= DATE '{SECOND_START}' THEN 1 ELSE 0 END, 2) AS o_totalprice, o_orderdate,
         CASE WHEN o_orderdate >= DATE '{FIRST_END}' THEN 'insert' WHEN o_orderdate >= DATE '{SECOND_START}' THEN 'update' ELSE 'keep' END AS act
  FROM orders)"""


@query("upsert_orders", f"WITH {_MERGED} SELECT {_SHOW} FROM merged")
def _(i: Inputs) -> DataFrame:
    lake = i.lake()
    lake.overwrite("silver/orders", _first(i))
    lake.merge("silver/orders", _second(i), ["o_orderkey"])
    return _shown(lake.read("silver/orders"))


@query("merge_metrics", f"""WITH {_MERGED} SELECT COUNT(*) FILTER (WHERE act = 'insert') AS inserted,
  COUNT(*) FILTER (WHERE act = 'update') AS updated, COUNT(*) FILTER (WHERE act = 'keep') AS unchanged FROM merged""")
def _(i: Inputs) -> DataFrame:
    return action_counts(upsert(_first(i), _second(i), ["o_orderkey"]))


@query("upsert_conditional", f"""
SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate >= DATE '{FIRST_END}' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
       ROUND(CASE WHEN o_orderdate >= DATE '{FIRST_END}' OR (o_orderdate >= DATE '{SECOND_START}' AND o_orderstatus = 'P')
                  THEN o_totalprice + 1 ELSE o_totalprice END, 2) AS o_totalprice, {DATE('o_orderdate')} AS o_orderdate FROM orders""")
def _(i: Inputs) -> DataFrame:
    out = upsert(_first(i), _second(i), ["o_orderkey"], when_matched=lambda t, s: t("o_orderstatus") == "P",
                 update={"o_totalprice": lambda t, s: F.coalesce(s("o_totalprice"), t("o_totalprice"))})
    return _shown(out)


@query("upsert_null_keys", """
SELECT event_date, workspace_id, user_name, CAST(SUM(n) AS BIGINT) AS event_count FROM (
  SELECT strftime(ts, '%Y-%m-%d') AS event_date, CAST(user_id % 25 AS VARCHAR) AS workspace_id,
         CASE WHEN user_id % 10 <> 3 THEN 'user' || user_id END AS user_name, 1 AS n FROM events) GROUP BY 1, 2, 3""")
def _(i: Inputs) -> DataFrame:
    """Running the same load twice leaves one row per key, also where a key column is NULL."""
    e = i.table("events").select(
        F.col("ts").cast("date").alias("event_date"), (F.col("user_id") % 25).cast("string").alias("workspace_id"),
        F.when(F.col("user_id") % 10 != 3, F.concat(F.lit("user"), F.col("user_id"))).alias("user_name"))
    keys = ["event_date", "workspace_id", "user_name"]
    rows = e.groupBy(*keys).agg(F.count(F.lit(1)).alias("event_count"))
    return upsert(rows, rows, keys).drop("_action")


@query("insert_missing", f"""
SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate >= DATE '{FIRST_END}' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
       ROUND(o_totalprice + CASE WHEN o_orderdate >= DATE '{FIRST_END}' THEN 1 ELSE 0 END, 2) AS o_totalprice,
       {DATE('o_orderdate')} AS o_orderdate FROM orders""")
def _(i: Inputs) -> DataFrame:
    return _shown(insert_missing(_first(i), _second(i), ["o_orderkey"]))


@query("change_feed", f"""
WITH old AS (SELECT o_orderkey, o_orderstatus, ROUND(o_totalprice, 2) AS p FROM orders WHERE o_orderdate < DATE '{FIRST_END}'),
new AS (SELECT o_orderkey, 'X' AS o_orderstatus, ROUND(o_totalprice + 1, 2) AS p FROM orders WHERE o_orderdate >= DATE '{SECOND_START}'
        UNION ALL SELECT o_orderkey, o_orderstatus, ROUND(o_totalprice, 2) FROM orders
        WHERE o_orderdate < DATE '{SECOND_START}' AND o_orderpriority <> '5-LOW')
SELECT o_orderkey, n.o_orderstatus, n.p AS o_totalprice, 'insert' AS change_type FROM new n ANTI JOIN old USING (o_orderkey)
UNION ALL SELECT o_orderkey, o.o_orderstatus, o.p, 'delete' FROM old o ANTI JOIN new USING (o_orderkey)
UNION ALL SELECT o_orderkey, o.o_orderstatus, o.p, 'update_preimage' FROM old o JOIN new n USING (o_orderkey) WHERE n.p <> o.p OR n.o_orderstatus <> o.o_orderstatus
UNION ALL SELECT o_orderkey, n.o_orderstatus, n.p, 'update_postimage' FROM old o JOIN new n USING (o_orderkey) WHERE n.p <> o.p OR n.o_orderstatus <> o.o_orderstatus""")
def _(i: Inputs) -> DataFrame:
    lake, name = i.lake(), "silver/orders"
    cols = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    lake.overwrite(name, _first(i).select(cols))
    lake.merge(name, _second(i).select(cols), ["o_orderkey"])
    kept = ~((F.col("o_orderdate") < SECOND_START) & (F.col("o_orderpriority") == "5-LOW"))
    lake.overwrite(name, lake.read(name).filter(kept))
    feed = change_feed(lake.read(name, version=0), lake.read(name), ["o_orderkey"])
    return feed.select("o_orderkey", "o_orderstatus", F.round("o_totalprice", 2).alias("o_totalprice"), F.col("_change_type").alias("change_type"))


@query("time_travel", f"""WITH {_MERGED}
SELECT 0 AS version, o_orderstatus, COUNT(*) AS n FROM orders WHERE o_orderdate < DATE '{FIRST_END}' GROUP BY 2
UNION ALL SELECT 1, o_orderstatus, COUNT(*) FROM merged GROUP BY 2
UNION ALL SELECT 2, o_orderstatus, COUNT(*) FROM merged GROUP BY 2
UNION ALL SELECT 99, o_orderstatus, COUNT(*) FROM orders WHERE o_orderdate < DATE '{FIRST_END}' GROUP BY 2""")
def _(i: Inputs) -> DataFrame:
    lake, name = i.lake(), "silver/orders"
    lake.overwrite(name, _first(i))
    lake.merge(name, _second(i), ["o_orderkey"])
    lake.overwrite(name, update_where(lake.read(name), F.col("o_orderstatus") == "X", {"o_totalprice": F.lit(0.0)}))
    lake.clone(name, "silver/orders_copy", version=0)
    frames = [(v, lake.read(name, version=v)) for v in range(3)] + [(99, lake.read("silver/orders_copy"))]
    out = None
    for v, df in frames:
        one = df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")).withColumn("version", F.lit(v))
        out = one if out is None else out.unionByName(one)
    return out


@query("table_history", f"""WITH {_MERGED}
SELECT 0 AS version, 'overwrite' AS operation, NULL AS inserted, NULL AS updated
UNION ALL SELECT 1, 'merge', COUNT(*) FILTER (WHERE act = 'insert'), COUNT(*) FILTER (WHERE act = 'update') FROM merged
UNION ALL SELECT 2, 'append', NULL, NULL""")
def _(i: Inputs) -> DataFrame:
    lake, name = i.lake(), "silver/orders"
    lake.overwrite(name, _first(i))
    lake.merge(name, _second(i), ["o_orderkey"])
    lake.append(name, lake.read(name).limit(0))
    m = F.col("metrics")
    return lake.history(name).select(F.col("version").cast("int").alias("version"), "operation", m["inserted"].alias("inserted"), m["updated"].alias("updated"))


@query("deactivate_missing", """
SELECT c_custkey, c_mktsegment, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders) THEN 'Active' ELSE 'Inactive' END AS status FROM customer""")
def _(i: Inputs) -> DataFrame:
    dim = i.table("customer").select("c_custkey", "c_mktsegment", F.lit("Active").alias("status"))
    return deactivate_missing(dim, i.table("orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("partition_upsert", f"WITH {_MERGED} SELECT {_SHOW} FROM merged")
def _(i: Inputs) -> DataFrame:
    path = i.folder("fact") + "/orders"
    year = F.year("o_orderdate").alias("order_year")
    upsert_partitions(i.spark, path, _first(i).select("*", year), ["o_orderkey"], "order_year")
    upsert_partitions(i.spark, path, _second(i).select("*", year), ["o_orderkey"], "order_year")
    return _shown(i.spark.read.parquet(path))


@query("clustered_layout", "\nUNION ALL ".join(
    f"SELECT '{n}' AS layout, COUNT(*) AS n, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, TRUE AS files_are_narrow FROM orders"
    for n in ("range", "z")))
def _(i: Inputs) -> DataFrame:
    """Both layouts keep all rows, and on average a file spans at most three quarters of the customers."""
    lake, o = i.lake(), i.table("orders")
    lake.overwrite("silver/range", layout.cluster_rewrite(o, ["o_custkey", "o_orderdate"], 8))
    lake.overwrite("silver/z", layout.zorder_rewrite(o, ["o_custkey", "o_totalprice"], 16))
    out = None
    for name in ("range", "z"):
        df = lake.read(f"silver/{name}")
        price = F.col("o_totalprice").cast("decimal(18,2)")
        per_file = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(price).alias("s"), F.min("o_custkey").alias("lo"), F.max("o_custkey").alias("hi"))
        one = per_file.agg(
            F.lit(name).alias("layout"), F.sum("n").alias("n"), F.sum("s").alias("total"),
            (F.avg(F.col("hi") - F.col("lo")) <= (F.max("hi") - F.min("lo")) * 0.75).alias("files_are_narrow"))
        out = one if out is None else out.unionByName(one)
    return out


# --- loads ----------------------------------------------------------------------------------

_BY_DAY = f"SELECT event_type, {DATE('ts')} AS day, COUNT(*) AS n, ROUND(SUM(value), 4) AS total FROM events GROUP BY 1, 2"


def _by_day(df: DataFrame) -> DataFrame:
    return df.groupBy("event_type", F.col("ts").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


def _load(lake: Lake, src: DataFrame, lookback: int) -> dict:
    mark = watermarks.read_watermark(lake, "load", "events")
    new = files.with_lineage(watermarks.incremental_scan(src, "ts", mark, lookback), "events", "b", NOW)
    done = lake.merge("bronze/events", new, ["event_id"])
    top = lake.read("bronze/events").agg(F.max("ts").cast("string")).first()[0]
    watermarks.advance_watermark(lake, "load", "events", "ts", top, NOW)
    return done


@query("incremental_load", _BY_DAY)
def _(i: Inputs) -> DataFrame:
    """Two loads by watermark, then a third that finds nothing new."""
    lake, e = i.lake(), i.table("events")
    _load(lake, e.filter(F.col("ts") < "2024-01-12"), 0)
    _load(lake, e, 0)
    _load(lake, e, 0)
    return _by_day(lake.read("bronze/events"))


@query("late_arrivals", _BY_DAY)
def _(i: Inputs) -> DataFrame:
    """Purchases arrive days late; a lookback of a month brings them in, without duplicates."""
    lake, e = i.lake(), i.table("events")
    _load(lake, e.filter("event_type <> 'purchase'"), 0)
    _load(lake, e, 31)
    return _by_day(lake.read("bronze/events"))


@query("copy_into", "SELECT o_orderpriority, COUNT(*) AS n, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY 1")
def _(i: Inputs) -> DataFrame:
    """Files arrive in two lots; loading four times takes each file once."""
    lake, src = i.lake(), i.folder("landing") + "/orders"
    o = i.table("orders").select("o_orderkey", "o_orderpriority", "o_totalprice", "o_orderdate")
    for lot in (o.filter(F.col("o_orderdate") < SECOND_START), o.filter(F.col("o_orderdate") >= SECOND_START)):
        lot.write.mode("append").json(src)
        files.copy_into(lake, "bronze/orders", "json", src)
        files.copy_into(lake, "bronze/orders", "json", src)
    return lake.read("bronze/orders").groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"))


@query("daily_run", using("cost", "audit") + """,
one AS (SELECT DISTINCT record_id, usage_date FROM usage)
SELECT 'usage' AS table_name, COUNT(*) AS row_count FROM one
UNION ALL SELECT 'cost', COUNT(*) FROM one
UNION ALL SELECT 'audit', COUNT(*) FROM audit
UNION ALL SELECT 'prices', COUNT(*) FROM price
UNION ALL SELECT 'workspaces', COUNT(*) FROM (SELECT workspace_id FROM usage UNION SELECT workspace_id FROM audit WHERE workspace_id <> '0')
UNION ALL SELECT 'skus', COUNT(DISTINCT sku) FROM usage
UNION ALL SELECT 'steps', 10""")
def _(i: Inputs) -> DataFrame:
    """The whole batch over all usage, prices and audit events."""
    lake = i.lake()
    sources = Sources(i.usage(), i.prices, i.audit_raw.drop("_value"))
    DailyBatch(lake, sources, NOW, grain="year", first="1990-01-01 00:00:00").run()
    facts = {"usage": "bronze_billing_usage", "cost": "fact_cost", "audit": "fact_audit_event"}
    frames = {n: i.spark.read.parquet(f"{lake.root}/facts/{t}") for n, t in facts.items()}
    frames |= {n: lake.read(t) for n, t in {
        "prices": "bronze/bronze_billing_prices", "workspaces": "dims/dim_workspace",
        "skus": "dims/dim_sku", "steps": "meta/framework_execution_log"}.items()}
    out = None
    for n, df in frames.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).withColumn("table_name", F.lit(n))
        out = one if out is None else out.unionByName(one)
    return out


_STEPS = ("usage", "prices", "audit", "dimensions", "cost")
#: The record that the batch keeps of several with one id (and date).
_KEPT = "QUALIFY ROW_NUMBER() OVER (PARTITION BY {} ORDER BY usage_start_time DESC, workspace_id DESC, sku DESC, cloud DESC, usage_quantity DESC) = 1"


def _doubled(prices: DataFrame) -> DataFrame:
    kind = prices.schema["pricing"].dataType["default"].dataType
    twice = lambda c: (F.col(c) * 2).cast(kind)
    pricing = F.col("pricing").withField("default", twice("pricing.default"))
    return prices.withColumn("pricing", pricing.withField("effective_list.default", twice("pricing.effective_list.default")))


@query("reprice_after_failure", using("cost") + f""",
one AS (SELECT * FROM cost {_KEPT.format('record_id, usage_date')})
SELECT year(usage_date) AS usage_year, COUNT(*) AS records, {D('SUM(2 * estimated_cost)')} AS total_cost FROM one GROUP BY 1""")
def _(i: Inputs) -> DataFrame:
    """All prices change in a run that dies before costs; the next run, which sees no change, makes up for it."""
    lake, usage, audit = i.lake(), i.usage(), i.audit_raw.drop("_value")
    batch = lambda prices: DailyBatch(lake, Sources(usage, prices, audit), NOW, grain="year", first="1990-01-01 00:00:00")
    batch(i.prices).run(_STEPS)
    dies = batch(_doubled(i.prices))
    dies.cost = lambda: 1 / 0
    try:
        dies.run(_STEPS)
    except ZeroDivisionError:
        pass
    batch(_doubled(i.prices)).run(_STEPS)
    cost = i.spark.read.parquet(f"{lake.root}/facts/fact_cost")
    return cost.groupBy(F.year("usage_date").alias("usage_year")).agg(F.count(F.lit(1)).alias("records"), F.sum("estimated_cost").alias("total_cost"))


_CORRECTED = "CAST(split_part(record_id, '-', 1) AS BIGINT) % 7 = 0"


@query("moved_record", using("workspace", "usage", "price") + f""",
one AS (SELECT * FROM usage {_KEPT.format('record_id')}),
placed AS (SELECT *, CASE WHEN {_CORRECTED} THEN usage_start_time + INTERVAL 400 DAY ELSE usage_start_time END AS start FROM one)
SELECT year(start) AS usage_year, COUNT(*) AS records, {D("SUM(usage_quantity)")} AS quantity, COUNT(*) AS costs, {D('SUM(usage_quantity * unit_price)')} AS total_cost
FROM placed LEFT JOIN price p ON p.sku = placed.sku AND p.cloud = placed.cloud AND start >= valid_from AND (valid_to IS NULL OR start < valid_to) GROUP BY 1""")
def _(i: Inputs) -> DataFrame:
    """Every seventh order's records get another date, mostly in another partition; each is there once, in all layers."""
    # Both runs read all rows: joins and parsing are done once, and the runs read the files where they lie.
    lake, usage, audit = i.lake(), write_rows(i.usage(), i.folder("usage")), write_rows(i.audit_raw.drop("_value"), i.folder("audit"))
    corrected = F.substring_index("record_id", "-", 1).cast("long") % 7 == 0
    later = lambda c: F.when(corrected, F.col(c) + F.expr("INTERVAL 400 DAYS")).otherwise(F.col(c)).cast(usage.schema[c].dataType)
    second = usage.withColumns({c: later(c) for c in ("usage_start_time", "usage_end_time", "usage_date", "ingestion_date")})
    for source in (usage, second):
        # Corrections keep their old times as marks, so all rows are looked at again.
        sources = Sources(source, i.prices, audit, stored=["usage", "audit"])
        DailyBatch(lake, sources, NOW, grain="year", first="1990-01-01 00:00:00", lookback_days=20_000, moves=True).run(_STEPS)
    year = F.year("usage_date").alias("usage_year")
    bronze, cost = (i.spark.read.parquet(f"{lake.root}/facts/{t}") for t in ("bronze_billing_usage", "fact_cost"))
    bronze = bronze.groupBy(year).agg(F.count(F.lit(1)).alias("records"), F.sum("usage_quantity").alias("quantity"))
    cost = cost.groupBy(year).agg(F.count(F.lit(1)).alias("costs"), F.sum("estimated_cost").alias("total_cost"))
    return bronze.join(cost, "usage_year", "full")


# --- control-table layers -------------------------------------------------------------------


def _layers(i: Inputs) -> tuple[Lake, DataFrame]:
    """Dirty text versions of customer, orders and part go through all layers."""
    lake, landing = i.lake(), i.folder("landing")
    pad = lambda c: F.concat(F.lit("  "), c, F.lit(" "))
    c, n, o, p = i.table("customer"), i.table("nation"), i.table("orders"), i.table("part")
    files.land(c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").alias("customer_id"), pad(F.lower("c_name")).alias("customer_name"),
        pad(F.concat(F.lit("C"), F.col("c_custkey"), F.lit("@Example.COM"))).alias("email"), pad(F.col("c_mktsegment")).alias("city"),
        pad(F.col("n_name")).alias("country"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("c_custkey") % 1000).cast("int")).cast("string").alias("signup_date"),
    ), landing, "customers")
    files.land(o.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), F.lit(1).alias("product_id"),
        F.col("o_orderdate").cast("date").cast("string").alias("order_date"), F.lit(2).alias("quantity"),
        F.when(F.col("o_orderpriority") == "5-LOW", "unknown").otherwise(F.col("o_totalprice").cast("string")).alias("amount"),
        pad(F.lower("o_orderstatus")).alias("status"),
    ), landing, "orders")
    files.land(p.select(
        F.col("p_partkey").alias("product_id"), pad(F.col("p_name")).alias("product_name"), pad(F.col("p_type")).alias("category"),
        F.col("p_retailprice").cast("string").alias("price"),
    ), landing, "products")
    return lake, run_medallion(lake, control_frame(i.spark, demo_control()), landing, NOW)


@query("medallion_counts", """
SELECT 'bronze' AS layer, 'bronze/customers' AS table_name, COUNT(*) AS row_count FROM customer
UNION ALL SELECT 'bronze', 'bronze/orders', COUNT(*) FROM orders
UNION ALL SELECT 'bronze', 'bronze/products', COUNT(*) FROM part
UNION ALL SELECT 'silver', 'silver/customers', COUNT(*) FROM customer
UNION ALL SELECT 'silver', 'silver/orders', COUNT(*) FROM orders
UNION ALL SELECT 'silver', 'silver/products', COUNT(*) FROM part
UNION ALL SELECT 'gold', 'gold/customers_summary', COUNT(DISTINCT c_nationkey) FROM customer
UNION ALL SELECT 'gold', 'gold/orders_summary', COUNT(DISTINCT date_trunc('month', o_orderdate)) FROM orders""")
def _(i: Inputs) -> DataFrame:
    return _layers(i)[1]


@query("medallion_customers", """
SELECT n_name AS country, COUNT(*) AS total_customers, CAST(MIN(DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER)) AS VARCHAR) AS earliest_signup,
       CAST(MAX(DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER)) AS VARCHAR) AS latest_signup
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def _(i: Inputs) -> DataFrame:
    return _layers(i)[0].read("gold/customers_summary")


@query("medallion_orders", f"""
SELECT {DATE("date_trunc('month', o_orderdate)")} AS order_month, COUNT(*) AS total_orders, CAST(COUNT(*) * 2 AS BIGINT) AS total_quantity,
       ROUND(SUM(CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END), 2) AS total_revenue FROM orders GROUP BY 1""")
def _(i: Inputs) -> DataFrame:
    return _layers(i)[0].read("gold/orders_summary").select(
        F.col("order_month").cast("date").alias("order_month"), "total_orders", "total_quantity", F.round("total_revenue", 2).alias("total_revenue"))


@query("medallion_products", "SELECT p_partkey AS product_id, upper(p_name) AS product_name, p_type AS category, p_retailprice AS price FROM part")
def _(i: Inputs) -> DataFrame:
    return _layers(i)[0].read("silver/products").select("product_id", "product_name", "category", "price")
