"""Operator vocabulary: windows, joins, functions, features, vectors, text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.catalog.registry import DATE, D, TS, Inputs, query
from ledgerline.functions import calc
from ledgerline.operators import features
from ledgerline.operators.joins import asof_join, broadcast_if_small, lookup_latest, price_lookup
from ledgerline.operators.merge import change_feed, dedup_latest, upsert
from ledgerline.operators.ordered import exact_percentile, ordered_functions
from ledgerline.operators.similarity import topk_cosine
from ledgerline.operators.splits import split_asof, split_windows
from ledgerline.operators.summaries import STEP, DayStates
from ledgerline.operators.vector_index import build_index, search_index
from ledgerline.plans.monitoring import experiment_ranking

# --- projections, aggregates, sorts ---------------------------------------------------------


@query("group_aggregates", """
SELECT o_orderpriority, COUNT(*) AS n, ROUND(AVG(o_totalprice), 2) AS avg_price, MAX(o_totalprice) AS max_price, MIN(o_totalprice) AS min_price,
       COUNT(DISTINCT o_custkey) AS customers, COUNT(*) - COUNT(DISTINCT o_custkey) AS repeats,
       COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS finished,
       CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS finished_price
FROM orders GROUP BY 1""")
def _(i: Inputs) -> DataFrame:
    done = F.col("o_orderstatus") == "F"
    return i.table("orders").groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("o_totalprice"), 2).alias("avg_price"), F.max("o_totalprice").alias("max_price"),
        F.min("o_totalprice").alias("min_price"), F.count_distinct("o_custkey").alias("customers"),
        (F.count(F.lit(1)) - F.count_distinct("o_custkey")).alias("repeats"), F.count_if(done).alias("finished"),
        F.sum(F.when(done, F.col("o_totalprice").cast("decimal(18,2)"))).alias("finished_price"),
    )


@query("monthly_revenue", f"""
SELECT {DATE("date_trunc('month', o_orderdate)")} AS order_month, COUNT(*) AS total_orders, {DATE('MIN(o_orderdate)')} AS first_order,
       {DATE('MAX(o_orderdate)')} AS last_order, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue
FROM orders GROUP BY 1""")
def _(i: Inputs) -> DataFrame:
    return i.table("orders").groupBy(F.date_trunc("month", "o_orderdate").cast("date").alias("order_month")).agg(
        F.count(F.lit(1)).alias("total_orders"), F.min("o_orderdate").cast("date").alias("first_order"),
        F.max("o_orderdate").cast("date").alias("last_order"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total_revenue"),
    )


@query("bound_parameters", """
SELECT c_custkey, c_name, c_acctbal / 1000 AS balance_k FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal >= 5000""")
def _(i: Inputs) -> DataFrame:
    return i.spark.sql(
        "SELECT c_custkey, c_name, c_acctbal / 1000 AS balance_k FROM {c} WHERE c_mktsegment = :segment AND c_acctbal >= :least",
        args={"segment": "BUILDING", "least": 5000}, c=i.table("customer"),
    )


@query("json_properties", """
SELECT event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, COUNT(*) AS n FROM events GROUP BY 1, 2""")
def _(i: Inputs) -> DataFrame:
    e = i.table("events").select("event_type", F.from_json("props", "k int").alias("data"))
    return e.select("event_type", "data.*").groupBy("event_type", "k").agg(F.count(F.lit(1)).alias("n"))


@query("parse_with_rejects", """
SELECT event_type, COUNT(*) AS n, COUNT(TRY_CAST(raw AS DOUBLE)) AS parsed, COUNT(*) - COUNT(TRY_CAST(raw AS DOUBLE)) AS rejected
FROM (SELECT event_type, CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS raw FROM events) GROUP BY 1""")
def _(i: Inputs) -> DataFrame:
    raw = i.table("events").select(
        "event_type", F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string")).alias("raw"))
    return calc.parse_or_reject(raw, {"raw": "double"}).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count("raw").alias("parsed"), F.count_if(F.size("_rejects") > 0).alias("rejected"))


@query("set_operations", """
SELECT c_nationkey AS nationkey, 'customer' AS kind, COUNT(*) AS n FROM customer GROUP BY 1
UNION ALL SELECT s_nationkey, 'supplier', COUNT(*) FROM supplier GROUP BY 1
UNION ALL SELECT k, 'either', 1 FROM (SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier)""")
def _(i: Inputs) -> DataFrame:
    c = i.table("customer").select(F.col("c_nationkey").alias("nationkey"))
    s = i.table("supplier").select(F.col("s_nationkey").alias("nationkey"))
    n = F.count(F.lit(1)).alias("n")
    one = c.groupBy("nationkey").agg(n).withColumn("kind", F.lit("customer"))
    two = s.groupBy("nationkey").agg(n).withColumn("kind", F.lit("supplier"))
    both = c.union(s).distinct().select("nationkey", F.lit(1).cast("long").alias("n"), F.lit("either").alias("kind"))
    return one.unionByName(two).unionByName(both)


@query("dedup_latest", f"""
SELECT l_orderkey, l_linenumber, {DATE('l_shipdate')} AS l_shipdate, l_partkey, l_suppkey, l_extendedprice FROM lineitem
QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_extendedprice DESC, l_partkey, l_suppkey) = 1""")
def _(i: Inputs) -> DataFrame:
    order = [F.desc("l_shipdate"), F.desc("l_extendedprice"), F.asc("l_partkey"), F.asc("l_suppkey")]
    li = i.table("lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("l_shipdate"), "l_partkey", "l_suppkey", "l_extendedprice")
    return dedup_latest(li, ["l_orderkey", "l_linenumber"], order)


# --- windows --------------------------------------------------------------------------------

def _band():
    return F.floor(F.col("o_totalprice") / 2000)


@query("rank_family", """
SELECT o_orderkey, o_orderpriority, ROW_NUMBER() OVER (w ORDER BY o_totalprice DESC, o_orderkey) AS row_num,
       RANK() OVER (w ORDER BY o_totalprice DESC) AS rank_val, DENSE_RANK() OVER (w ORDER BY o_totalprice DESC) AS dense_rank_val
FROM orders WINDOW w AS (PARTITION BY o_orderpriority)""")
def _(i: Inputs) -> DataFrame:
    o = i.table("orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return ordered_functions(o, ["o_orderpriority"], "o_totalprice", ["o_orderkey"], _band(), descending=True).drop("o_totalprice")


@query("lag_lead", """
SELECT o_orderkey, o_orderpriority, LAG(o_totalprice) OVER w AS prev_value, LEAD(o_totalprice) OVER w AS next_value
FROM orders WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey)""")
def _(i: Inputs) -> DataFrame:
    o = i.table("orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    out = ordered_functions(o, ["o_orderpriority"], "o_totalprice", ["o_orderkey"], _band(), descending=True, neighbours="o_totalprice")
    return out.select("o_orderkey", "o_orderpriority", "prev_value", "next_value")


@query("running_total", f"""
SELECT o_orderkey, o_orderstatus, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER
         (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_total
FROM orders""")
def _(i: Inputs) -> DataFrame:
    o = i.table("orders").select("o_orderkey", "o_orderstatus", "o_orderdate", F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    out = ordered_functions(o, ["o_orderstatus"], "o_orderdate", ["o_orderkey"], F.date_trunc("month", "o_orderdate"), running="price")
    return out.select("o_orderkey", "o_orderstatus", "running_total")


@query("revenue_rank", """
SELECT p_brand, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
       RANK() OVER (ORDER BY SUM(CAST(l_extendedprice AS DECIMAL(18,2))) DESC) AS revenue_rank
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand""")
def _(i: Inputs) -> DataFrame:
    # Reduced by part before the join.
    per = i.table("lineitem").groupBy("l_partkey").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("s"))
    p = i.table("part").select("p_partkey", "p_brand")
    brand = per.join(p, per.l_partkey == p.p_partkey).groupBy("p_brand").agg(F.sum("s").alias("total_revenue"))
    band = F.floor(F.log2(F.col("total_revenue") + 1) * 8)
    ranked = ordered_functions(brand, [], "total_revenue", ["p_brand"], band, descending=True)
    return ranked.select("p_brand", "total_revenue", F.col("rank_val").alias("revenue_rank"))


@query("customer_order_windows", f"""
SELECT o_orderkey, o_custkey, ROW_NUMBER() OVER w AS order_number, {DATE('LAG(o_orderdate) OVER w')} AS previous_order
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def _(i: Inputs) -> DataFrame:
    o = i.table("orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("day"))
    # Blocks of a year keep a customer with very many orders from filling one task.
    out = ordered_functions(o, ["o_custkey"], "day", ["o_orderkey"], F.year("day"), neighbours="day")
    return out.select("o_orderkey", "o_custkey", F.col("row_num").alias("order_number"), F.col("prev_value").alias("previous_order"))


@query("median_price", """
SELECT p_brand, ROUND(quantile_cont(p_retailprice, 0.5), 4) AS median_price FROM part GROUP BY 1""")
def _(i: Inputs) -> DataFrame:
    out = exact_percentile(i.table("part"), ["p_brand"], "p_retailprice", 0.5, F.floor(F.col("p_retailprice") / 10), "median_price")
    return out.withColumn("median_price", F.round("median_price", 4))


@query("skewed_windows", """
WITH l AS (SELECT CASE WHEN l_quantity >= 2 THEN 'usual' ELSE 'single' END AS size_class, l_quantity, l_orderkey, l_linenumber,
             l_partkey, l_suppkey, l_extendedprice, CAST(l_extendedprice AS DECIMAL(18,2)) AS price FROM lineitem)
SELECT size_class, l_orderkey, l_linenumber, ROW_NUMBER() OVER w AS row_num,
       RANK() OVER (PARTITION BY size_class ORDER BY l_quantity) AS rank_val,
       DENSE_RANK() OVER (PARTITION BY size_class ORDER BY l_quantity) AS dense_rank_val,
       CAST(SUM(price) OVER (PARTITION BY size_class ORDER BY l_quantity, l_orderkey, l_linenumber, l_partkey, l_suppkey, price
                             ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_total,
       CAST(LAG(price) OVER w AS DOUBLE) AS prev_value, CAST(LEAD(price) OVER w AS DOUBLE) AS next_value
FROM l WINDOW w AS (PARTITION BY size_class ORDER BY l_quantity, l_orderkey, l_linenumber, l_partkey, l_suppkey, price)""")
def _(i: Inputs) -> DataFrame:
    """Nearly all lines are in one class, and a quantity is shared by many: the ranges are cut by the data."""
    ties = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "price"]
    li = i.table("lineitem").withColumns({
        "size_class": F.when(F.col("l_quantity") >= 2, "usual").otherwise("single"),
        "price": F.col("l_extendedprice").cast("decimal(18,2)"),
    })
    out = split_windows(li.select("size_class", "l_quantity", *ties), ["size_class"], "l_quantity", ties, i.folder("splits"),
                        running="price", neighbours="price")
    return out.select("size_class", "l_orderkey", "l_linenumber", "row_num", "rank_val", "dense_rank_val", "running_total",
                      "prev_value", "next_value")


@query("skewed_asof", f"""
WITH e AS (SELECT *, CASE WHEN event_id % 50 = 0 THEN 'rare' ELSE 'common' END AS stream FROM events),
p AS (SELECT stream, ts, MAX(value) AS value FROM e WHERE event_type = 'purchase' GROUP BY 1, 2)
SELECT e.event_id, e.stream, p.value AS last_purchase, strftime(p.ts, '%Y-%m-%d %H:%M:%S.%f') AS purchased_at
FROM e ASOF LEFT JOIN p ON e.stream = p.stream AND e.ts >= p.ts WHERE e.event_type <> 'purchase'""")
def _(i: Inputs) -> DataFrame:
    """The latest purchase at each other event, where one stream holds nearly all events."""
    e = i.table("events").withColumn("stream", F.when(F.col("event_id") % 50 == 0, "rare").otherwise("common"))
    bought = e.where("event_type = 'purchase'").select("stream", "ts", F.col("value").alias("last_purchase"))
    others = e.where("event_type <> 'purchase'").select("event_id", "stream", F.col("ts").alias("at"))
    out = split_asof(others, bought, ["stream"], "at", "ts", ["last_purchase"], i.folder("splits"))
    return out.select("event_id", "stream", "last_purchase", F.col("ts_matched").alias("purchased_at"))


@query("approx_users", "SELECT event_type, COUNT(DISTINCT user_id) AS exact_users, TRUE AS within_bound FROM events GROUP BY 1")
def _(i: Inputs) -> DataFrame:
    a = i.table("events").groupBy("event_type").agg(
        F.count_distinct("user_id").alias("exact_users"), F.approx_count_distinct("user_id", 0.05).alias("a"))
    return a.select("event_type", "exact_users", (F.abs(F.col("a") - F.col("exact_users")) <= F.col("exact_users") * 0.15).alias("within_bound"))


def _event_states(i: Inputs) -> DayStates:
    """States made in two steps: the events of the first half of the time, then the days that the others touch."""
    e = i.table("events").withColumn("day", F.to_date("ts"))
    lo, hi = e.agg(F.min(F.unix_micros(F.col("ts").cast("timestamp"))), F.max(F.unix_micros(F.col("ts").cast("timestamp")))).first()
    first = F.unix_micros(F.col("ts").cast("timestamp")) < F.lit(((lo or 0) + (hi or 0)) // 2)
    states = DayStates(i.spark, i.folder("states"), "day", ("event_type",), "user_id", "value")
    states.refresh(e.where(first))
    states.refresh(e, e.where(~first).select("day"))
    return states


def _week() -> Column:
    return F.date_trunc("week", "day").cast("date").alias("week")


@query("period_quantiles", f"""
WITH p AS (SELECT event_type, date_trunc('week', ts) AS week, UNNEST([0.5, 0.95]) AS share, value FROM events),
q AS (SELECT event_type, week, share, COUNT(value) AS n, CASE WHEN share = 0.5 THEN quantile_disc(value, 0.5) ELSE quantile_disc(value, 0.95) END AS x
      FROM p GROUP BY 1, 2, 3)
SELECT event_type, {DATE("week")} AS week, CAST(share AS DOUBLE) AS share, n,
       ROUND(CASE WHEN x = 0 THEN 0 ELSE 2 / (1 + {STEP!r}) * POW({STEP!r}, CEIL(LN(x) / LN({STEP!r}))) END, 4) AS value FROM q""")
def _(i: Inputs) -> DataFrame:
    out = _event_states(i).quantiles([F.col("event_type"), _week()], [0.5, 0.95])
    return out.withColumn("value", F.round("value", 4))


@query("period_users", f"""
SELECT event_type, {DATE("date_trunc('week', ts)")} AS week, COUNT(DISTINCT user_id) AS exact_users, TRUE AS within_bound FROM events GROUP BY 1, 2""")
def _(i: Inputs) -> DataFrame:
    """The united states of a week beside the exact count: at most three standard errors apart."""
    united = _event_states(i).distinct([F.col("event_type"), _week()])
    e = i.table("events").withColumn("day", F.to_date("ts"))
    exact = e.groupBy("event_type", _week()).agg(F.count_distinct("user_id").alias("exact_users"))
    near = F.abs(F.col("values") - F.col("exact_users")) <= F.greatest(F.lit(1.0), F.col("exact_users") * 0.025)
    return exact.join(united, ["event_type", "week"], "left").select("event_type", "week", "exact_users", F.coalesce(near, F.lit(False)).alias("within_bound"))


# --- joins ----------------------------------------------------------------------------------


@query("lookup_broadcast", """
SELECT n_name, COUNT(*) AS customers, CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def _(i: Inputs) -> DataFrame:
    n, _ = broadcast_if_small(i.table("nation").select("n_nationkey", "n_name"))
    c = i.table("customer")
    return c.join(n, c.c_nationkey == n.n_nationkey).groupBy("n_name").agg(
        F.count(F.lit(1)).alias("customers"), F.sum(F.col("c_acctbal").cast("decimal(18,2)")).alias("balance"))


_OFFERS = """
offers AS (
  SELECT p_brand AS brand, o_orderdate AS valid_from,
         CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate + to_days(CAST(l_linenumber * l_linenumber * 9 AS INTEGER)) END AS valid_to,
         CAST(MAX(l_extendedprice) AS DECIMAL(18,2)) AS price
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  WHERE l_returnflag = 'R' AND l_quantity >= 49 GROUP BY 1, 2, 3)"""


@query("overlapping_prices", f"""
WITH {_OFFERS},
sale AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, p_brand, l_shipdate FROM lineitem JOIN part ON l_partkey = p_partkey),
best AS (SELECT brand, d, (SELECT struct_pack(f := valid_from, p := price) FROM offers o WHERE o.brand = x.brand AND valid_from <= d
                          AND (valid_to IS NULL OR d < valid_to) ORDER BY valid_from DESC, price DESC LIMIT 1) AS o
         FROM (SELECT DISTINCT p_brand AS brand, l_shipdate AS d FROM sale) x)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_brand, {DATE('l_shipdate')} AS l_shipdate, CAST(o.p AS DOUBLE) AS price
FROM sale JOIN best ON brand = p_brand AND d = l_shipdate""")
def _(i: Inputs) -> DataFrame:
    """Overlapping and nested validity periods: the latest start wins, each sale appears once."""
    li, o, p = i.table("lineitem"), i.table("orders"), i.table("part").select("p_partkey", "p_brand")
    until = F.when(
        F.col("o_orderpriority") != "5-LOW",
        F.col("o_orderdate") + F.make_dt_interval((F.col("l_linenumber") * F.col("l_linenumber") * 9).cast("int")),
    )
    offers = (
        li.filter("l_returnflag = 'R' AND l_quantity >= 49")
        .join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
        .groupBy(F.col("p_brand").alias("brand"), F.col("o_orderdate").alias("valid_from"), until.alias("valid_to"))
        .agg(F.max("l_extendedprice").cast("decimal(18,2)").alias("price"))
    )
    sale = li.join(p, li.l_partkey == p.p_partkey).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "p_brand", "l_shipdate")
    out = price_lookup(sale, offers, {"p_brand": "brand"}, "l_shipdate", "valid_from", "valid_to", ["price"])
    return out.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


def _spend(i: Inputs) -> DataFrame:
    return i.table("orders").groupBy("o_custkey", "o_orderdate").agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("spend"))


def _shipped(i: Inputs) -> DataFrame:
    li, o = i.table("lineitem"), i.table("orders").select("o_orderkey", "o_custkey")
    return li.join(o, li.l_orderkey == o.o_orderkey).select("o_custkey", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")


_SPEND = """spend AS (SELECT o_custkey, o_orderdate, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS spend FROM orders GROUP BY 1, 2),
shipped AS (SELECT o_custkey, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


@query("pit_training_set", f"""
WITH {_SPEND}
SELECT s.o_custkey, l_orderkey, l_linenumber, l_partkey, l_suppkey, {DATE('l_shipdate')} AS l_shipdate, CAST(spend AS DOUBLE) AS spend,
       {DATE('o_orderdate')} AS feature_date
FROM shipped s ASOF LEFT JOIN spend f ON f.o_custkey = s.o_custkey AND f.o_orderdate <= s.l_shipdate""")
def _(i: Inputs) -> DataFrame:
    out = asof_join(_shipped(i), _spend(i), ["o_custkey"], "l_shipdate", "o_orderdate", ["spend"], bucket_seconds=180 * 86400)
    return out.select("o_custkey", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_shipdate").cast("date").alias("l_shipdate"),
                      "spend", F.col("o_orderdate_matched").cast("date").alias("feature_date"))


@query("latest_feature_lookup", f"""
WITH {_SPEND}
SELECT c_custkey AS o_custkey, c_mktsegment, CAST(spend AS DOUBLE) AS spend FROM customer LEFT JOIN
  (SELECT * FROM spend QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) = 1) f ON f.o_custkey = c_custkey""")
def _(i: Inputs) -> DataFrame:
    c = i.table("customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return lookup_latest(c, _spend(i), "o_custkey", ["o_orderdate"], ["spend"])


# --- functions ------------------------------------------------------------------------------


@query("minmax_norm", """
SELECT c_custkey, ROUND((c_acctbal - lo) / (hi - lo), 8) AS norm, ROUND((c_acctbal - slo) / (shi - slo), 8) AS norm_in_segment
FROM (SELECT *, MIN(c_acctbal) OVER () AS lo, MAX(c_acctbal) OVER () AS hi, MIN(c_acctbal) OVER s AS slo, MAX(c_acctbal) OVER s AS shi
      FROM customer WINDOW s AS (PARTITION BY c_mktsegment))""")
def _(i: Inputs) -> DataFrame:
    c = i.table("customer")
    out = calc.min_max_norm(calc.min_max_norm(c, "c_acctbal", "norm"), "c_acctbal", "norm_in_segment", ["c_mktsegment"])
    return out.select("c_custkey", F.round("norm", 8).alias("norm"), F.round("norm_in_segment", 8).alias("norm_in_segment"))


_BANDS = "CASE WHEN c_acctbal * 10 >= 75000 THEN 'High' WHEN c_acctbal * 10 >= 60000 THEN 'Medium' ELSE 'Low' END"


@query("salary_bands", f"""
SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Unknown' ELSE {_BANDS} END AS band, COUNT(*) AS customers FROM customer GROUP BY 1""")
def _(i: Inputs) -> DataFrame:
    c = i.table("customer").withColumn("salary", F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_acctbal") * 10))
    return c.groupBy(calc.salary_band(F.col("salary")).alias("band")).agg(F.count(F.lit(1)).alias("customers"))


@query("sql_function", f"SELECT c_custkey, {_BANDS} AS band, '***@' || lower(c_mktsegment) || '.test' AS masked FROM customer")
def _(i: Inputs) -> DataFrame:
    calc.register_sql_functions(i.spark)
    return i.spark.sql(
        "SELECT c_custkey, salary_band(c_acctbal * 10) AS band, mask_email('someone@' || lower(c_mktsegment) || '.test') AS masked FROM {c}",
        c=i.table("customer"))


@query("local_hours", """
SELECT CAST(hour(ts + INTERVAL 330 MINUTE) AS INTEGER) AS local_hour, COUNT(*) AS n FROM events GROUP BY 1""")
def _(i: Inputs) -> DataFrame:
    e = i.table("events").select(F.hour(calc.local_time(F.col("ts").cast("timestamp"), "Asia/Kolkata")).alias("local_hour"))
    return e.groupBy("local_hour").agg(F.count(F.lit(1)).alias("n"))


_EMAIL_SQL = calc.EMAIL_PATTERN.replace("'", "''")


@query("extract_email", f"""
SELECT doc_id, lang, email, COUNT(*) AS mentions FROM
  (SELECT doc_id, lang, UNNEST(regexp_extract_all(text, '{_EMAIL_SQL}', 0)) AS email FROM documents) GROUP BY ALL""")
def _(i: Inputs) -> DataFrame:
    d = i.table("documents").select("doc_id", "lang", F.explode(calc.extract_emails(F.col("text"))).alias("email"))
    return d.groupBy("doc_id", "lang", "email").agg(F.count(F.lit(1)).alias("mentions"))


# --- features, models, vectors --------------------------------------------------------------


def _order_features(i: Inputs) -> DataFrame:
    li = i.table("lineitem").groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("qty"), F.count(F.lit(1)).cast("double").alias("lines"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("gross"))
    o = i.table("orders").select("o_orderkey", "o_totalprice")
    return o.join(li, o.o_orderkey == li.l_orderkey).drop("l_orderkey")


_SOLD = "orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)"


#: What a model's error on the test side may be, in units of the error of the mean.
_NO_WORSE = 1.05


#: Label and inputs of each experiment. The price is drawn at random in the given data; the value follows from its inputs.
_EXPERIMENTS = {"order_price": ("o_totalprice", ["qty", "lines", "gross"]), "order_value": ("gross", ["qty", "lines"])}


@query("forest_metrics", """
WITH li AS (SELECT l_orderkey, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS gross FROM lineitem GROUP BY 1),
f AS (SELECT o_orderkey, o_totalprice, CAST(gross AS DOUBLE) AS gross FROM orders JOIN li ON o_orderkey = l_orderkey),
e AS (SELECT o_orderkey, 'order_price' AS experiment, o_totalprice AS label FROM f
      UNION ALL SELECT o_orderkey, 'order_value', gross FROM f)
SELECT experiment, run_id, COUNT(*) FILTER (o_orderkey % 10 < 8) AS train_rows, COUNT(*) FILTER (o_orderkey % 10 >= 8) AS test_rows,
  ROUND(stddev_pop(label) FILTER (o_orderkey % 10 >= 8), 4) AS mean_rmse, TRUE AS no_worse_than_mean,
  CASE WHEN experiment = 'order_value' THEN TRUE END AS better_than_mean, TRUE AS agrees, TRUE AS ranked
FROM e, (SELECT UNNEST(['depth3', 'depth5']) AS run_id) GROUP BY 1, 2""")
def _(i: Inputs) -> DataFrame:
    """Two forests for the order's price and two for its value, recorded with their errors and ranked by them.

    A sound model of the random price comes out near the mean and a wrong one (a lost column, a label in another unit)
    far above it; one of the value has to beat the mean, whose own error is shown. r2 has to be what the error makes it.
    """
    train, test = features.modulus_split(_order_features(i), "o_orderkey")
    lake, rows, n = i.lake(), [], (train.count(), test.count())
    for name, (label, inputs) in _EXPERIMENTS.items():
        for depth in (3, 5):
            params = {"trees": 20, "depth": depth}
            score = features.fit_forest(train, inputs, label, **params)
            features.record_run(lake, name, f"depth{depth}", params, features.regression_metrics(score(test), label))
        runs = experiment_ranking(lake.read(features.RUNS), name).collect()
        spread = test.agg(F.stddev_pop(label)).first()[0]
        order = [r.rmse for r in runs]
        rows += [
            (name, r.run_id, *n, round(spread, 4), r.rmse <= _NO_WORSE * spread, r.rmse < spread if name == "order_value" else None,
             abs(1 - (r.rmse / spread) ** 2 - r.r2) < 1e-6, order == sorted(order))
            for r in runs
        ]
    return i.spark.createDataFrame(
        rows, "experiment string, run_id string, train_rows long, test_rows long, mean_rmse double, no_worse_than_mean boolean, "
        "better_than_mean boolean, agrees boolean, ranked boolean")


@query("batch_scoring", f"""
SELECT o_orderkey, o_totalprice, TRUE AS scored, TRUE AS no_worse_than_mean FROM {_SOLD}""")
def _(i: Inputs) -> DataFrame:
    """Every order scored by the forest; on the test side the predictions' error is held against that of the mean."""
    df = _order_features(i)
    train, test = features.modulus_split(df, "o_orderkey")
    scored = features.fit_forest(train, ["qty", "lines", "gross"], "o_totalprice", trees=10)(df)
    _, held = features.modulus_split(scored, "o_orderkey")
    error = held.agg(F.sqrt(F.avg((F.col("prediction") - F.col("o_totalprice")) ** 2)) / F.stddev_pop("o_totalprice")).scalar()
    is_number = F.col("prediction").isNotNull() & ~F.isnan("prediction")
    return scored.select("o_orderkey", "o_totalprice", is_number.alias("scored"), (error <= _NO_WORSE).alias("no_worse_than_mean"))


@query("feature_table", """
SELECT l_orderkey, SUM(l_quantity) AS qty, COUNT(*) AS lines FROM lineitem GROUP BY 1""")
def _(i: Inputs) -> DataFrame:
    f = i.table("lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("qty"), F.count(F.lit(1)).alias("lines"))
    return features.feature_table(f, ["l_orderkey"])


_CENTRES = """
flat AS (SELECT label, UNNEST(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
mean AS (SELECT label, pos, AVG(CAST(x AS DOUBLE)) AS x FROM flat GROUP BY 1, 2),
centre AS (SELECT label AS centre, LIST(x ORDER BY pos) AS v FROM mean GROUP BY 1),
scored AS (SELECT centre, vec_id, label, list_cosine_similarity(v, CAST(embedding AS DOUBLE[])) AS s FROM centre, embeddings)"""


def _centres(i: Inputs) -> DataFrame:
    """The mean vector of each label: the questions asked of the index."""
    e = i.table("embeddings").select("label", F.posexplode("embedding").alias("pos", "x"))
    mean = e.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return mean.groupBy(F.col("label").alias("centre")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda p: p["x"]).alias("embedding"))


@query("topk_similarity", f"""
WITH {_CENTRES}
SELECT CAST(centre AS BIGINT) AS centre, vec_id, ROUND(s, 5) AS score, ROW_NUMBER() OVER w AS rank
FROM scored WINDOW w AS (PARTITION BY centre ORDER BY s DESC, vec_id) QUALIFY rank <= 5""")
def _(i: Inputs) -> DataFrame:
    out = topk_cosine(_centres(i), i.table("embeddings"), 5, query_id="centre", base_id="vec_id")
    return out.withColumn("score", F.round("score", 5))


@query("topk_filtered", f"""
WITH {_CENTRES}
SELECT CAST(centre AS BIGINT) AS centre, vec_id, ROUND(s, 5) AS score, ROW_NUMBER() OVER w AS rank
FROM scored WHERE label IN (1, 2, 3) WINDOW w AS (PARTITION BY centre ORDER BY s DESC, vec_id) QUALIFY rank <= 10""")
def _(i: Inputs) -> DataFrame:
    out = topk_cosine(_centres(i), i.table("embeddings"), 10, query_id="centre", base_id="vec_id",
                      condition=F.col("label").isin(1, 2, 3))
    return out.withColumn("score", F.round("score", 5))


@query("topk_index", """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL),
s AS (SELECT a.vec_id AS query_id, b.vec_id, ROUND(list_cosine_similarity(a.e, b.e), 9) AS s FROM v a, v b WHERE a.vec_id % 100 = 0)
SELECT CAST(query_id AS BIGINT) AS query_id, CAST(vec_id AS BIGINT) AS vec_id, ROUND(s, 5) AS score, ROW_NUMBER() OVER w AS rank
FROM s WINDOW w AS (PARTITION BY query_id ORDER BY s DESC, vec_id) QUALIFY rank <= 10""")
def _(i: Inputs) -> DataFrame:
    e = i.table("embeddings")
    index = build_index(e, i.folder("cells"), id="vec_id", keep=("label",))
    asked = e.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return search_index(index, asked, 10, query_id="query_id").withColumn("score", F.round("score", 5))


@query("vector_sync", """
WITH old AS (SELECT vec_id, CASE WHEN label = 0 THEN -1 ELSE label END AS label FROM embeddings WHERE label < 8),
f AS (SELECT CASE WHEN o.vec_id IS NULL THEN 'insert' WHEN e.vec_id IS NULL THEN 'delete' ELSE 'update' END AS change, e.label
      FROM old o FULL JOIN embeddings e USING (vec_id) WHERE o.vec_id IS NULL OR e.vec_id IS NULL OR o.label <> e.label)
SELECT change, label, COUNT(*) AS n FROM f GROUP BY 1, 2
UNION ALL SELECT 'indexed', label, COUNT(*) FROM embeddings GROUP BY 2""")
def _(i: Inputs) -> DataFrame:
    """Only changed rows reach the index, which then equals the source."""
    new = i.table("embeddings")
    old = new.filter("label < 8").withColumn("label", F.when(F.col("label") == 0, -1).otherwise(F.col("label")))
    feed = change_feed(old, new, ["vec_id"]).filter("_change_type <> 'update_preimage'")
    kind = F.when(F.col("_change_type") == "update_postimage", "update").otherwise(F.col("_change_type"))
    changed = feed.filter("_change_type <> 'delete'").drop("_change_type")
    index = upsert(old, changed, ["vec_id"], unique_source=True)
    n = F.count(F.lit(1)).alias("n")
    return feed.groupBy(kind.alias("change"), "label").agg(n).unionByName(
        index.groupBy(F.lit("indexed").alias("change"), "label").agg(n))
