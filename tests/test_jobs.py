"""Stored tables, golden rows, pipelines, streams and plans."""

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import DATA
from ledgerline.catalog.registry import Inputs, NOW
from ledgerline.functions import calc
from ledgerline.operators.features import feature_table
from ledgerline.plans import anomalies, daily, dims, facts, gold, governance, medallion, monitoring
from ledgerline.plans.daily import DailyBatch, Sources
from ledgerline.plans.specs import SPECS, conform
from ledgerline.sources import drift, files, tables, watermarks
from ledgerline.sources.keyindex import KeyIndex
from ledgerline.sources.tables import list_names, make_folder, move_partitions, replace_partitions, upsert_partitions
from ledgerline.sources.worklist import WorkList
from ledgerline.streaming import events as ev
from ledgerline.streaming import ingest

# The sample rows.
EMPLOYEES = [
    (1, "Alice", "Engineering", 75000, "2020-01-15"),
    (2, "Bob", "Marketing", 62000, "2019-03-22"),
    (3, "Charlie", "Engineering", 80000, "2021-07-01"),
    (4, "Diana", "HR", 55000, "2018-11-10"),
    (5, "Eve", "Marketing", 68000, "2022-05-18"),
]
UPDATES = [(3, "Charlie", "Engineering", 85000, "2021-07-01"), (6, "Frank", "Sales", 59000, "2023-02-01")]
COLS = "id long, name string, department string, salary long, hire_date string"
SALES = [(1, "Widget", 10, 19.99), (2, "Gadget", 5, 49.99), (3, "Widget", 20, 19.99), (4, "Gizmo", 8, 99.99)]
CUSTOMERS = [
    (1, "  john doe  ", "  john@example.com ", "New York", "USA", "2023-01-15"),
    (2, "jane smith", "jane@example.com", "London", "UK", "2023-03-22"),
    (3, "  bob lee  ", "bob@example.com", "Tokyo", "Japan", "2023-06-10"),
    (4, "alice brown", "  alice@example.com  ", "Berlin", "Germany", "2023-08-05"),
]
ORDERS = [
    (101, 1, 501, "2024-01-10", 3, "150.50", "  shipped  "),
    (102, 2, 502, "2024-02-15", 1, "49.99", "pending"),
    (103, 1, 503, "2024-03-20", 5, "299.95", "delivered"),
    (104, 3, 501, "2024-04-01", 2, "100.00", "shipped"),
    (105, 4, 502, "2024-05-12", 10, "499.90", "  cancelled  "),
]
PRODUCTS = [(501, "  widget pro  ", "  electronics ", "19.99"), (502, "gadget lite", "accessories", "49.99"), (503, "super tool", "  tools  ", "59.99")]


def test_employee_merge_history_and_time_travel(spark, lake):
    name = "demo/employees"
    lake.overwrite(name, files.from_rows(spark, EMPLOYEES, COLS))
    assert lake.merge(name, files.from_rows(spark, UPDATES, COLS), ["id"]) == {"inserted": 1, "updated": 1, "unchanged": 4}
    assert lake.read(name).count() == 6
    assert lake.read(name).filter("id = 3").first().salary == 85000
    assert lake.read(name, version=0).filter("id = 3").first().salary == 80000
    stamp = lake.history(name).filter("version = 0").first().committed_at
    assert lake.read(name, as_of=stamp).count() == 5
    assert [(r.version, r.operation) for r in lake.history(name).orderBy("version").collect()] == [(0, "overwrite"), (1, "merge")]
    lake.append(name, spark.createDataFrame([(7, "G", 1.5)], "id long, name string, bonus double"))
    assert lake.read(name).filter("id = 7").first().bonus == 1.5
    assert lake.read(name).filter("id = 1").first().bonus is None
    lake.truncate(name)
    assert lake.read(name).count() == 0


def test_partitioned_table_append(spark, lake):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, p string")
    lake.overwrite("t", df, partition_by=["p"])
    lake.append("t", spark.createDataFrame([(3, "a")], "id int, p string"))
    assert sorted((r.id, r.p) for r in lake.read("t").collect()) == [(1, "a"), (2, "b"), (3, "a")]
    lake.clone("t", "u")
    assert lake.read("u").count() == 3


def test_employee_aggregates(spark):
    df = spark.createDataFrame(EMPLOYEES, COLS)
    avg = {r.department: r.a for r in df.groupBy("department").agg(F.avg("salary").alias("a")).collect()}
    assert avg == {"Engineering": 77500.0, "Marketing": 65000.0, "HR": 55000.0}
    bands = {r.name: r.b for r in df.select("name", calc.salary_band(F.col("salary")).alias("b")).collect()}
    assert bands == {"Alice": "High", "Bob": "Medium", "Charlie": "High", "Diana": "Low", "Eve": "Medium"}


def test_sales_rank(spark):
    s = spark.createDataFrame(SALES, "id int, product string, q int, price double")
    out = spark.sql("WITH r AS (SELECT product, round(sum(q * price), 2) AS t FROM {s} GROUP BY product) "
                    "SELECT product, t, rank() OVER (ORDER BY t DESC) AS k FROM r ORDER BY k", s=s)
    assert [tuple(r) for r in out.collect()] == [("Gizmo", 799.92, 1), ("Widget", 599.7, 2), ("Gadget", 249.95, 3)]


def _land(spark, folder):
    files.land(spark.createDataFrame(CUSTOMERS, "customer_id int, customer_name string, email string, city string, country string, signup_date string"), folder, "customers")
    files.land(spark.createDataFrame(ORDERS, "order_id int, customer_id int, product_id int, order_date string, quantity int, amount string, status string"), folder, "orders")
    files.land(spark.createDataFrame(PRODUCTS, "product_id int, product_name string, category string, price string"), folder, "products")


def test_medallion_golden(spark, lake, folder):
    _land(spark, f"{folder}/landing")
    counts = medallion.run_medallion(lake, medallion.control_frame(spark, medallion.demo_control()), f"{folder}/landing", NOW)
    assert sorted(r.row_count for r in counts.collect()) == [3, 3, 4, 4, 4, 5, 5, 5]
    c = lake.read("silver/customers").orderBy("customer_id").collect()
    assert [r.customer_name for r in c] == ["JOHN DOE", "JANE SMITH", "BOB LEE", "ALICE BROWN"]
    assert c[0].email == "john@example.com" and c[3].email == "alice@example.com"
    assert {r.country: r.total_customers for r in lake.read("gold/customers_summary").collect()} == {"USA": 1, "UK": 1, "Japan": 1, "Germany": 1}
    o = lake.read("silver/orders").orderBy("order_id").collect()
    assert [r.status for r in o] == ["SHIPPED", "PENDING", "DELIVERED", "SHIPPED", "CANCELLED"]
    g = lake.read("gold/orders_summary").orderBy("order_month").collect()
    assert [(r.total_quantity, r.total_revenue) for r in g] == [(3, 150.5), (1, 49.99), (5, 299.95), (2, 100.0), (10, 499.9)]


def test_medallion_merge_mode_and_bad_text(spark, lake, folder):
    from dataclasses import replace

    _land(spark, f"{folder}/landing")
    spec = replace(medallion.demo_control()[1], silver_mode="merge", primary_keys="order_id")
    frame = medallion.control_frame(spark, [spec])
    for _ in range(2):
        medallion.run_medallion(lake, frame, f"{folder}/landing", NOW)
    assert lake.read("silver/orders").count() == 5
    for text in ("DROP TABLE x", "SELECT nothing FROM {bronze}", "SELECT 1) t; DROP TABLE x --"):
        broken = medallion.control_frame(spark, [replace(spec, silver_transform_sql=text, silver_table_name="silver/never")])
        with pytest.raises(Exception):
            medallion.run_medallion(lake, broken, f"{folder}/landing", NOW)
        assert not lake.exists("silver/never")


def test_calendar(spark):
    cal = dims.calendar(spark)
    assert cal.count() == 4018
    day = cal.filter("date = '2021-01-01'").first()
    assert (day.day_of_week, day.day_name, day.week_of_year, day.is_weekend, day.is_month_start) == (6, "Friday", 53, False, True)
    shifted = dims.calendar(spark, dt.date(2021, 6, 30), dt.date(2021, 7, 1), 7).orderBy("date").collect()
    assert [(r.fiscal_year, r.fiscal_month) for r in shifted] == [(2021, 12), (2022, 1)]


def test_specs_conform(spark):
    assert len(SPECS) == 24
    out = conform(spark.createDataFrame([("u1", "x")], "user_id string, note string"), SPECS["dims/dim_user"]).first()
    assert (out.status, out.email, out.note) == ("Active", None, "x")
    with pytest.raises(Exception, match="user_id is NULL"):
        conform(spark.createDataFrame([(None,)], "user_id string"), SPECS["dims/dim_user"]).collect()


def test_incremental_daily_batch(spark, lake):
    """Two runs equal one direct calculation; a third finds nothing."""
    i = Inputs(spark, DATA)
    usage, audit = i.usage(), i.audit_raw.drop("_value")
    first = "1990-01-01 00:00:00"

    def batch(u):
        return DailyBatch(lake, Sources(u, i.prices, audit), NOW, lookback_days=0, grain="year", first=first).run()

    batch(usage.filter(F.col("usage_start_time") < "1999-06-01"))
    second = {r["step"]: r for r in batch(usage)}
    third = {r["step"]: r for r in batch(usage)}
    assert second["usage"]["inserted"] > 0 and third["usage"]["read"] == 0 and third["usage"]["inserted"] == 0
    bronze = spark.read.parquet(f"{lake.root}/facts/bronze_billing_usage")
    assert bronze.count() == usage.select("record_id", "usage_date").distinct().count()
    direct = facts.cost_fact(facts.silver_usage(bronze, lake.read("dims/dim_workspace")), i.prices, lake.read("dims/dim_workspace"))
    stored = spark.read.parquet(f"{lake.root}/facts/fact_cost")
    total = lambda df: df.agg(F.count(F.lit(1)), F.sum("estimated_cost")).first()
    assert tuple(total(stored)) == tuple(total(direct))
    day = lake.read("gold/gold_workspace_daily_cost")
    want = gold.workspace_daily(direct)
    cols = ["usage_date", "workspace_id", "total_cost", "previous_day_cost", "cost_change_percentage"]
    assert day.select(cols).exceptAll(want.select(cols)).count() == 0 and day.count() == want.count()
    found = lake.read("silver/fact_cost_anomaly").filter("anomaly_type = 'daily_cost_spike'")
    assert set(r.anomaly_id for r in anomalies.daily_spikes(direct).select("anomaly_id").collect()) <= set(
        r.anomaly_id for r in found.select("anomaly_id").collect())
    log = lake.read("meta/framework_execution_log")
    assert log.count() == 30 and log.filter("status = 'SUCCESS'").count() == 30


def cost_by_month(df):
    month = F.date_trunc("month", "usage_date").alias("month")
    return {(r[0], r[1]): (r[2], r[3]) for r in df.groupBy("workspace_id", month).agg(F.count(F.lit(1)), F.sum("estimated_cost")).collect()}


def test_daily_batch_recovers_reprices_and_finds_late_rows(spark, lake, monkeypatch):
    """A failed step is made up for; a late row is loaded; a changed price reaches stored costs."""
    i = Inputs(spark, DATA)
    usage, audit = i.usage(), i.audit_raw.drop("_value")
    late = (F.col("usage_start_time") < "1999-06-01") & (F.col("usage_start_time") >= "1999-05-30") & (F.crc32(F.col("record_id").cast("binary")) % 2 == 0)

    def batch(u, prices=i.prices):
        return DailyBatch(lake, Sources(u, prices, audit), NOW, grain="year", first="1990-01-01 00:00:00").run()

    def direct(prices):
        bronze, w = spark.read.parquet(f"{lake.root}/facts/bronze_billing_usage"), lake.read("dims/dim_workspace")
        return cost_by_month(facts.cost_fact(facts.silver_usage(bronze, w), prices, w))

    early = usage.filter("usage_start_time < '1999-06-01'")
    with monkeypatch.context() as m:
        m.setattr(DailyBatch, "cost", lambda self: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            batch(early.filter(~late))
    batch(early.filter(~late))
    stored = lambda: cost_by_month(spark.read.parquet(f"{lake.root}/facts/fact_cost"))
    assert stored() == direct(i.prices) and stored()
    batch(early)
    bronze = spark.read.parquet(f"{lake.root}/facts/bronze_billing_usage")
    assert bronze.count() == early.select("record_id", "usage_date").distinct().count()
    assert stored() == direct(i.prices)
    kind = i.prices.schema["pricing"].dataType["default"].dataType
    twice = lambda c: (F.col(c) * 2).cast(kind)
    pricing = F.col("pricing").withField("default", twice("pricing.default"))
    doubled = i.prices.withColumn("pricing", pricing.withField("effective_list.default", twice("pricing.effective_list.default")))
    before = stored()
    batch(early, doubled)
    assert stored() == direct(doubled) and stored() != before


def test_failing_step_is_logged(lake):
    def boom():
        raise ValueError("no input")

    with pytest.raises(ValueError):
        monitoring.run_steps(lake, "p", [("one", lambda: {"read": 1}), ("two", boom), ("three", lambda: {})])
    got = {r.notebook_name: (r.status, r.error_message) for r in lake.read(monitoring.LOG).collect()}
    assert got == {"one": ("SUCCESS", None), "two": ("FAILED", "no input")}


def test_upsert_partitions_leaves_other_partitions_alone(spark, folder):
    path = f"{folder}/t"
    a = spark.createDataFrame([(1, "d1", "x"), (2, "d2", "x"), (3, None, "x")], "k int, d string, v string")
    assert upsert_partitions(spark, path, a, ["k"], "d")["inserted"] == 3
    before = {r.f: r.m for r in spark.read.parquet(path).select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_modification_time").alias("m")).collect()}
    b = spark.createDataFrame([(2, "d2", "y"), (4, "d2", "y")], "k int, d string, v string")
    for _ in range(2):
        upsert_partitions(spark, path, b, ["k"], "d")
    out = spark.read.parquet(path)
    assert sorted((r.k, r.d, r.v) for r in out.fillna("-", ["d"]).collect()) == [(1, "d1", "x"), (2, "d2", "y"), (3, "-", "x"), (4, "d2", "y")]
    after = {r.f for r in out.select(F.col("_metadata.file_path").alias("f")).collect()}
    assert sum("d=d1" in f or "HIVE_DEFAULT" in f for f in before if f in after) == 2
    replace_partitions(path, spark.createDataFrame([(9, "d1", "z")], "k int, d string, v string"), "d")
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [2, 3, 4, 9]


def test_watermark_never_moves_back(lake):
    watermarks.advance_watermark(lake, "p", "t", "c", "2024-03-01 10:00:00.5", NOW)
    watermarks.advance_watermark(lake, "p", "t", "c", "2024-02-01", NOW)
    assert watermarks.read_watermark(lake, "p", "t").startswith("2024-03-01 10:00:00.5")
    assert watermarks.read_watermark(lake, "other", "t") == watermarks.FIRST


def test_csv_ingest_grows_schema_and_loads_each_file_once(spark, lake, folder):
    src, state = f"{folder}/csv", f"{folder}/state"
    spark.createDataFrame([(1, "a"), (2, "b")], "id int, s string").write.option("header", True).mode("append").csv(src)
    ingest.ingest_stream(lake, "bronze/t", "csv", src, state)
    spark.createDataFrame([(3, "c", 2.5)], "id int, s string, x double").write.option("header", True).mode("append").csv(src)
    ingest.ingest_stream(lake, "bronze/t", "csv", src, state)
    ingest.ingest_stream(lake, "bronze/t", "csv", src, state)
    out = lake.read("bronze/t")
    assert sorted((r.id, r.s, r.x) for r in out.collect()) == [(1, "a", None), (2, "b", None), (3, "c", 2.5)]
    assert dict(out.dtypes)["id"] == "bigint"
    spark.createDataFrame([("z", 4)], "s string, id int").write.option("header", True).mode("append").csv(src)
    with pytest.raises(ValueError, match="not the beginning"):
        ingest.ingest_stream(lake, "bronze/t", "csv", src, state)


def test_drifting_types_lose_no_value(spark, lake, folder):
    """Whole numbers, fractions, text in turn; empty columns, long whole numbers and late misfits on the way."""
    src, state = f"{folder}/csv", f"{folder}/state"

    def load(*rows):
        spark.createDataFrame(list(rows), "a string, b string, c string").coalesce(1).write.option("header", True).mode("append").csv(src)
        ingest.ingest_stream(lake, "bronze/t", "csv", src, state)
        out = lake.read("bronze/t")
        return dict(out.dtypes), {(r.a, r.b, r.c) for r in out.collect()}

    big = "9007199254740993"
    kinds, rows = load(("1", big, "x"), ("2", None, None))
    assert (kinds["a"], kinds["b"]) == ("bigint", "bigint") and (1, int(big), "x") in rows
    kinds, rows = load((None, None, None))
    assert (kinds["a"], kinds["b"]) == ("bigint", "bigint") and len(rows) == 3
    # Doubles hold 1 and 2, but not the long number: that column becomes text.
    kinds, rows = load(("2.5", "0.5", None))
    assert (kinds["a"], kinds["b"]) == ("double", "string") and {r[1] for r in rows} == {big, None, "0.5"} and {r[0] for r in rows} == {1.0, 2.0, None, 2.5}
    kinds, rows = load(("three", "7", "y"))
    assert kinds["a"] == "string" and {r[0] for r in rows} == {"1.0", "2.0", None, "2.5", "three"} and len(rows) == 5
    # What does not fit a stored type is kept beside it, counted, and comes back once the type is wide enough.
    schema = T.StructType.fromDDL("a double, n bigint")
    late = drift.typed(spark.createDataFrame([("1.5", "1"), ("x", "2.5"), (big, None)], "a string, n string"), schema)
    assert {(r.a, r.n, str(r._rescued)) for r in late.collect()} == {(1.5, 1, "None"), (None, None, "{'a': 'x', 'n': '2.5'}"), (None, None, "{'a': '%s'}" % big)}
    assert {(r.column, r["values"]) for r in drift.rescued_counts(late).collect()} == {("a", 2), ("n", 1)}
    lake.append("bronze/u", late)
    assert drift.settle(lake, "bronze/u", T.StructType.fromDDL("a string, n double")).simpleString() == "struct<a:string,n:double>"
    assert {(r.a, r.n, r._rescued is None) for r in lake.read("bronze/u").collect()} == {("1.5", 1.0, True), ("x", 2.5, True), (big, None, True)}


def test_json_schema_store(spark, folder):
    src, store = f"{folder}/json", f"{folder}/store"
    spark.createDataFrame([(1,)], "a int").write.mode("append").json(src)
    assert files.resolve_schema(spark, "json", src, store).names == ["a"]
    spark.createDataFrame([(1, "x")], "a int, b string").write.mode("append").json(src)
    assert files.resolve_schema(spark, "json", src, store).names == ["a", "b"]
    assert files.stored_schema(spark, store)[0].names == ["a", "b"]
    spark.createDataFrame([(1.5, None)], "a double, b string").write.mode("append").json(src)
    assert files.resolve_schema(spark, "json", src, store).simpleString() == "struct<a:double,b:string>"


def test_batch_writer_skips_committed_batches(spark, lake):
    write = ingest.append_once(lake, "bronze/t", "stream x")
    df = spark.createDataFrame([(1,)], "a int")
    write(df, 0), write(df, 0), write(df, 1)
    assert lake.read("bronze/t").count() == 2


def test_late_rows_are_counted_and_corrected(spark, lake, folder):
    e = spark.read.parquet(f"{DATA}/events.parquet")
    cut = lambda a, b: e.filter((F.col("ts") >= a) & (F.col("ts") < b))
    parts = [cut("2024-01-01", "2024-01-10"), cut("2024-01-20", "2025-01-01"), cut("2024-01-10", "2024-01-20")]
    parts[0].limit(0).write.parquet(f"{folder}/in")
    keys = ["window_start", "window_end", "event_type"]
    stream = lambda: ev.windowed_counts(spark.readStream.schema(e.schema).parquet(f"{folder}/in"), "ts", "1 hour", "2 minutes", ["event_type"])
    runs = ev.replay(stream, parts, f"{folder}/in", lambda s: ev.run_available(s, f"{folder}/state", ev.merge_batches(lake, "g", keys), "update"))
    assert [ev.dropped_by_watermark(r) > 0 for r in runs] == [False, False, True]
    assert lake.read("g").agg(F.sum("event_count")).first()[0] < e.count()
    ev.correct_windows(lake, "g", e, parts[2], "ts", "1 hour", ["event_type"])
    want = ev.batch_counts(e, "ts", "1 hour", ["event_type"])
    assert lake.read("g").exceptAll(want).count() == 0 and lake.read("g").count() == want.count()


def test_user_kind_and_roles(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), (None, "b"), ("a", None)], "run_by string, run_as string")
    assert [r[0] for r in df.select(facts.user_kind(F.col("run_by"), F.col("run_as"))).collect()] == ["user", "servicePrincipal", "user", "user"]
    cost = spark.createDataFrame([("w1", "u"), ("w2", "u")], "workspace_id string, user_id string")
    grants = spark.createDataFrame([("ann", "w2")], "user_name string, workspace_id string")
    assert governance.role_view("cost", cost, "security").count() == 0
    assert governance.role_view("audit", cost, "finance").count() == 0
    assert [r.workspace_id for r in governance.role_view("cost", cost, "workspace_owner", grants, "ann").collect()] == ["w2"]
    assert "user_id" not in governance.role_view("cost", cost, "viewer").columns


def test_anomaly_status_survives(spark, lake):
    row = "anomaly_id string, severity string, status string"
    lake.merge("a", spark.createDataFrame([("x", "High", "Open")], row), ["anomaly_id"], **_keep())
    lake.overwrite("a", lake.read("a").withColumn("status", F.lit("Resolved")))
    lake.merge("a", spark.createDataFrame([("x", "Critical", "Open"), ("y", "High", "Open")], row), ["anomaly_id"], **_keep())
    assert sorted(tuple(r) for r in lake.read("a").collect()) == [("x", "Critical", "Resolved"), ("y", "High", "Open")]


def _keep():
    return {"update": {"severity": anomalies.KEEP_STATUS["update"]["severity"]}}


def test_feature_table_checks_its_key(spark):
    with pytest.raises(ValueError):
        feature_table(spark.createDataFrame([(1,), (1,)], "k int"), ["k"])
    with pytest.raises(ValueError):
        feature_table(spark.createDataFrame([(None,)], "k int"), ["k"])


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cost_plan_never_shuffles_the_usage(spark):
    i = Inputs(spark, DATA)
    plan = _plan(i.cost().select("cost_id", "estimated_cost"))
    usage_side = plan[: plan.index("BroadcastExchange")]
    assert "BroadcastHashJoin" in usage_side and "Exchange hash" not in usage_side
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert word not in plan


def test_incremental_scan_is_pushed_down(spark):
    e = spark.read.parquet(f"{DATA}/events.parquet")
    plan = _plan(watermarks.incremental_scan(e, "ts", "2024-01-20 00:00:00", 3).select("event_id"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts,2024-01-17T00:00" in plan
    assert "event_type" not in plan


def test_no_query_uses_a_pairing_join(spark):
    import __spark_entry__ as entry

    for name in ("workspace_daily_cost", "rank_family", "pit_training_set", "overlapping_prices", "median_price", "executive_kpis", "minmax_norm"):
        plan = _plan(entry.queries()[name](spark, DATA))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def test_work_list_outlives_a_run(spark, folder):
    days = lambda *d: spark.createDataFrame([(dt.date(2024, 1, x),) for x in d], "part_date date")
    work = WorkList(spark, f"{folder}/work")
    rows = lambda step, upto=None: sorted((r.source, r.part_date.day) for r in work.pending(step, upto).collect())
    assert work.last() == 0 and rows("cost") == []
    work.add("usage", days(1, 1, 2))
    upto = work.last()
    work.add("usage", days(2, 3))
    work.add("audit", days(7))
    assert rows("cost") == [("audit", 7), ("usage", 1), ("usage", 2), ("usage", 3)]
    # What was listed while a step ran is not struck off with what it had taken.
    work.strike("cost", upto)
    assert rows("cost") == [("audit", 7), ("usage", 2), ("usage", 3)] and rows("gold", upto) == [("usage", 1), ("usage", 2)]
    work.forget(["cost", "gold"])
    assert rows("gold") == [("audit", 7), ("usage", 1), ("usage", 2), ("usage", 3)]
    for step in ("cost", "gold"):
        work.strike(step, work.last())
    work.strike("cost", upto)
    work.forget(["cost", "gold"])
    assert rows("cost") == rows("gold") == [] and list_names(spark, f"{folder}/work/todo") == []
    # Numbers go on above the marks; a listing whose job did not end is not one.
    assert work.add("usage", days(5)) == 4 and rows("cost") == [("usage", 5)]
    make_folder(spark, f"{folder}/work/todo/00000005")
    assert rows("cost") == [("usage", 5)] and work.add("usage", days(6)) == 6


def test_key_index_and_moved_records(spark, folder):
    row = lambda *r: spark.createDataFrame([(k, dt.date(2024, 1, d), v) for k, d, v in r], "id string, part_date date, v int")
    index, path = KeyIndex(spark, f"{folder}/index", "id", runs=2), f"{folder}/fact"
    assert index.find(row(("a", 1, 0))).collect() == []

    def load(source):
        moved = index.moved(source)
        done = move_partitions(spark, path, source, "id", "part_date", spark.createDataFrame(moved.collect(), moved.schema))
        index.record(source)
        return done

    state = lambda: {(r.id, r.part_date.day, r.v) for r in spark.read.parquet(path).collect()}
    load(row(("a", 1, 0), ("b", 2, 0), ("c", 2, 0), (None, 2, 0)))
    assert load(row(("a", 2, 1), ("c", 2, 1))) == {"inserted": 1, "updated": 1, "unchanged": 2}
    assert state() == {("a", 2, 1), ("b", 2, 0), ("c", 2, 1), (None, 2, 0)}
    assert not os.path.exists(f"{path}/part_date=2024-01-01")
    for k in range(4):
        load(row(("b", 3 + k, k)))
    # Runs were merged on the way, and the newest place of each key is kept.
    assert {r.id: r.part_date.day for r in index.find(row(("a", 1, 0), ("b", 1, 0), ("c", 1, 0), ("d", 1, 0))).collect()} == {"a": 2, "b": 6, "c": 2}
    assert len(list_names(spark, f"{folder}/index")) <= 3
    # A move that died before the index was told is repeated with the same result.
    late = row(("a", 9, 5))
    move_partitions(spark, path, late, "id", "part_date", index.moved(late))
    load(late)
    assert [r for r in spark.read.parquet(path).where("id IN ('a', 'b')").orderBy("id").select("id", "v").collect()] == [("a", 5), ("b", 3)]


def test_replaced_partitions_without_rows_go(spark, folder):
    path = f"{folder}/t"
    frame = lambda *r: spark.createDataFrame(list(r), "k int, d string")
    replace_partitions(path, frame((1, "x"), (2, "y"), (3, "z"), (4, None)), "d")
    replace_partitions(path, frame((5, "x")), "d", frame((0, "x"), (0, "y"), (0, None), (0, "never")))
    assert sorted((r.k, r.d) for r in spark.read.parquet(path).collect()) == [(3, "z"), (5, "x")]


@pytest.mark.parametrize("listed", [0, 1, 100])
def test_whole_rows_are_replaced_by_their_keys_alone(spark, folder, monkeypatch, listed):
    monkeypatch.setattr(tables, "BROADCAST_KEYS", listed)
    frame = lambda *r: spark.createDataFrame(list(r), "k int, d string, v string")
    state = lambda p: sorted((tuple(r) for r in spark.read.parquet(p).select("k", "d", "v").collect()), key=str)
    load = lambda *r: upsert_partitions(spark, f"{folder}/t", frame(*r), ["k"], "d", unique_source=True)
    load((1, "x", "a"), (2, "x", "b"), (None, "x", "c"), (3, "y", "d"), (4, None, "e"))
    # The join of all pairs of rows is for merges that need both sides.
    monkeypatch.setattr(tables, "upsert", lambda *a, **b: 1 / 0)
    assert load((None, "x", "C"), (2, "x", "B"), (5, "x", "f"), (4, None, "E")) == {"inserted": 1, "updated": 3, "unchanged": 1}
    assert load((3, "y", "D")) == {"inserted": 0, "updated": 1, "unchanged": 0}
    assert state(f"{folder}/t") == sorted([(1, "x", "a"), (2, "x", "B"), (None, "x", "C"), (3, "y", "D"), (4, None, "E"), (5, "x", "f")], key=str)
    monkeypatch.undo()
    # Keys that a stored table holds twice are both replaced, as before.
    frame((7, "z", "g"), (7, "z", "h"), (8, "z", "i")).write.partitionBy("d").parquet(f"{folder}/twice")
    assert upsert_partitions(spark, f"{folder}/twice", frame((7, "z", "G")), ["k"], "d", unique_source=True) == {"inserted": 0, "updated": 2, "unchanged": 1}
    assert state(f"{folder}/twice") == [(7, "z", "G"), (7, "z", "G"), (8, "z", "i")]


@pytest.mark.parametrize("listed", [0, 100])
def test_repeated_records_are_kept_once(spark, lake, monkeypatch, listed):
    monkeypatch.setattr(daily, "FEW_REPEATED", listed)
    rows = spark.createDataFrame([(1, "a", 1), (1, "a", 3), (1, "a", 2), (1, "b", 1), (None, "a", 1), (None, "a", 2), (2, None, 5)], "k int, d string, v int")
    batch = DailyBatch(lake, Sources(None, None, None), NOW)
    for many in (False, True):
        batch.batch = uuid.uuid4().hex
        got = batch._latest(rows, ["k", "d"], [F.desc("v")], "t", many)
        assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, "a", 3), (1, "b", 1), (None, "a", 2), (2, None, 5)], key=str)


@pytest.mark.parametrize("moves", [False, True])
def test_stored_sources_and_first_loads_are_not_written_twice(spark, lake, folder, monkeypatch, moves):
    written, write = [], daily.write_rows
    monkeypatch.setattr(daily, "write_rows", lambda df, path: written.append(path.split("/")[-1].rsplit("-", 1)[0]) or write(df, path))
    at = lambda m, d: dt.datetime(2023, m, d, 5)
    frame = lambda *r: spark.createDataFrame([(k, s, s and s.date(), v) for k, s, v in r], "record_id string, usage_start_time timestamp, usage_date date, v int")

    def load(n, *rows):
        path = f"{folder}/source{n}"
        frame(*rows).write.parquet(path)
        written.clear()
        usage = spark.read.parquet(path)
        batch = DailyBatch(lake, Sources(usage, None, None, stored=["usage"]), NOW, grain="month", lookback_days=40, moves=moves)
        done = batch.run(["usage"])[0]
        return {k: done[k] for k in ("read", "inserted", "updated", "unchanged")}

    first = [("a", at(1, 1), 1), ("a", at(1, 1), 2), ("b", at(1, 2), 1), (None, at(2, 1), 1), (None, at(2, 1), 2), ("c", at(3, 1), 1)]
    assert load(1, *first) == {"read": 6, "inserted": 4, "updated": 0, "unchanged": 0} and written == []
    # Most of the file is new, so only what is kept is written before the merge; of a few new rows, these are written too.
    assert load(2, ("c", at(4, 1), 5), ("d", at(4, 2), 1))["read"] == 2 and written == ["bronze_billing_usage-kept"]
    assert load(3, *first, *first, ("d", at(5, 2), 7))["read"] == 3 and written == ["bronze_billing_usage", "bronze_billing_usage-kept"]
    state = sorted([(r.record_id, r.usage_date.month, r.v) for r in spark.read.parquet(f"{lake.root}/facts/bronze_billing_usage").collect()], key=str)
    here = [("a", 1, 2), ("b", 1, 1), (None, 2, 2), ("d", 5, 7)] + ([("c", 3, 1)] if moves else [("c", 3, 1), ("c", 4, 5), ("d", 4, 1)])
    assert state == sorted(here, key=str)


def test_moved_index_takes_the_newest_place(spark, folder):
    row = lambda *r: spark.createDataFrame([(k, d and dt.date(2024, 1, d)) for k, d in r], "id string, part_date date")
    index = KeyIndex(spark, f"{folder}/index", "id")
    for rows in ([("a", 1), ("b", 1), ("c", 1), (None, 1), ("e", None)], [("a", 2), ("b", 2)], [("b", 3)]):
        index.record(row(*rows))
    moved = index.moved(row(("a", 2), ("b", 2), ("c", 4), (None, 5), ("d", 1), ("e", 1)))
    assert sorted((r.id, r.part_date.day) for r in moved.collect()) == [("b", 3), ("c", 1)]
    # Two long lists are not sorted to be compared.
    assert "SortMergeJoin" not in _plan(moved)


def test_dimensions_are_found_by_hashes(spark):
    i = Inputs(spark, DATA)
    for found, key in ((dims.discovered_workspaces(i.usage("workspace"), i.audit_raw), "workspace_id"), (dims.skus(i.usage("sku", "workspace")), "sku_name"),
                       (dims.billing_users(i.usage("user")), "user_id"), (dims.audit_users(i.audit_raw), "user_id")):
        assert f"HashAggregate(keys=[{key}" in _plan(found)


def test_settings_for_bounded_sorts_are_taken_back(spark):
    names = ("spark.sql.files.minPartitionNum", "spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    before = [spark.conf.get(n, None) for n in names]
    assert tables.bounded_sorts(spark, 5) == {}
    with tables.settings(spark, tables.bounded_sorts(spark, 100 * tables.SORTED_ROWS)):
        assert [spark.conf.get(n) for n in names] == ["200", "200"]
    assert [spark.conf.get(n, None) for n in names] == before


def test_usage_is_not_shuffled_to_a_short_list_of_new_prices(spark, lake):
    i = Inputs(spark, DATA)
    hit = (F.year("price_start_time") == 1997) & (F.col("cloud") == "AWS")
    price = F.col("pricing")["default"]
    dearer = i.prices.withColumn("pricing", F.when(hit, F.col("pricing").withField("effective_list.default", price + 1)).otherwise(F.col("pricing")))
    batch = DailyBatch(lake, Sources(None, dearer, None), NOW, grain="year")
    usage = batch._part(i.usage("sku", "workspace"), "usage_date")
    # No side is small by the plan's own estimate, as where the prices come out of a large table.
    with tables.settings(spark, {"spark.sql.autoBroadcastJoinThreshold": -1}):
        found = batch._repriced(i.prices, usage)
        plan = _plan(found)
        assert "BroadcastHashJoin [sku_name" in plan and "SortMergeJoin [sku_name" not in plan
        assert [str(r.part_date) for r in found.collect()] == ["1997-01-01"]
