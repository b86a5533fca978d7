"""Facts, dimensions, gold aggregates, anomalies and checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.catalog.registry import DATE, D, M, MD, PCT, R2, TS, Inputs, query, using
from ledgerline.operators.merge import insert_missing, update_where, upsert
from ledgerline.operators.quality import check_summary, expect, expectation_counts, layer_counts, run_checks
from ledgerline.plans import anomalies, daily, dims, facts, gold

SUMS = f"{MD('SUM(usage_quantity)')} AS usage_quantity, {MD('SUM(estimated_cost)')} AS estimated_cost"

# --- facts ----------------------------------------------------------------------------------


@query("silver_usage", using("workspace", "usage") + f"""
SELECT u.record_id, {DATE('usage_date')} AS usage_date, u.workspace_id, workspace_name, environment, region, u.cloud, sku,
       {D('usage_quantity')} AS usage_quantity, product AS billing_origin_product, job_id, cluster_id, warehouse_id,
       user_id, principal AS service_principal_id, (product = 'O') AS is_serverless
FROM usage u LEFT JOIN workspace w USING (workspace_id)""")
def _(i: Inputs) -> DataFrame:
    return i.silver().select(
        "record_id", "usage_date", "workspace_id", "workspace_name", "environment", "region", "cloud", "sku",
        "usage_quantity", "billing_origin_product", "job_id", "cluster_id", "warehouse_id", "user_id",
        "service_principal_id", F.col("product_features.is_serverless").alias("is_serverless"),
    )


@query("cost_fact", using("cost") + f"""
SELECT record_id AS cost_id, {DATE('usage_date')} AS usage_date, workspace_id, sku, cloud, {D('usage_quantity')} AS usage_quantity,
       {D('unit_price')} AS unit_price, currency, {D('estimated_cost')} AS estimated_cost, cost_center, business_unit, environment
FROM cost""")
def _(i: Inputs) -> DataFrame:
    return i.cost().select(
        "cost_id", "usage_date", "workspace_id", "sku", "cloud", "usage_quantity", "unit_price", "currency",
        "estimated_cost", "cost_center", "business_unit", "environment",
    )


@query("cost_summary", using("cost") + f"""
SELECT COUNT(*) AS total_records, COUNT(*) FILTER (WHERE unit_price IS NULL) AS missing_price,
       {MD('SUM(usage_quantity)')} AS total_usage, {MD('SUM(estimated_cost)')} AS total_estimated_cost
FROM cost""")
def _(i: Inputs) -> DataFrame:
    return facts.cost_summary(i.cost())


@query("invoiced_vs_estimated", using("cost") + f""",
est AS (SELECT workspace_id, year(usage_date) AS y, {M('SUM(estimated_cost)')} AS e FROM cost GROUP BY ALL),
inv AS (SELECT CAST(s_nationkey AS VARCHAR) AS workspace_id, year(l_shipdate) AS y,
               {M('SUM(CAST(l_extendedprice AS DECIMAL(18,2)))')} AS a
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_linestatus = 'F' AND l_returnflag = 'A' GROUP BY ALL)
SELECT workspace_id, y AS year, {D('e')} AS estimated_cost, {D('a')} AS invoiced_amount, {D('a - e')} AS difference
FROM est LEFT JOIN inv USING (workspace_id, y)""")
def _(i: Inputs) -> DataFrame:
    s, li = i.table("supplier"), i.table("lineitem")
    paid = li.filter("l_linestatus = 'F' AND l_returnflag = 'A'").join(s, li.l_suppkey == s.s_suppkey).select(
        F.col("s_nationkey").cast("string").alias("workspace_id"), F.year("l_shipdate").alias("year"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("invoiced_amount"),
    )
    return facts.with_invoice(i.cost().withColumn("year", F.year("usage_date")), paid, ["workspace_id", "year"])


@query("audit_fact", using("workspace", "audit") + f"""
SELECT audit_event_id, {TS('event_time')} AS event_time, {DATE('event_date')} AS event_date, workspace_id, workspace_name,
       user_name, user_type, service_principal, action_name, source_ip, response_status, audit_level,
       param_k AS parameter, '{{"k":"' || param_k || '"}}' AS request_json
FROM audit LEFT JOIN workspace USING (workspace_id)""")
def _(i: Inputs) -> DataFrame:
    return i.audit.select(
        "audit_event_id", "event_time", "event_date", "workspace_id", "workspace_name", "user_name", "user_type",
        "service_principal", "action_name", "source_ip", "response_status", "audit_level",
        F.try_element_at("request_parameters", F.lit("k")).alias("parameter"),
        F.get_json_object("audit_details", "$.request_params").alias("request_json"),
    )


_ALLOC = ["usage_date", "workspace_id", "workspace_name", "cost_center", "business_unit", "department", "environment", "cloud", "sku"]


def _allocation_sql(extra: list[str], source: str) -> str:
    keys = [*_ALLOC, *extra, source]
    parts = ", ".join(f"COALESCE('=' || CAST({k} AS VARCHAR), '~')" for k in keys)
    shown = ", ".join(k for k in [*_ALLOC[1:], *extra])
    return using("cost") + f"""
SELECT md5(concat_ws('|', {parts})) AS allocation_id, {DATE('usage_date')} AS allocation_date, {shown},
       {source} AS tag_source, {SUMS}
FROM cost GROUP BY ALL"""


@query("allocation_workspace", _allocation_sql([], "'workspace_metadata'"))
def _(i: Inputs) -> DataFrame:
    return facts.allocate(i.cost()).drop("project", "application")


_TAGGED = "CASE WHEN project IS NULL THEN 'workspace_metadata' ELSE 'custom_tags' END"


@query("allocation_tags", _allocation_sql(["project"], _TAGGED))
def _(i: Inputs) -> DataFrame:
    return facts.allocate(i.cost(), {"project": ("project", "Project")}).drop("application")


# --- dimensions -----------------------------------------------------------------------------


@query("calendar_cost", using("daily") + f""",
days AS (SELECT CAST(d AS DATE) AS d FROM (SELECT UNNEST(range(DATE '1995-01-01', DATE '2002-01-01', INTERVAL 1 DAY)) AS d)),
per AS (SELECT usage_date, SUM(total_cost) AS c FROM daily GROUP BY usage_date)
SELECT year(d + INTERVAL 6 MONTH) AS fiscal_year, quarter(d) AS quarter, strftime(d, '%A') AS day_name,
       dayofweek(d) IN (0, 6) AS is_weekend, COUNT(*) AS days, COUNT(c) AS days_with_usage, {MD('SUM(c)')} AS total_cost
FROM days LEFT JOIN per ON d = usage_date GROUP BY ALL""")
def _(i: Inputs) -> DataFrame:
    cal = dims.calendar(i.spark, dt.date(1995, 1, 1), dt.date(2001, 12, 31), fiscal_start_month=7)
    per = gold.workspace_daily(i.cost()).groupBy("usage_date").agg(F.sum("total_cost").alias("c"))
    return cal.join(per, F.col("date") == F.col("usage_date"), "left").groupBy(
        "fiscal_year", "quarter", "day_name", "is_weekend"
    ).agg(F.count(F.lit(1)).alias("days"), F.count("c").alias("days_with_usage"), F.sum("c").cast("decimal(28,6)").alias("total_cost"))


@query("dim_environment", using("workspace") + """,
seed AS (SELECT * FROM (VALUES ('DEV', 'Development environment for experimentation and testing'),
  ('TEST', 'Quality assurance and integration testing'), ('UAT', 'User acceptance testing'), ('PROD', 'Production environment'))
  AS t(environment, description)),
have AS (SELECT environment, COUNT(DISTINCT s_suppkey) || ' suppliers' AS description
         FROM workspace JOIN supplier ON CAST(s_nationkey AS VARCHAR) = workspace_id
         WHERE environment IN ('DEV', 'PROD') GROUP BY environment)
SELECT * FROM have UNION ALL SELECT * FROM seed WHERE environment NOT IN (SELECT environment FROM have)""")
def _(i: Inputs) -> DataFrame:
    s, w = i.table("supplier"), i.workspace
    have = (
        w.filter(F.col("environment").isin("DEV", "PROD"))
        .join(s, w.workspace_id == s.s_nationkey.cast("string"))
        .groupBy("environment")
        .agg(F.concat(F.count_distinct("s_suppkey"), F.lit(" suppliers")).alias("description"))
    )
    return insert_missing(have, dims.environments(i.spark), ["environment"]).drop("_action")


@query("dim_workspace", using("workspace", "usage") + """,
seen AS (SELECT workspace_id, MAX(cloud) AS cloud FROM (
    SELECT workspace_id, cloud FROM usage
    UNION ALL SELECT CAST(user_id % 25 AS VARCHAR), NULL FROM events WHERE user_id % 25 <> 0) GROUP BY workspace_id)
SELECT workspace_id, workspace_name, CASE WHEN w.status = 'Active' THEN COALESCE(s.cloud, 'OLD') WHEN w.workspace_id IS NULL THEN s.cloud ELSE 'OLD' END AS cloud,
       region, environment, COALESCE(w.status, 'Active') AS status
FROM workspace w FULL JOIN seen s USING (workspace_id)""")
def _(i: Inputs) -> DataFrame:
    target = i.workspace.withColumn("cloud", F.lit("OLD"))
    found = dims.discovered_workspaces(i.usage("workspace"), i.audit_raw)
    return upsert(target, found, ["workspace_id"], **dims.WORKSPACE_REFRESH).select(
        "workspace_id", "workspace_name", "cloud", "region", "environment", "status"
    )


@query("dim_sku", using("usage") + """
SELECT sku, MAX(product) AS product, MAX(cloud) AS cloud, 'UNIT' AS usage_unit FROM usage GROUP BY sku""")
def _(i: Inputs) -> DataFrame:
    return dims.skus(i.usage("sku", "workspace")).select("sku", "product", "cloud", "usage_unit")


@query("dim_user", using("usage", "audit") + """,
billing AS (SELECT id AS user_id, NULL AS user_name, MIN(kind) AS user_type FROM (
    SELECT user_id AS id, 'user' AS kind FROM usage UNION ALL SELECT principal, 'servicePrincipal' FROM usage)
    WHERE id IS NOT NULL GROUP BY id)
SELECT * FROM billing
UNION ALL
SELECT DISTINCT email, NULL, 'user' FROM audit WHERE email IS NOT NULL AND email NOT IN (SELECT user_id FROM billing)""")
def _(i: Inputs) -> DataFrame:
    both = insert_missing(dims.billing_users(i.usage("user")), dims.audit_users(i.audit_raw), ["user_id"])
    return both.select("user_id", "user_name", "user_type")


# --- gold -----------------------------------------------------------------------------------


@query("workspace_daily_cost", using("daily") + f""",
p AS (SELECT *, LAG(total_cost) OVER (PARTITION BY workspace_id ORDER BY usage_date) AS prev FROM daily)
SELECT {DATE('usage_date')} AS usage_date, workspace_id, workspace_name, environment, {D('total_usage')} AS total_usage,
       {D('total_cost')} AS total_cost, {D('prev')} AS previous_day_cost, {D('total_cost - COALESCE(prev, 0)')} AS cost_change,
       {PCT('total_cost', 'prev')} AS cost_change_percentage
FROM p""")
def _(i: Inputs) -> DataFrame:
    return gold.workspace_daily(i.cost())


@query("workspace_monthly_cost", using("cost") + f""",
m AS (SELECT strftime(usage_date, '%Y-%m') AS month, workspace_id, MAX(workspace_name) AS workspace_name,
             {M('SUM(usage_quantity)')} AS u, {M('SUM(estimated_cost)')} AS c FROM cost GROUP BY 1, 2),
p AS (SELECT *, LAG(c) OVER (PARTITION BY workspace_id ORDER BY month) AS prev FROM m)
SELECT month, workspace_id, workspace_name, {D('u')} AS total_usage, {D('c')} AS total_cost, {D('prev')} AS previous_month_cost,
       {PCT('c', 'prev')} AS month_over_month_percentage
FROM p""")
def _(i: Inputs) -> DataFrame:
    return gold.workspace_monthly(i.cost())


@query("sku_cost", using("cost") + f"""
SELECT {DATE('usage_date')} AS usage_date, workspace_id, sku, {SUMS} FROM cost WHERE sku IS NOT NULL GROUP BY ALL""")
def _(i: Inputs) -> DataFrame:
    return gold.sku_daily(i.cost())


@query("user_cost", using("cost") + f"""
SELECT {DATE('usage_date')} AS usage_date, workspace_id, user_id AS user_name, {SUMS} FROM cost WHERE user_id IS NOT NULL GROUP BY ALL""")
def _(i: Inputs) -> DataFrame:
    return gold.user_daily(i.cost("user"))


@query("job_cost", using("cost") + f"""
SELECT {DATE('usage_date')} AS usage_date, workspace_id, job_id, job_id || '-name' AS job_name, {SUMS}
FROM cost WHERE job_id IS NOT NULL GROUP BY ALL""")
def _(i: Inputs) -> DataFrame:
    return gold.job_daily(i.cost())


@query("cluster_cost", using("cost") + f"""
SELECT {DATE('usage_date')} AS usage_date, workspace_id, cluster_id, {SUMS} FROM cost WHERE cluster_id IS NOT NULL GROUP BY ALL""")
def _(i: Inputs) -> DataFrame:
    return gold.cluster_daily(i.cost()).drop("cluster_name")


@query("audit_summary", using("audit") + f"""
SELECT {DATE('event_date')} AS event_date, workspace_id, action_name, user_name, COUNT(*) AS event_count,
       COUNT(*) FILTER (WHERE response_status >= 400) AS failed_event_count
FROM audit GROUP BY ALL""")
def _(i: Inputs) -> DataFrame:
    return gold.audit_summary(i.audit)


_BREAKDOWN = {"product": "product", "business_unit": "business_unit", "cost_center": "cost_center", "environment": "environment",
              "region": "region", "warehouse": "warehouse_id", "department": "department"}


@query("cost_breakdowns", using("cost") + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{n}' AS dimension, {c} AS member, {SUMS} FROM cost GROUP BY {c}" for n, c in _BREAKDOWN.items()))
def _(i: Inputs) -> DataFrame:
    return gold.breakdowns(i.cost())


# --- anomalies ------------------------------------------------------------------------------


def _spike_sql(source: str, keys: list[str], date: str, measure: str, kind: str, metric: str, carry: str = "") -> str:
    """The rule as a self join over the days before."""
    k = ", ".join(keys)
    same = " AND ".join(f"b.{x} = a.{x}" for x in keys)
    present = " AND ".join(f"{x} IS NOT NULL" for x in keys)
    carried = f", MAX({carry}) AS {carry}" if carry else ""
    return using(source) + f""",
per AS (SELECT {k}, {date} AS d, {M(f'SUM({measure})')} AS v{carried} FROM {source} WHERE {present} GROUP BY {k}, {date}),
ref AS (SELECT a.*, (SELECT CAST(SUM(b.v) AS DOUBLE) / COUNT(b.v) FROM per b
                     WHERE {same} AND b.d < a.d AND b.d >= a.d - 7) AS base FROM per a),
hit AS (SELECT *, CAST(v AS DOUBLE) AS x FROM ref WHERE base > 0 AND CAST(v AS DOUBLE) > base * 1.25)
SELECT md5(concat_ws('|', CAST(d AS VARCHAR), {k}, '{kind}')) AS anomaly_id, {DATE('d')} AS detection_date, {k}{', ' + carry if carry else ''},
       '{kind}' AS anomaly_type, '{metric}' AS metric, base AS baseline_value, x AS actual_value,
       {R2('(x - base) / base * 100')} AS deviation_percentage,
       CASE WHEN x > base * 2 THEN 'Critical' WHEN x > base * 1.5 THEN 'High' ELSE 'Medium' END AS severity, 'Open' AS status
FROM hit"""


@query("daily_spikes", _spike_sql("cost", ["workspace_id"], "usage_date", "estimated_cost", "daily_cost_spike", "daily_cost", "workspace_name"))
def _(i: Inputs) -> DataFrame:
    return anomalies.daily_spikes(i.cost())


@query("sku_spikes", _spike_sql("cost", ["workspace_id", "sku"], "usage_date", "estimated_cost", "sku_spike", "sku_daily_cost", "workspace_name"))
def _(i: Inputs) -> DataFrame:
    return anomalies.sku_spikes(i.cost())


@query("usage_spikes", _spike_sql("cost", ["workspace_id"], "usage_date", "usage_quantity", "usage_spike", "daily_usage", "workspace_name"))
def _(i: Inputs) -> DataFrame:
    return anomalies.usage_spikes(i.cost())


for _res, _kind in anomalies.RESOURCES.items():
    query(f"{_kind}_spikes", _spike_sql("cost", ["workspace_id", _res], "usage_date", "estimated_cost", _kind, _kind))(
        lambda i, r=_res: anomalies.resource_spikes(i.cost(), r)
    )


@query("user_activity_spikes", _spike_sql("audit", ["user_name"], "event_date", "1", "user_activity", "daily_events"))
def _(i: Inputs) -> DataFrame:
    return anomalies.activity_spikes(i.audit)


def _off_sql(source: str, keys: list[str], date: str, measure: str, off: str, kind: str, metric: str) -> str:
    k = ", ".join(keys)
    return using(source) + f""",
per AS (SELECT {k}, {date} AS d, {M(f'SUM({measure}) FILTER (WHERE {off})')} AS v, {M(f'SUM({measure}) FILTER (WHERE NOT ({off}))')} AS r
        FROM {source} GROUP BY {k}, {date}),
ref AS (SELECT {k}, CAST(SUM(r) AS DOUBLE) / COUNT(r) AS base FROM per GROUP BY {k}),
hit AS (SELECT per.*, base, CAST(v AS DOUBLE) AS x FROM per JOIN ref USING ({k}) WHERE base > 0 AND CAST(v AS DOUBLE) > base * 1.25)
SELECT md5(concat_ws('|', CAST(d AS VARCHAR), {k}, '{kind}')) AS anomaly_id, {DATE('d')} AS detection_date, {k},
       '{kind}' AS anomaly_type, '{metric}' AS metric, base AS baseline_value, x AS actual_value,
       {R2('(x - base) / base * 100')} AS deviation_percentage,
       CASE WHEN x > base * 2 THEN 'Critical' WHEN x > base * 1.5 THEN 'High' ELSE 'Medium' END AS severity, 'Open' AS status
FROM hit"""


@query("weekend_usage", _off_sql("cost", ["workspace_id"], "usage_date", "estimated_cost", "dayofweek(usage_date) IN (0, 6)", "weekend_usage", "weekend_cost"))
def _(i: Inputs) -> DataFrame:
    return anomalies.weekend_usage(i.cost())


@query("after_hours_activity", _off_sql("audit", ["workspace_id"], "event_date", "1", "hour(event_time) NOT BETWEEN 8 AND 17", "after_hours_usage", "after_hours_total"))
def _(i: Inputs) -> DataFrame:
    return anomalies.after_hours(i.audit.withColumn("one", F.lit(1)), ["workspace_id"], "event_time", "event_date", "one")


@query("failed_activity", using("audit") + f"""
SELECT user_name, source_ip, action_name, COUNT(*) AS failed_events, {TS('MAX(event_time)')} AS last_failure
FROM audit WHERE response_status >= 400 GROUP BY ALL""")
def _(i: Inputs) -> DataFrame:
    return anomalies.failed_activity(i.audit)


_TRIAGE = using("daily") + f""",
ref AS (SELECT a.*, (SELECT CAST(SUM(b.total_cost) AS DOUBLE) / COUNT(b.total_cost) FROM daily b
                     WHERE b.workspace_id = a.workspace_id AND b.usage_date < a.usage_date AND b.usage_date >= a.usage_date - 7) AS base
        FROM daily a),
hit AS (SELECT *, CAST(total_cost AS DOUBLE) AS x FROM ref WHERE base > 0 AND CAST(total_cost AS DOUBLE) > base * 1.25),
found AS (SELECT md5(concat_ws('|', CAST(usage_date AS VARCHAR), workspace_id, 'daily_cost_spike')) AS anomaly_id, workspace_id, usage_date,
                 CASE WHEN x > base * 2 THEN 'Critical' WHEN x > base * 1.5 THEN 'High' ELSE 'Medium' END AS severity,
                 CASE WHEN usage_date < DATE '1998-01-01' THEN 'Resolved' ELSE 'Open' END AS status
          FROM hit)
"""


def _triaged(i: Inputs) -> DataFrame:
    """Anomalies detected again after the older ones were resolved by hand."""
    lake, name = i.lake(), "silver/fact_cost_anomaly"
    rows = anomalies.anomaly_rows(anomalies.daily_spikes(i.cost())).withColumn("detected_timestamp", F.lit("2024-01-01").cast("timestamp"))
    lake.merge(name, rows, ["anomaly_id"], **anomalies.KEEP_STATUS)
    lake.overwrite(name, update_where(lake.read(name), F.col("detection_date") < "1998-01-01", {"status": F.lit("Resolved")}))
    lake.merge(name, rows, ["anomaly_id"], **anomalies.KEEP_STATUS)
    return lake.read(name)


@query("anomaly_triage", _TRIAGE + f"SELECT anomaly_id, {DATE('usage_date')} AS detection_date, workspace_id, severity, status FROM found")
def _(i: Inputs) -> DataFrame:
    return _triaged(i).select("anomaly_id", "detection_date", "workspace_id", "severity", "status")


@query("anomaly_summary", _TRIAGE + """SELECT severity, COUNT(*) AS anomaly_count, COUNT(*) FILTER (WHERE status = 'Open') AS open_count
FROM found GROUP BY severity""")
def _(i: Inputs) -> DataFrame:
    return anomalies.anomaly_summary(_triaged(i))


# --- quality --------------------------------------------------------------------------------


def _checks(i: Inputs) -> DataFrame:
    w = daily.workspace_activity(i.workspace, i.usage("workspace"))
    frames = [
        (i.usage("sku", "workspace"), "usage", daily.usage_rules()),
        (i.cost(), "cost", daily.cost_rules()),
        (i.prices, "prices", daily.price_rules()),
        (i.audit_raw, "audit", daily.audit_rules()),
        (w, "workspace", daily.workspace_rules()),
    ]
    log = None
    for df, name, rules in frames:
        one = run_checks(df, name, rules)
        log = one if log is None else log.unionByName(one)
    return log


def _check_sql() -> str:
    checks = [
        ("usage", "missing_workspace_id", "COUNT(*) FILTER (WHERE workspace_id IS NULL)"),
        ("usage", "missing_sku", "COUNT(*) FILTER (WHERE sku IS NULL)"),
        ("usage", "negative_usage", "COUNT(*) FILTER (WHERE usage_quantity < 0)"),
        ("usage", "zero_usage", "COUNT(*) FILTER (WHERE usage_quantity = 0)"),
        ("usage", "duplicate_records", "COUNT(*) - COUNT(DISTINCT record_id)"),
        ("usage", "invalid_usage_dates", "COUNT(*) FILTER (WHERE usage_date <> CAST(usage_start_time AS DATE))"),
        ("cost", "missing_price", "COUNT(*) FILTER (WHERE unit_price IS NULL)"),
        ("cost", "missing_currency", "COUNT(*) FILTER (WHERE currency IS NULL)"),
        ("prices", "invalid_price_periods", "COUNT(*) FILTER (WHERE valid_to <= valid_from)"),
        ("audit", "missing_event_time", "COUNT(*) FILTER (WHERE event_time IS NULL)"),
        ("audit", "missing_workspace_id", "COUNT(*) FILTER (WHERE workspace_id IS NULL)"),
        ("audit", "missing_action_name", "COUNT(*) FILTER (WHERE action_name IS NULL)"),
        ("audit", "duplicate_events", "COUNT(*) - COUNT(DISTINCT audit_event_id)"),
        ("audit", "invalid_user", "COUNT(*) FILTER (WHERE user_name IS NULL)"),
        ("workspace", "duplicate_workspace_ids", "COUNT(*) - COUNT(DISTINCT workspace_id)"),
        ("workspace", "missing_workspace_names", "COUNT(*) FILTER (WHERE workspace_name IS NULL)"),
        ("workspace", "inactive_with_usage", "COUNT(*) FILTER (WHERE status = 'Inactive' AND workspace_id IN (SELECT workspace_id FROM usage))"),
        ("workspace", "missing_cost_center", "COUNT(*) FILTER (WHERE cost_center IS NULL)"),
    ]
    rows = "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS check_name, COUNT(*) AS total_records, {e} AS failed_records FROM {'price' if t == 'prices' else t}"
        for t, c, e in checks
    )
    return using("cost", "audit") + f""",
counted AS ({rows}),
judged AS (SELECT *, CASE WHEN total_records = 0 THEN 'WARN' WHEN failed_records = 0 THEN 'PASS'
                          WHEN failed_records * 10 > total_records THEN 'FAIL' ELSE 'WARN' END AS status FROM counted)
"""


@query("dq_report", _check_sql() + """SELECT *, CASE WHEN failed_records > 0 THEN failed_records || ' records failed' END AS error_message FROM judged""")
def _(i: Inputs) -> DataFrame:
    return _checks(i)


@query("dq_summary", _check_sql() + """SELECT status, COUNT(*) AS checks, CAST(SUM(failed_records) AS BIGINT) AS failed_records FROM judged GROUP BY status""")
def _(i: Inputs) -> DataFrame:
    return check_summary(_checks(i))


def _rules() -> dict:
    return {"valid_value": F.col("value") > 5, "has_user": F.col("user_id").isNotNull(), "no_error": F.col("event_type") != "error"}


@query("expectations", """
SELECT 'valid_value' AS expectation, COUNT(*) FILTER (WHERE value > 5) AS passed_rows, COUNT(*) FILTER (WHERE NOT value > 5) AS dropped_rows FROM events
UNION ALL SELECT 'has_user', COUNT(user_id), COUNT(*) - COUNT(user_id) FROM events
UNION ALL SELECT 'no_error', COUNT(*) FILTER (WHERE event_type <> 'error'), COUNT(*) FILTER (WHERE event_type = 'error') FROM events
UNION ALL SELECT 'all', COUNT(*) FILTER (WHERE value > 5 AND event_type <> 'error'), COUNT(*) FILTER (WHERE NOT (value > 5 AND event_type <> 'error')) FROM events""")
def _(i: Inputs) -> DataFrame:
    e = i.table("events")
    kept, gone = expect(e, _rules())
    a = kept.select(F.lit(1).alias("k")).unionByName(gone.select(F.lit(0).alias("k"))).agg(
        F.lit("all").alias("expectation"), F.count_if(F.col("k") == 1).alias("passed_rows"), F.count_if(F.col("k") == 0).alias("dropped_rows"))
    return expectation_counts(e, _rules()).unionByName(a)


@query("layer_row_counts", using("daily", "audit") + """
SELECT 'bronze' AS layer, 'usage' AS table_name, COUNT(*) AS row_count FROM lineitem
UNION ALL SELECT 'bronze', 'prices', COUNT(*) FROM price
UNION ALL SELECT 'silver', 'cost', COUNT(*) FROM cost
UNION ALL SELECT 'silver', 'audit', COUNT(*) FROM audit
UNION ALL SELECT 'gold', 'workspace_daily', COUNT(*) FROM daily""")
def _(i: Inputs) -> DataFrame:
    return layer_counts({
        ("bronze", "usage"): i.usage("sku"), ("bronze", "prices"): i.prices, ("silver", "cost"): i.cost(),
        ("silver", "audit"): i.audit, ("gold", "workspace_daily"): gold.workspace_daily(i.cost()),
    })
