"""Dashboard queries, governance and run monitoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.catalog.registry import AS_OF, DATE, R2, D, M, MD, PCT, TS, Inputs, query, using
from ledgerline.functions.calc import mask_email
from ledgerline.plans import anomalies, gold, governance, monitoring, serving

SUMS = f"{MD('SUM(usage_quantity)')} AS usage_quantity, {MD('SUM(estimated_cost)')} AS estimated_cost"
NOW_M, PREV_M = serving._months(AS_OF)

_HITS = """
ref AS (SELECT a.*, (SELECT CAST(SUM(b.total_cost) AS DOUBLE) / COUNT(b.total_cost) FROM daily b
                     WHERE b.workspace_id = a.workspace_id AND b.usage_date < a.usage_date AND b.usage_date >= a.usage_date - 7) AS base
        FROM daily a),
hit AS (SELECT * FROM ref WHERE base > 0 AND CAST(total_cost AS DOUBLE) > base * 1.25)"""


@query("executive_kpis", using("daily", "audit") + f""",{_HITS}
SELECT {MD(f"SUM(estimated_cost) FILTER (WHERE strftime(usage_date, '%Y-%m') = '{NOW_M}')")} AS current_month_cost,
       {MD(f"SUM(estimated_cost) FILTER (WHERE strftime(usage_date, '%Y-%m') = '{PREV_M}')")} AS previous_month_cost,
       {MD('SUM(usage_quantity)')} AS total_usage, COUNT(DISTINCT workspace_id) AS active_workspaces,
       COUNT(DISTINCT user_id) AS active_users, COUNT(DISTINCT job_id) AS total_jobs,
       (SELECT COUNT(*) FROM audit) AS total_audit_events,
       (SELECT COUNT(*) FROM audit WHERE response_status >= 400) AS failed_audit_events,
       (SELECT COUNT(*) FROM hit) AS open_anomalies
FROM cost""")
def _(i: Inputs) -> DataFrame:
    return serving.executive_kpis(i.cost("user"), i.audit, anomalies.daily_spikes(i.cost()), AS_OF)


def _kpi_sql() -> str:
    kpis = {"cost": "SUM(estimated_cost)", "usage": "SUM(usage_quantity)", "workspaces": "COUNT(DISTINCT workspace_id)",
            "users": "COUNT(DISTINCT user_id)", "jobs": "COUNT(DISTINCT job_id)"}
    rows = "\nUNION ALL ".join(
        f"SELECT '{n}' AS kpi, {D(f'(SELECT {M(e)} FROM cost WHERE {c} = {chr(39)}{NOW_M}{chr(39)})')} AS a, "
        f"{D(f'(SELECT {M(e)} FROM cost WHERE {c} = {chr(39)}{PREV_M}{chr(39)})')} AS b"
        for n, e in kpis.items() for c in ["strftime(usage_date, '%Y-%m')"])
    return using("cost") + f""", k AS ({rows})
SELECT kpi, a AS current_value, b AS previous_value, {PCT('a', 'b')} AS change_percentage, CAST(sign(a - COALESCE(b, 0)) AS INTEGER) AS trend FROM k"""


@query("kpi_compare", _kpi_sql())
def _(i: Inputs) -> DataFrame:
    return serving.kpi_compare(i.cost("user"), AS_OF)


for _grain in ("day", "week", "month"):
    query(f"cost_trend_{_grain}", using("daily") + f"""
SELECT {DATE(f"date_trunc('{_grain}', usage_date)")} AS period, {MD('SUM(total_cost)')} AS total_cost, {MD('SUM(total_usage)')} AS total_usage
FROM daily GROUP BY 1""")(lambda i, g=_grain: serving.cost_trend(gold.workspace_daily(i.cost()), g))


@query("cost_by_environment", using("daily") + f"SELECT environment, {MD('SUM(total_cost)')} AS total_cost FROM daily GROUP BY environment")
def _(i: Inputs) -> DataFrame:
    return serving.cost_by_environment(gold.workspace_daily(i.cost()))


@query("cost_by_sku", using("cost") + f"""
SELECT sku, {SUMS}, {R2(MD('SUM(estimated_cost)') + ' / (SELECT CAST(SUM(estimated_cost) AS DOUBLE) FROM cost) * 100')} AS cost_pct
FROM cost GROUP BY sku""")
def _(i: Inputs) -> DataFrame:
    return serving.cost_by_sku(gold.sku_daily(i.cost()))


@query("top_users", using("cost") + f"""
SELECT user_id AS user_name, {MD('SUM(usage_quantity)')} AS total_usage, {MD('SUM(estimated_cost)')} AS total_cost
FROM cost WHERE user_id IS NOT NULL GROUP BY user_id ORDER BY SUM(estimated_cost) DESC, user_id LIMIT 20""")
def _(i: Inputs) -> DataFrame:
    return serving.top_users(gold.user_daily(i.cost("user")))


@query("workspace_ranking", using("daily", "audit") + f""",
d AS (SELECT *, LAG(total_cost) OVER (PARTITION BY workspace_id ORDER BY usage_date) AS prev FROM daily),
dd AS (SELECT workspace_id, SUM(total_cost) AS c, SUM(total_usage) AS u, MAX({PCT('total_cost', 'prev')}) AS x FROM d GROUP BY 1),
m AS (SELECT workspace_id, strftime(usage_date, '%Y-%m') AS month, SUM(total_cost) AS c FROM daily GROUP BY ALL),
mm AS (SELECT *, LAG(c) OVER (PARTITION BY workspace_id ORDER BY month) AS prev FROM m)
SELECT w.workspace_id, w.workspace_name, w.environment, COALESCE({MD('dd.c')}, 0) AS cost, COALESCE({MD('dd.u')}, 0) AS usage,
       COALESCE(dd.x, 0) AS max_daily_pct,
       COALESCE((SELECT {PCT('c', 'prev')} FROM mm WHERE mm.workspace_id = w.workspace_id AND month = '{NOW_M}'), 0) AS mom_pct,
       (SELECT COUNT(DISTINCT user_id) FROM cost k WHERE k.workspace_id = w.workspace_id) AS users,
       (SELECT COUNT(DISTINCT job_id) FROM cost k WHERE k.workspace_id = w.workspace_id) AS jobs,
       (SELECT COUNT(*) FROM audit a WHERE a.workspace_id = w.workspace_id) AS audit_events
FROM workspace w LEFT JOIN dd ON dd.workspace_id = w.workspace_id""")
def _(i: Inputs) -> DataFrame:
    c = i.cost("user")
    return serving.workspace_ranking(
        i.workspace, gold.workspace_daily(c), gold.workspace_monthly(c), gold.user_daily(c), gold.job_daily(c),
        gold.audit_summary(i.audit), NOW_M,
    )


@query("audit_by_action", using("audit") + """
SELECT action_name, COUNT(*) AS event_count, COUNT(*) FILTER (WHERE response_status >= 400) AS failed_events FROM audit GROUP BY 1""")
def _(i: Inputs) -> DataFrame:
    return serving.audit_by_action(i.audit)


@query("audit_by_hour", using("audit") + """
SELECT CAST(hour(event_time) AS INTEGER) AS hour, COUNT(*) AS event_count, COUNT(*) FILTER (WHERE response_status >= 400) AS failed_events
FROM audit GROUP BY 1""")
def _(i: Inputs) -> DataFrame:
    return serving.audit_by_hour(i.audit)


@query("audit_overview", using("audit") + """
SELECT COUNT(*) AS total_events, COUNT(DISTINCT user_name) AS unique_users, COUNT(DISTINCT workspace_id) AS unique_workspaces,
       COUNT(*) FILTER (WHERE response_status >= 400) AS failed_events, COUNT(*) FILTER (WHERE audit_level = 'ACCOUNT') AS admin_events,
       COUNT(*) FILTER (WHERE user_type = 'servicePrincipal') AS principal_events FROM audit""")
def _(i: Inputs) -> DataFrame:
    return serving.audit_overview(i.audit)


@query("audit_breakdowns", using("audit") + "\n" + "\nUNION ALL ".join(
    f"SELECT '{n}' AS dimension, {c} AS member, COUNT(*) AS event_count, COUNT(*) FILTER (WHERE response_status >= 400) AS failed_events "
    f"FROM audit WHERE {c} IS NOT NULL GROUP BY 2"
    for n, c in {"day": "CAST(event_date AS VARCHAR)", "source_ip": "source_ip", "principal": "service_principal",
                 "workspace": "workspace_id", "action": "action_name"}.items()))
def _(i: Inputs) -> DataFrame:
    return serving.audit_breakdowns(i.audit)


_IDS = [str(n) for n in range(25)]


def _compare_sql() -> str:
    rows = "\nUNION ALL ".join(
        f"SELECT '{m}' AS metric, " + ", ".join(f"MAX({m}) FILTER (WHERE workspace_id = '{w}') AS \"{w}\"" for w in _IDS) + " FROM per"
        for m in serving.COMPARE
    )
    return using("cost", "audit") + f""",
c AS (SELECT workspace_id, {D('SUM(estimated_cost)')} AS cost, {D('SUM(usage_quantity)')} AS usage,
             COUNT(DISTINCT user_id) AS users, COUNT(DISTINCT job_id) AS jobs FROM cost GROUP BY 1),
a AS (SELECT workspace_id, COUNT(*) AS events, COUNT(*) FILTER (WHERE response_status >= 400) AS failed_events FROM audit GROUP BY 1),
per AS (SELECT w.workspace_id, cost, usage, {D('COALESCE(users, 0)')} AS users, {D('COALESCE(jobs, 0)')} AS jobs,
               {D('COALESCE(events, 0)')} AS events, {D('COALESCE(failed_events, 0)')} AS failed_events,
               CASE WHEN users > 0 THEN cost / users END AS cost_per_user, CASE WHEN jobs > 0 THEN cost / jobs END AS cost_per_job
        FROM workspace w LEFT JOIN c USING (workspace_id) LEFT JOIN a USING (workspace_id))
{rows}"""


@query("workspace_compare", _compare_sql())
def _(i: Inputs) -> DataFrame:
    ids = [r.workspace_id for r in i.workspace.select("workspace_id").collect()]
    return serving.workspace_compare(i.cost("user"), i.audit, sorted(ids, key=int))


@query("drill_rollup", using("cost") + f"""
SELECT workspace_id, sku, job_id, cluster_id, user_id,
       5 - (GROUPING(workspace_id) + GROUPING(sku) + GROUPING(job_id) + GROUPING(cluster_id) + GROUPING(user_id)) AS level, {SUMS}
FROM cost GROUP BY ROLLUP (workspace_id, sku, job_id, cluster_id, user_id)""")
def _(i: Inputs) -> DataFrame:
    return serving.drill_rollup(i.cost("user"))


@query("drill_records", using("cost") + f"""
SELECT record_id AS cost_id, {DATE('usage_date')} AS usage_date, workspace_id, sku, job_id, user_id, {D('estimated_cost')} AS estimated_cost
FROM cost WHERE environment = 'PROD' AND cloud IN ('AWS', 'GCP') AND region = 'EUROPE' AND usage_date BETWEEN DATE '1999-01-01' AND DATE '2000-06-30'""")
def _(i: Inputs) -> DataFrame:
    chosen = serving.filtered(i.cost("user"), {
        "environment": "PROD", "cloud": ["AWS", "GCP"], "region": "EUROPE", "date_range": ("1999-01-01", "2000-06-30")})
    return chosen.select("cost_id", "usage_date", "workspace_id", "sku", "job_id", "user_id", "estimated_cost")


@query("user_activity", using("cost", "audit") + f""",
c AS (SELECT workspace_id, user_id AS user_name, {MD('SUM(usage_quantity)')} AS total_usage, {MD('SUM(estimated_cost)')} AS total_cost
      FROM cost WHERE user_id IS NOT NULL GROUP BY 1, 2),
a AS (SELECT workspace_id, split_part(user_name, '@', 1) AS user_name, COUNT(*) AS n, COUNT(*) FILTER (WHERE response_status >= 400) AS f,
             MAX(event_time) AS t FROM audit WHERE user_name IS NOT NULL GROUP BY 1, 2)
SELECT workspace_id, user_name, total_usage, total_cost, COALESCE(n, 0) AS audit_events, COALESCE(f, 0) AS failed_events, {TS('t')} AS last_activity
FROM c FULL JOIN a USING (workspace_id, user_name)""")
def _(i: Inputs) -> DataFrame:
    return serving.user_activity(i.cost("user"), i.audit)


def _runs(i: Inputs) -> DataFrame:
    """events as a run log: the value is the duration in seconds."""
    ms = F.unix_micros(F.col("ts").cast("timestamp")) + F.round(F.col("value") * 1000000).cast("long")
    return i.table("events").select(
        F.concat(F.lit("job"), F.col("user_id") % 50).alias("job_id"),
        F.col("event_id").cast("string").alias("run_id"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS").alias("result_state"),
        F.col("ts").cast("timestamp").alias("start_time"), F.timestamp_micros(ms).alias("end_time"),
        F.col("event_type").alias("job_name"), F.col("value").alias("duration_seconds"),
    )


@query("job_table", using("cost") + f""",
t AS (SELECT workspace_id, job_id, COUNT(DISTINCT job_run_id) AS run_count, {MD('SUM(usage_quantity)')} AS total_usage,
             {MD('SUM(estimated_cost)')} AS total_cost FROM cost WHERE job_id IS NOT NULL GROUP BY 1, 2),
r AS (SELECT 'job' || (user_id % 50) AS job_id, COUNT(*) FILTER (WHERE event_type = 'error') AS failure_count,
             ROUND(AVG(value), 4) AS avg_duration FROM events GROUP BY 1)
SELECT workspace_id, job_id, job_id || '-name' AS job_name, run_count, total_usage, total_cost, failure_count, avg_duration,
       total_cost / run_count AS avg_cost_per_run
FROM t LEFT JOIN r USING (job_id)""")
def _(i: Inputs) -> DataFrame:
    return serving.job_table(i.cost(), _runs(i))


for _name, _key in {"cluster_table": "cluster_id", "warehouse_table": "warehouse_id"}.items():
    query(_name, using("cost") + f"""
SELECT c.workspace_id, {_key}, MAX(node_type) AS node_type, COUNT(*) AS usage_records, {MD('SUM(usage_quantity)')} AS total_usage,
       {MD('SUM(estimated_cost)')} AS total_cost, ANY_VALUE(w.environment) AS environment, ANY_VALUE(w.owner) AS owner
FROM cost c JOIN workspace w ON w.workspace_id = c.workspace_id WHERE {_key} IS NOT NULL GROUP BY 1, 2""")(
        lambda i, k=_key: serving.compute_table(i.cost(), k, i.workspace))


@query("two_measure_summary", """
SELECT l_returnflag, COUNT(*) AS line_count, ROUND(AVG(l_quantity), 1) AS avg_quantity, ROUND(AVG(l_extendedprice), 2) AS avg_price
FROM lineitem GROUP BY 1""")
def _(i: Inputs) -> DataFrame:
    return serving.two_measure_summary(i.table("lineitem"), "l_returnflag", "l_quantity", "l_extendedprice",
                                       "line_count", "avg_quantity", "avg_price")


# --- run monitoring -------------------------------------------------------------------------


@query("run_health", """
SELECT event_type AS pipeline_name, COUNT(*) AS runs, ROUND(COUNT(*) FILTER (WHERE event_type = 'error') / COUNT(*), 4) AS failure_rate,
       ANY_VALUE(CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END) AS last_status,
       ROUND(quantile_cont(value, 0.95), 4) AS p95_seconds
FROM events GROUP BY 1""")
def _(i: Inputs) -> DataFrame:
    log = _runs(i).withColumnsRenamed({"job_name": "pipeline_name", "result_state": "status"})
    return monitoring.run_health(log)


@query("job_report", f"""
SELECT 'job' || (user_id % 50) AS job_id, CAST(event_id AS VARCHAR) AS run_id,
       CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS result_state, {TS('ts')} AS start_time,
       {TS("ts + to_microseconds(CAST(ROUND(value * 1000000) AS BIGINT))")} AS end_time,
       datesub('second', ts, ts + to_microseconds(CAST(ROUND(value * 1000000) AS BIGINT))) AS duration_s
FROM events WHERE event_type = 'purchase' ORDER BY ts DESC, run_id DESC LIMIT 20""")
def _(i: Inputs) -> DataFrame:
    return monitoring.job_report(_runs(i), "purchase")


@query("query_history", f"""
SELECT doc_id AS query_id, n_chars, {TS("TIMESTAMP '2024-01-01' + to_minutes(doc_id)")} AS start_time
FROM documents WHERE text LIKE '%license%' ORDER BY doc_id DESC LIMIT 10""")
def _(i: Inputs) -> DataFrame:
    h = i.table("documents").select(
        F.col("doc_id").alias("query_id"), "n_chars", F.col("text").alias("statement_text"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 60).alias("start_time"))
    return monitoring.query_history(h, "%license%").select("query_id", "n_chars", "start_time")


@query("experiment_ranking", """
SELECT event_type AS experiment_name, user_id AS run_id, ROUND(AVG(value), 4) AS rmse, COUNT(*) AS steps
FROM events WHERE event_type = 'click' GROUP BY 1, 2""")
def _(i: Inputs) -> DataFrame:
    runs = i.table("events").groupBy(F.col("event_type").alias("experiment_name"), F.col("user_id").alias("run_id")).agg(
        F.round(F.avg("value"), 4).alias("rmse"), F.count(F.lit(1)).alias("steps"))
    return monitoring.experiment_ranking(runs, "click")


# --- governance -----------------------------------------------------------------------------


@query("mask_and_filter", """
SELECT c_custkey, c_name, '***@' || lower(c_mktsegment) || '.test' AS email, n_name AS nation
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE'""")
def _(i: Inputs) -> DataFrame:
    c, n, r = i.table("customer"), i.table("nation"), i.table("region")
    df = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).select(
        "c_custkey", "c_name",
        F.concat(F.lower(F.regexp_replace("c_name", "#", "")), F.lit("@"), F.lower("c_mktsegment"), F.lit(".test")).alias("email"),
        F.col("n_name").alias("nation"), "r_name")
    return governance.secure_view(df, "region_europe", {"email": mask_email}, F.col("r_name") == "EUROPE").drop("r_name")


@query("role_views", using("cost", "audit") + f""",
grants AS (SELECT workspace_id, owner FROM workspace)
SELECT 'platform_admin' AS role, (SELECT COUNT(*) FROM cost) AS cost_rows, (SELECT COUNT(*) FROM audit) AS audit_rows
UNION ALL SELECT 'finance', (SELECT COUNT(*) FROM cost), 0
UNION ALL SELECT 'security', 0, (SELECT COUNT(*) FROM audit)
UNION ALL SELECT 'workspace_owner', (SELECT COUNT(*) FROM cost JOIN grants USING (workspace_id) WHERE owner = 'owner3'),
                                    (SELECT COUNT(*) FROM audit JOIN grants USING (workspace_id) WHERE owner = 'owner3')
UNION ALL SELECT 'viewer', (SELECT COUNT(*) FROM cost), 0""")
def _(i: Inputs) -> DataFrame:
    cost, audit = i.cost(), i.audit
    grants = i.workspace.select("workspace_id", F.col("owner").alias("user_name"))
    out = None
    for role in ("platform_admin", "finance", "security", "workspace_owner", "viewer"):
        parts = [
            governance.role_view(kind, df, role, grants, "owner3").agg(F.count(F.lit(1)).alias("n")).scalar()
            for kind, df in (("cost", cost), ("audit", audit))
        ]
        one = i.spark.range(1).select(F.lit(role).alias("role"), parts[0].alias("cost_rows"), parts[1].alias("audit_rows"))
        out = one if out is None else out.unionByName(one)
    return out


@query("cost_view_of_owner", using("cost") + f"""
SELECT workspace_id, {SUMS} FROM cost WHERE workspace_id IN (SELECT workspace_id FROM workspace WHERE owner = 'owner1') GROUP BY 1""")
def _(i: Inputs) -> DataFrame:
    grants = i.workspace.select("workspace_id", F.col("owner").alias("user_name"))
    return gold.rollup_cost(governance.role_view("cost", i.cost(), "workspace_owner", grants, "owner1"), ["workspace_id"])
