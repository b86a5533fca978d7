"""Registration, presentation of results, and the SQL view of the domain tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.plans import facts
from ledgerline.sources import domain
from ledgerline.sources.tables import Lake
from ledgerline.session import work_root

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# The day that period queries look back from, and the stamp of written rows.
AS_OF = dt.date(2001, 6, 15)
NOW = dt.datetime(2024, 2, 1)


class Inputs:
    """The source frames of one data folder, built on demand."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def table(self, name: str) -> DataFrame:
        return domain.table(self.spark, self.root, name)

    @cached_property
    def workspace(self) -> DataFrame:
        return domain.workspaces(self.spark, self.root)

    @cached_property
    def prices(self) -> DataFrame:
        return domain.prices(self.spark, self.root)

    def usage(self, *parts: str) -> DataFrame:
        return domain.usage(self.spark, self.root, parts or domain.ALL_PARTS)

    def silver(self, *parts: str) -> DataFrame:
        return facts.silver_usage(self.usage(*parts), self.workspace)

    def cost(self, *parts: str) -> DataFrame:
        """The cost fact; price and workspace are always there, the user on demand."""
        return facts.cost_fact(self.silver("sku", "workspace", *parts), self.prices, self.workspace)

    @cached_property
    def audit_raw(self) -> DataFrame:
        return domain.audit(self.spark, self.root)

    @cached_property
    def audit(self) -> DataFrame:
        return facts.audit_fact(self.audit_raw, self.workspace)

    def lake(self) -> Lake:
        return Lake(self.spark, work_root(self.spark, "lake"))

    def folder(self, label: str) -> str:
        return work_root(self.spark, label)


def present(df: DataFrame) -> DataFrame:
    """Plain column types: decimals as doubles, dates and times as ISO text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        kind = f.dataType.typeName()
        if kind == "decimal":
            c = c.cast("double")
        elif kind == "date":
            c = c.cast("string")
        elif kind.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Inputs], DataFrame]):
        QUERIES[name] = lambda spark, root: present(build(Inputs(spark, root)))
        if sql is not None:
            ORACLE[name] = sql.strip()
        return build

    return register


# --- SQL side -------------------------------------------------------------------------------


def D(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def M(x: str) -> str:
    return f"CAST({x} AS DECIMAL(28,6))"


def MD(x: str) -> str:
    return D(M(x))


def DATE(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def TS(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def R2(x: str) -> str:
    """Round a double to two digits by its decimal digits."""
    return f"CAST(ROUND(CAST({x} AS DECIMAL(28,10)), 2) AS DOUBLE)"


def PCT(cur: str, prev: str) -> str:
    """Percent change of two columns."""
    change = R2(f"(CAST({cur} AS DOUBLE) - {prev}) / CAST({prev} AS DOUBLE) * 100")
    return f"CASE WHEN {prev} > 0 THEN {change} END"


_WORKSPACE = """
workspace AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS workspace_id,
         CASE WHEN n_nationkey % 8 <> 7 THEN n_name END AS workspace_name,
         ['AWS', 'AZURE', 'GCP'][n_nationkey % 3 + 1] AS cloud,
         r_name AS region,
         ['DEV', 'TEST', 'UAT', 'PROD'][n_nationkey % 4 + 1] AS environment,
         'BU' || (n_nationkey % 5) AS business_unit,
         'DEP' || (n_nationkey % 6) AS department,
         CASE WHEN n_nationkey % 10 <> 9 THEN 'CC' || (n_nationkey % 7) END AS cost_center,
         'owner' || (n_nationkey % 5) AS owner,
         CASE WHEN n_nationkey = 24 THEN 'Inactive' ELSE 'Active' END AS status
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

_USAGE = """
usage AS (
  SELECT l_orderkey || '-' || l_linenumber AS record_id,
         CAST(s_nationkey AS VARCHAR) AS workspace_id,
         ['AWS', 'AZURE', 'GCP'][s_nationkey % 3 + 1] AS cloud,
         p_type AS sku, l_shipdate AS usage_start_time, CAST(l_shipdate AS DATE) AS usage_date,
         CAST(l_quantity AS DECIMAL(18,6)) AS usage_quantity, l_linestatus AS product,
         CASE WHEN l_orderkey % 4 = 0 THEN 'job' || (l_partkey % 50) END AS job_id,
         CASE WHEN l_orderkey % 4 = 0 THEN CAST(l_orderkey AS VARCHAR) END AS job_run_id,
         CASE WHEN l_orderkey % 4 = 1 THEN 'cl' || (l_suppkey % 20) END AS cluster_id,
         CASE WHEN l_orderkey % 4 = 2 THEN 'wh' || (l_suppkey % 7) END AS warehouse_id,
         'node' || l_linenumber AS node_type,
         CASE WHEN l_linenumber <> 7 THEN 'user' || (o_custkey % 200) END AS user_id,
         CASE WHEN l_returnflag = 'R' THEN 'sp' || (l_suppkey % 10) END AS principal,
         CASE WHEN l_partkey % 3 = 0 THEN p_brand END AS project,
         CASE WHEN l_partkey % 3 = 0 THEN l_returnflag END AS tag_owner
  FROM lineitem
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN part ON l_partkey = p_partkey
  JOIN orders ON l_orderkey = o_orderkey)"""

_PRICE = """
part_type AS (SELECT p_type, MIN(p_size) AS size FROM part GROUP BY p_type),
price AS (
  SELECT p_type AS sku, ['AWS', 'AZURE', 'GCP'][k + 1] AS cloud, y AS price_year,
         make_timestamp(y, 1, 1, 0, 0, 0) AS valid_from,
         CASE WHEN y < 2001 THEN make_timestamp(y + 1, 1, 1, 0, 0, 0) END AS valid_to,
         CAST(ROUND((100 + size + 3 * (y - 1995) + k) / 1000, 3) AS DECIMAL(18,6)) AS unit_price
  FROM part_type, (SELECT UNNEST(range(1995, 2002)) AS y), (SELECT UNNEST(range(0, 3)) AS k)
  WHERE NOT (y = 1996 AND p_type = (SELECT MIN(p_type) FROM part)))"""

_COST = """
cost AS (
  SELECT u.*, p.unit_price, CASE WHEN p.unit_price IS NOT NULL THEN 'USD' END AS currency,
         u.usage_quantity * p.unit_price AS estimated_cost,
         w.workspace_name, w.environment, w.region, w.business_unit, w.department, w.cost_center
  FROM usage u
  LEFT JOIN price p ON p.sku = u.sku AND p.cloud = u.cloud AND u.usage_start_time >= p.valid_from
       AND (p.valid_to IS NULL OR u.usage_start_time < p.valid_to)
  LEFT JOIN workspace w ON w.workspace_id = u.workspace_id)"""

_AUDIT = """
audit AS (
  SELECT CAST(event_id AS VARCHAR) AS audit_event_id, ts AS event_time, CAST(ts AS DATE) AS event_date,
         CAST(user_id % 25 AS VARCHAR) AS workspace_id,
         CASE WHEN user_id % 10 <> 3 THEN 'user' || user_id || '@corp.test'
              WHEN user_id % 20 <> 3 THEN 'subject' || user_id
              WHEN user_id % 11 <> 0 THEN 'user' || user_id
              ELSE CASE WHEN user_id % 7 = 0 THEN 'sp' || user_id WHEN user_id % 7 < 4 THEN 'user' || user_id END
         END AS user_name,
         CASE WHEN user_id % 7 = 0 AND user_id % 11 <> 0 THEN 'servicePrincipal' ELSE 'user' END AS user_type,
         CASE WHEN user_id % 7 = 0 THEN 'sp' || user_id WHEN user_id % 7 < 4 THEN 'user' || user_id END AS service_principal,
         event_type AS action_name, '10.0.' || (user_id % 4) || '.' || (user_id % 50) AS source_ip,
         CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS response_status,
         CASE WHEN user_id % 25 = 0 THEN 'ACCOUNT' ELSE 'WORKSPACE' END AS audit_level,
         CASE WHEN user_id % 10 <> 3 THEN 'user' || user_id || '@corp.test' END AS email,
         json_extract_string(props, '$.k') AS param_k
  FROM events)"""

_DAILY = f"""
daily AS (
  SELECT usage_date, workspace_id, MAX(workspace_name) AS workspace_name, MAX(environment) AS environment,
         {M('SUM(usage_quantity)')} AS total_usage, {M('SUM(estimated_cost)')} AS total_cost
  FROM cost GROUP BY usage_date, workspace_id)"""

_PARTS = {
    "workspace": ([], _WORKSPACE), "usage": ([], _USAGE), "price": ([], _PRICE),
    "cost": (["workspace", "usage", "price"], _COST), "audit": ([], _AUDIT), "daily": (["cost"], _DAILY),
}


def using(*names: str) -> str:
    """``WITH`` clause that defines the named domain tables and what they need."""
    order: list[str] = []

    def add(n: str) -> None:
        for dep in _PARTS[n][0]:
            add(dep)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "WITH " + ",".join(_PARTS[n][1] for n in order)
