"""The daily cost and audit batch: ingest, dimensions, facts, checks, anomalies, gold.

Large tables are folders partitioned by date. A run reads the new source rows once and writes the
touched dates of bronze. What later layers have to work on stands in a work list, so that a run
that died is made up for by the next one, whatever that one reads itself.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerline.operators.joins import broadcast_if_small
from ledgerline.operators.merge import dedup_latest
from ledgerline.operators.quality import duplicates, failing, run_checks
from ledgerline.plans import anomalies, dims, facts, gold
from ledgerline.plans.monitoring import run_steps
from ledgerline.sources.files import LINEAGE, with_lineage
from ledgerline.sources.keyindex import KeyIndex
from ledgerline.sources.tables import (
    Lake, bounded_sorts, delete_path, move_partitions, only_partitions, path_exists, replace_partitions, settings,
    upsert_partitions, write_rows,
)
from ledgerline.sources.watermarks import FIRST, advance_watermark, full_scan, incremental_scan, read_watermark
from ledgerline.sources.worklist import WorkList


@dataclass
class Sources:
    """``stored`` names the sources (usage, audit) that are files which stay as they are while a batch runs: rows of them are
    read in place where most of them are new, so they are not written once more."""

    usage: DataFrame
    prices: DataFrame
    audit: DataFrame
    stored: Sequence[str] = ()


def usage_rules() -> dict:
    q = F.col("usage_quantity")
    return {
        "missing_workspace_id": failing(F.col("workspace_id").isNull()),
        "missing_sku": failing(F.col("sku_name").isNull()),
        "negative_usage": failing(q < 0),
        "zero_usage": failing(q == 0),
        "duplicate_records": duplicates("record_id"),
        "invalid_usage_dates": failing(
            F.col("usage_date").isNull()
            | (F.col("usage_end_time") < F.col("usage_start_time"))
            | (F.col("usage_date") != F.col("usage_start_time").cast("date"))
        ),
    }


def cost_rules() -> dict:
    return {
        "missing_price": failing(F.col("unit_price").isNull()),
        "missing_currency": failing(F.col("currency").isNull()),
    }


def price_rules() -> dict:
    return {"invalid_price_periods": failing(F.col("price_end_time") <= F.col("price_start_time"))}


def audit_rules() -> dict:
    who = F.coalesce(
        "user_identity.email", "user_identity.subject_name", "identity_metadata.run_by", "identity_metadata.run_as"
    )
    return {
        "missing_event_time": failing(F.col("event_time").isNull()),
        "missing_workspace_id": failing(F.col("workspace_id").isNull()),
        "missing_action_name": failing(F.col("action_name").isNull()),
        "duplicate_events": duplicates("event_id"),
        "invalid_user": failing(who.isNull()),
    }


def workspace_rules() -> dict:
    """Over ``workspace_activity``."""
    return {
        "duplicate_workspace_ids": duplicates("workspace_id"),
        "missing_workspace_names": failing(F.col("workspace_name").isNull()),
        "inactive_with_usage": failing((F.col("status") == "Inactive") & F.col("_used").isNotNull()),
        "missing_cost_center": failing(F.col("cost_center").isNull()),
    }


def workspace_activity(workspace: DataFrame, usage: DataFrame) -> DataFrame:
    used = usage.select(F.col("workspace_id").alias("_used")).distinct()
    return workspace.join(used, F.col("workspace_id") == F.col("_used"), "left")


USAGE, AUDIT = "bronze_billing_usage", "bronze_audit_events"
STEPS = ("usage", "prices", "audit", "dimensions", "cost", "audit_fact", "rollups", "checks", "anomalies", "gold")
#: Identities that are told apart as repeated by a list sent to all tasks, and the share of rows above which that is not tried.
FEW_REPEATED, REPEATED_SHARE = 100_000, 0.05
#: Steps that work on the partitions of the work list.
LISTED = ("cost", "audit_fact", "rollups", "checks", "anomalies", "gold")


class DailyBatch:
    """One run over a lake. ``now`` stamps everything the run writes; ``grain`` is the length of a
    partition (day, month), to be chosen so that partitions are neither tiny nor huge.

    Partitions that new rows or new prices touch are listed before bronze or the price list is
    changed, and each later step strikes off what it has done; every step gives the same state when
    repeated. So a failed step is made up for by the next run, also for prices, which that run no
    longer sees as changed. Watermarks move after the last step only. Rows up to ``lookback_days``
    older than the mark are read again, which catches late ones.

    A record is known by its id and date. With ``moves`` it is known by its id alone, and an index of
    ids finds the partition that a record with a corrected date has to leave.
    """

    def __init__(
        self, lake: Lake, sources: Sources, now: dt.datetime, *, lookback_days: int = 3, grain: str = "day", first: str = FIRST,
        moves: bool = False,
    ):
        self.lake, self.src, self.now, self.lookback = lake, sources, now, lookback_days
        self.grain, self.first, self.moves = grain, first, moves
        self.batch = uuid.uuid4().hex
        self.read: dict[str, int] = {}
        self.marks: dict[str, tuple[str, str]] = {}
        self.spark = lake.spark
        self.work = WorkList(self.spark, f"{lake.root}/meta/worklist")
        self.parts: dict[str, DataFrame] = {}
        self.new: dict[str, DataFrame] = {}

    def path(self, table: str) -> str:
        return f"{self.lake.root}/facts/{table}"

    def _part(self, df: DataFrame, date: str) -> DataFrame:
        return df.withColumn("part_date", F.date_trunc(self.grain, F.col(date)).cast("date"))

    def _replace(self, table: str, rows: DataFrame, source: str, date: str) -> dict:
        """The listed partitions as a whole; those left without rows are removed."""
        seen = Observation()
        rows = self._part(rows, date).observe(seen, F.count(F.lit(1)).alias("inserted"))
        replace_partitions(self.path(table), rows, "part_date", self.parts[source])
        return {"inserted": int(seen.get["inserted"])}

    def fact(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(table))

    def _ingest(self, src: DataFrame, column: str, key: str, date: str, table: str, stored: bool) -> dict:
        mark = read_watermark(self.lake, f"ingest_{table}", table, self.first)
        batch = incremental_scan(src, column, mark, self.lookback)
        identity = [key] if self.moves else [key, date]
        look = [
            F.count(F.lit(1)).alias("n"), F.max(column).cast("string").alias("top"),
            F.approx_count_distinct(F.xxhash64(*identity), 0.01).alias("identities"),
        ]
        seen = batch.agg(*look).first() if stored else None
        # The batch is read by several steps, so it is written once and read from there.
        if seen is None or 2 * seen.n < src.count():
            batch = write_rows(batch, f"{self.lake.root}/staging/{table}-{self.batch}")
            seen = seen or batch.agg(*look).first()
        self.new[table] = batch
        self.read[table] = seen.n
        if not seen.n:
            return {"read": 0, "inserted": 0, "updated": 0}
        # The latest arrival first, where the source says when that was.
        arrival = [F.desc(c) for c in ("ingestion_date",) if self.moves and c in batch.columns]
        bare = batch.drop(*LINEAGE)
        order = [*arrival, F.desc(column), *[F.desc(c) for c, k in bare.dtypes if not k.startswith("map")]]
        latest = self._latest(bare, identity, order, table, seen.n - seen.identities > REPEATED_SHARE * seen.n)
        latest = self._part(with_lineage(latest, table, self.batch, self.now), date)
        path, sorts = self.path(table), bounded_sorts(self.spark, seen.n)
        index = KeyIndex(self.spark, f"{self.lake.root}/meta/index/{table}", key)
        self.marks[table] = (column, seen.top)
        if not path_exists(self.spark, path):
            # With nothing to merge with, rows are written where they stay. Only their partitions are known before.
            parts = self.work.listing(self.work.add(table, self._part(batch, date).select("part_date")))
            with settings(self.spark, sorts):
                done = upsert_partitions(self.spark, path, latest, [key, date], "part_date", parts, unique_source=True)
            if self.moves:
                index.record(self.fact(table).withColumn("part_date", F.col("part_date").cast("date")))
            return {"read": seen.n, **done}
        # Written too: merge, work list and index read it, mostly a few columns of it.
        kept = f"{self.lake.root}/staging/{table}-kept-{self.batch}"
        with settings(self.spark, sorts):
            one = write_rows(latest, kept)
        parts = one.select("part_date")
        if not self.moves:
            self.work.add(table, parts)
            done = upsert_partitions(self.spark, path, one, [key, date], "part_date", unique_source=True)
        else:
            gone = f"{self.lake.root}/staging/{table}-moved-{self.batch}"
            index.moved(one.select(key, "part_date")).write.parquet(gone)
            moved = self.spark.read.parquet(gone)
            self.work.add(table, parts.union(moved.select("part_date")))
            done = move_partitions(self.spark, path, one, key, "part_date", moved)
            # After the records themselves: until then the index says where a rerun finds the old ones.
            index.record(one)
        return {"read": seen.n, **done}

    def _latest(self, rows: DataFrame, identity: list[str], order: list[Column], table: str, many: bool) -> DataFrame:
        """One row for each identity. Unless ``many`` repeat, only rows of those that do are shuffled as a whole."""
        if many:
            return dedup_latest(rows, identity, order)
        path, seen = f"{self.lake.root}/staging/{table}-repeated-{self.batch}", Observation()
        names = [F.col(c).alias(f"_k_{c}") for c in identity]
        repeated = rows.select(*names).repartition(*[f"_k_{c}" for c in identity])
        repeated = repeated.groupBy(*repeated.columns).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
        repeated.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
        if seen.get["n"] > FEW_REPEATED:
            return dedup_latest(rows, identity, order)
        on = F.lit(True)
        for c in identity:
            on = on & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
        repeated = F.broadcast(self.spark.read.parquet(path))
        return rows.join(repeated, on, "left_anti").unionByName(dedup_latest(rows.join(repeated, on, "left_semi"), identity, order))

    def usage(self) -> dict:
        return self._ingest(self.src.usage, "usage_start_time", "record_id", "usage_date", USAGE, "usage" in self.src.stored)

    def audit(self) -> dict:
        return self._ingest(self.src.audit, "event_time", "event_id", "event_date", AUDIT, "audit" in self.src.stored)

    def prices(self) -> dict:
        name = "bronze/bronze_billing_prices"
        rows = with_lineage(full_scan(self.src.prices, "list_prices"), "list_prices", self.batch, self.now)
        if self.lake.exists(name) and path_exists(self.spark, self.path(USAGE)):
            # Listed first: once the new list is stored, no later run finds a change.
            self.work.add(USAGE, self._repriced(self.lake.read(name), self.fact(USAGE)))
        return self.lake.merge(name, rows, ["sku_name", "cloud", "price_start_time"])

    def _repriced(self, stored: DataFrame, usage: DataFrame) -> DataFrame:
        """Partitions with usage in the period of a new or changed price, before or after the change."""
        key = ["sku_name", "cloud", "price_start_time"]
        before, after = facts.price_list(stored), facts.price_list(self.src.prices)
        changed = after.exceptAll(before)
        periods = changed.unionByName(before.join(changed.select(*key), key, "left_semi"))
        # Found once and counted, so that usage, of which all sales of an article meet, is not shuffled to a short list.
        periods = write_rows(periods.select(*key, "price_end_time").distinct(), f"{self.lake.root}/staging/{USAGE}-repriced-{self.batch}")
        periods = broadcast_if_small(periods)[0].alias("p")
        start, end, at = F.col("p.price_start_time"), F.col("p.price_end_time"), F.col("u.usage_start_time")
        on = (F.col("u.sku_name") == F.col("p.sku_name")) & (F.col("u.cloud") == F.col("p.cloud"))
        on = on & (at >= start) & (end.isNull() | (at < end))
        return usage.alias("u").join(periods, on, "left_semi").select("part_date").distinct()

    def dimensions(self) -> dict:
        lk = self.lake
        lk.insert_missing("dims/dim_environment", dims.environments(self.spark), ["environment"])
        usage, audit = self.new[USAGE], self.new[AUDIT]
        found = dims.discovered_workspaces(usage, audit)
        empty = ["workspace_name", "environment", "region", "business_unit", "department", "cost_center", "owner"]
        found = found.withColumns({c: F.lit(None).cast("string") for c in empty})
        done = lk.merge("dims/dim_workspace", found, ["workspace_id"], unique_source=True, **dims.WORKSPACE_REFRESH)
        if self.read[USAGE]:
            lk.insert_missing("dims/dim_sku", dims.skus(usage), ["sku"])
            lk.insert_missing("dims/dim_user", dims.billing_users(usage), ["user_id"])
        if self.read[AUDIT]:
            lk.insert_missing("dims/dim_user", dims.audit_users(audit), ["user_id"])
        return done

    def _listed(self, source: str) -> bool:
        return not self.parts[source].isEmpty()

    def _touched(self, source: str, table: str | None = None) -> DataFrame:
        """Rows of the partitions that the work list has for the present step: a plain partition filter."""
        return only_partitions(self.fact(table or source), self.parts[source], "part_date")

    def _from_list(self, step: str):
        """The step, given the partitions it has to work on; struck off when it has succeeded."""

        def run() -> dict:
            upto = self.work.last()
            pending = self.work.pending(step, upto)
            self.parts = {t: pending.filter(F.col("source") == t).select("part_date") for t in (USAGE, AUDIT)}
            done = getattr(self, step)()
            self.work.strike(step, upto)
            return done

        return run

    def cost(self) -> dict:
        if not self._listed(USAGE):
            return {}
        w = self.lake.read("dims/dim_workspace")
        self._replace("silver_billing_usage", facts.silver_usage(self._touched(USAGE), w), USAGE, "usage_date")
        silver = self._touched(USAGE, "silver_billing_usage")
        cost = facts.cost_fact(silver, self.lake.read("bronze/bronze_billing_prices"), w)
        return self._replace("fact_cost", cost, USAGE, "usage_date")

    def audit_fact(self) -> dict:
        if not self._listed(AUDIT):
            return {}
        rows = facts.audit_fact(self._touched(AUDIT), self.lake.read("dims/dim_workspace"))
        return self._replace("fact_audit_event", rows, AUDIT, "event_date")

    def rollups(self) -> dict:
        """Daily aggregates of the touched partitions, replaced as a whole."""
        out = []
        if self._listed(USAGE):
            cost = self._touched(USAGE, "fact_cost")
            warehouse = ["usage_date", "workspace_id", "warehouse_id"]
            out += [
                ("workspace_day", "usage_date", gold.workspace_day(cost)),
                ("gold_sku_cost", "usage_date", gold.sku_daily(cost)),
                ("gold_user_cost", "usage_date", gold.user_daily(cost)),
                ("gold_job_cost", "usage_date", gold.job_daily(cost)),
                ("gold_cluster_cost", "usage_date", gold.cluster_daily(cost)),
                ("warehouse_day", "usage_date", gold.rollup_cost(cost, warehouse, not_null="warehouse_id")),
                ("fact_cost_allocation", "allocation_date", facts.allocate(cost, facts.TAGS)),
            ]
        if self._listed(AUDIT):
            audit = self._touched(AUDIT, "fact_audit_event")
            out.append(("gold_audit_summary", "event_date", gold.audit_summary(audit)))
        for table, date, rows in out:
            source = AUDIT if table == "gold_audit_summary" else USAGE
            replace_partitions(self.path(table), self._part(rows, date), "part_date", self.parts[source])
        return {}

    def checks(self) -> dict:
        """The rules over the partitions of this run; prices and workspaces as a whole."""
        run = uuid.uuid4().hex
        usage, audit, w = USAGE, AUDIT, self.lake.read("dims/dim_workspace")
        todo = [(self.lake.read("bronze/bronze_billing_prices"), "bronze_billing_prices", price_rules())]
        if self._listed(usage):
            todo += [
                (self._touched(usage), usage, usage_rules()),
                (self._touched(usage, "fact_cost"), "fact_cost", cost_rules()),
                (workspace_activity(w, self._touched(usage)), "dim_workspace", workspace_rules()),
            ]
        if self._listed(audit):
            todo.append((self._touched(audit), audit, audit_rules()))
        log = None
        for df, name, rules in todo:
            one = run_checks(df, name, rules, run, self.now)
            log = one if log is None else log.unionByName(one)
        self.lake.append("meta/dq_execution_log", log)
        mine = self.lake.read("meta/dq_execution_log").filter(F.col("dq_run_id") == run)
        counts = {r.status: r.n for r in mine.groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect()}
        return {"read": sum(counts.values()), "rejected": counts.get("FAIL", 0)}

    def anomalies(self) -> dict:
        """Detected on the daily aggregates, which carry the same sums as the fact."""
        if not self._listed(USAGE):
            return {}
        day, sku = self.fact("workspace_day"), self.fact("gold_sku_cost")
        resources = {"job_id": "gold_job_cost", "cluster_id": "gold_cluster_cost", "warehouse_id": "warehouse_day"}
        names = self.lake.read("dims/dim_workspace").select("workspace_id", "workspace_name")
        rows = anomalies.anomaly_rows(
            anomalies.daily_spikes(day),
            anomalies.sku_spikes(sku.join(names, "workspace_id", "left")),
            anomalies.usage_spikes(day),
            *[anomalies.resource_spikes(self.fact(t), r) for r, t in resources.items()],
            anomalies.weekend_usage(day),
        ).withColumn("detected_timestamp", F.lit(self.now).cast("timestamp"))
        return self.lake.merge("silver/fact_cost_anomaly", rows, ["anomaly_id"], **anomalies.KEEP_STATUS)

    def gold(self) -> dict:
        """Changes against the previous day and month, from one row per workspace and day."""
        if not self._listed(USAGE):
            return {}
        day = self.fact("workspace_day")
        self.lake.overwrite("gold/gold_workspace_daily_cost", gold.workspace_daily(day))
        self.lake.overwrite("gold/gold_workspace_monthly_cost", gold.workspace_monthly(day))
        return {}

    def run(self, steps: Sequence[str] = STEPS) -> list[dict]:
        """All steps, or some in their order; what those left out would have done stays on the work list."""
        done = run_steps(self.lake, "daily", [(s, self._from_list(s) if s in LISTED else getattr(self, s)) for s in steps])
        for table, (column, top) in self.marks.items():
            advance_watermark(self.lake, f"ingest_{table}", table, column, top, self.now)
        self.work.forget(LISTED)
        for table in (USAGE, AUDIT):
            for kind in ("", "kept-", "repeated-", "moved-", "repriced-"):
                delete_path(self.spark, f"{self.lake.root}/staging/{table}-{kind}{self.batch}")
        return done
