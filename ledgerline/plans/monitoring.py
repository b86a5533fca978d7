"""Run log, step runner and run reports."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.ordered import exact_percentile
from ledgerline.plans.specs import SPECS
from ledgerline.sources.tables import Lake

LOG = "meta/framework_execution_log"


def log_run(
    lake: Lake, name: str, step: str, start: dt.datetime, end: dt.datetime, metrics: dict, status: str, error: str | None
) -> None:
    row = (
        uuid.uuid4().hex, name, step, start, end, (end - start).total_seconds(), metrics.get("read"),
        metrics.get("inserted"), metrics.get("updated"), metrics.get("rejected"), status, error,
    )
    nullable = SPECS[LOG].ddl.replace(" not null", "")
    lake.append(LOG, lake.spark.createDataFrame([row], nullable))


def run_steps(lake: Lake, name: str, steps: Sequence[tuple[str, Callable[[], dict | None]]]) -> list[dict]:
    """Run steps in order. Each leaves a log row, the failing one too; then its error goes on."""
    done = []
    for step, action in steps:
        start = dt.datetime.now()
        try:
            metrics = action() or {}
        except Exception as e:
            log_run(lake, name, step, start, dt.datetime.now(), {}, "FAILED", str(e))
            raise
        end = dt.datetime.now()
        log_run(lake, name, step, start, end, metrics, "SUCCESS", None)
        done.append({"step": step, "seconds": (end - start).total_seconds(), **metrics})
    return done


def run_health(log: DataFrame, block: Column | None = None) -> DataFrame:
    """Runs, failure share, last status and 95th percentile of the duration, per pipeline."""
    last = F.max(F.struct("start_time", "run_id", "status"))
    per = log.groupBy("pipeline_name").agg(
        F.count(F.lit(1)).alias("runs"),
        F.round(F.count_if(F.col("status") != "SUCCESS") / F.count(F.lit(1)), 4).alias("failure_rate"),
        last["status"].alias("last_status"),
    )
    block = F.floor("duration_seconds") if block is None else block
    p95 = exact_percentile(log, ["pipeline_name"], "duration_seconds", 0.95, block, "p95_seconds")
    return per.join(p95, "pipeline_name", "left").withColumn("p95_seconds", F.round("p95_seconds", 4))


def job_report(runs: DataFrame, job_name: str | None = None, n: int = 20) -> DataFrame:
    """The newest runs with their duration in seconds."""
    if job_name is not None:
        runs = runs.filter(F.col("job_name") == job_name)
    seconds = F.timestamp_diff("SECOND", F.col("start_time"), F.col("end_time"))
    return runs.select("job_id", "run_id", "result_state", "start_time", "end_time", seconds.alias("duration_s")).orderBy(
        F.desc("start_time"), F.desc("run_id")
    ).limit(n)


def query_history(history: DataFrame, pattern: str, n: int = 10) -> DataFrame:
    """The newest statements whose text matches a LIKE pattern."""
    return history.filter(F.col("statement_text").like(pattern)).orderBy(F.desc("start_time"), F.desc("query_id")).limit(n)


def experiment_ranking(runs: DataFrame, experiment: str, metric: str = "rmse") -> DataFrame:
    """Runs of an experiment, best metric first."""
    return runs.filter(F.col("experiment_name") == experiment).orderBy(F.asc_nulls_last(metric), "run_id")
