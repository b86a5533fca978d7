"""Data-quality rules, expectations and row counts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAIL_SHARE = 0.1


def duplicates(column: str) -> Column:
    """Rows beyond the first of each key; NULL keys count as failures."""
    return F.count(F.lit(1)) - F.count_distinct(F.col(column))


def failing(predicate: Column) -> Column:
    return F.count_if(predicate)


def check_status(total: Column, failed: Column) -> Column:
    return (
        F.when(total == 0, "WARN")
        .when(failed == 0, "PASS")
        .when(failed > total * F.lit(FAIL_SHARE), "FAIL")
        .otherwise("WARN")
    )


def run_checks(
    df: DataFrame, table_name: str, rules: Mapping[str, Column], run_id: str | None = None, run_at=None
) -> DataFrame:
    """One log row per rule, from a single pass over the table.

    Each rule is an aggregate that counts failing rows: ``failing(predicate)`` or ``duplicates(key)``.
    """
    once = df.agg(F.count(F.lit(1)).alias("_total"), *[r.alias(f"_{n}") for n, r in rules.items()])
    rows = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(f"_{n}").alias("failed_records")) for n in rules])
    flat = once.select(F.col("_total").alias("total_records"), F.explode(rows).alias("_r"))
    total, failed = F.col("total_records"), F.col("_r.failed_records")
    out = flat.select(
        F.lit(table_name).alias("table_name"),
        F.col("_r.check_name").alias("check_name"),
        total,
        failed.alias("failed_records"),
        check_status(total, failed).alias("status"),
        F.when(failed > 0, F.concat(failed.cast("string"), F.lit(" records failed"))).alias("error_message"),
    )
    if run_id is None:
        return out
    return out.select(
        F.lit(run_id).alias("dq_run_id"), F.lit(run_at).cast("timestamp").alias("execution_timestamp"), "*"
    )


def check_summary(log: DataFrame) -> DataFrame:
    return log.groupBy("status").agg(F.count(F.lit(1)).alias("checks"), F.sum("failed_records").alias("failed_records"))


def expect(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Split into rows that meet all expectations and rows that do not, with the names they miss.

    A predicate that is NULL counts as missed.
    """
    missed = F.array_compact(F.array(*[F.when(~F.coalesce(p, F.lit(False)), F.lit(n)) for n, p in rules.items()]))
    tagged = df.withColumn("_missed", missed)
    return tagged.filter(F.size("_missed") == 0).drop("_missed"), tagged.filter(F.size("_missed") > 0)


def expectation_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Per expectation: rows kept and rows dropped, in one pass."""
    once = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.coalesce(p, F.lit(False))).alias(f"_{n}") for n, p in rules.items()],
    )
    rows = F.array(*[F.struct(F.lit(n).alias("expectation"), F.col(f"_{n}").alias("passed_rows")) for n in rules])
    return once.select("_n", F.explode(rows).alias("_r")).select(
        "_r.expectation", "_r.passed_rows", (F.col("_n") - F.col("_r.passed_rows")).alias("dropped_rows")
    )


def layer_counts(tables: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """Row count per (layer, table)."""
    out = None
    for (layer, name), df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count"
        )
        out = one if out is None else out.unionByName(one)
    return out
