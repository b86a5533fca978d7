"""Column expressions shared by the jobs. All of them stay on the JVM."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Quantities and unit prices carry six decimals, so their product is exact with twelve.
QUANTITY = "decimal(18,6)"
MONEY = "decimal(28,6)"
PERCENT = "decimal(10,2)"


def money(col: Column) -> Column:
    return col.cast(MONEY)


def percent(ratio: Column) -> Column:
    """A ratio in percent, rounded half up by its decimal digits; NULL if it does not fit."""
    return F.round((ratio * 100).try_cast("decimal(28,10)"), 2).try_cast(PERCENT)


def change_pct(current: Column, previous: Column) -> Column:
    """Percent change; NULL unless the previous value is positive (or if it does not fit)."""
    cur, prev = current.cast("double"), previous.cast("double")
    return F.when(prev > 0, percent((cur - prev) / prev))


def trend_sign(current: Column, previous: Column) -> Column:
    return F.signum(current.cast("double") - F.coalesce(previous.cast("double"), F.lit(0.0))).cast("int")


def estimated_cost(quantity: Column, unit_price: Column) -> Column:
    """The computed column of the cost fact, exact for six-decimal inputs."""
    return quantity.cast(QUANTITY) * unit_price.cast(QUANTITY)


def surrogate_key(*cols) -> Column:
    """MD5 over all columns. NULL and the empty string give different digests."""
    parts = [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("~")) for c in _cols(cols)]
    return F.md5(F.concat_ws("|", *parts))


def joined_key(*cols) -> Column:
    """MD5 over the non-NULL columns, separated by a bar."""
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in _cols(cols)]))


def clean_upper(col: Column) -> Column:
    return F.upper(F.trim(col))


def clean_lower(col: Column) -> Column:
    return F.lower(F.trim(col))


def mask_email(col: Column) -> Column:
    """Keep the part after the at sign only."""
    return F.concat(F.lit("***@"), F.split_part(col, F.lit("@"), F.lit(2)))


# Fixed value: the pattern of an e-mail address.
EMAIL_PATTERN = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"


def extract_emails(text: Column) -> Column:
    """All e-mail addresses of a text, in order of appearance."""
    return F.regexp_extract_all(text, F.lit(EMAIL_PATTERN), F.lit(0))


# Lower bounds of the salary bands.
HIGH_FROM = 75000
MEDIUM_FROM = 60000


def salary_band(salary: Column, unknown: str | None = "Unknown") -> Column:
    band = F.when(salary >= HIGH_FROM, "High").when(salary >= MEDIUM_FROM, "Medium").otherwise("Low")
    return band if unknown is None else F.when(salary.isNull(), unknown).otherwise(band)


def tag(tags: Column, *names: str) -> Column:
    """First present value among several spellings of a tag."""
    return F.coalesce(*[F.try_element_at(tags, F.lit(n)) for n in names])


def min_max_norm(df: DataFrame, col: str, out: str, keys: list[str] | None = None) -> DataFrame:
    """Scale to 0..1 over the whole table, or per key.

    The bounds come from an aggregate, so the result does not depend on batch sizes. Without
    keys they are one row, read as a scalar subquery; the large side is never shuffled.
    """
    bounds = F.struct(F.min(col).alias("lo"), F.max(col).alias("hi"))
    if keys:
        per_key = df.groupBy(*keys).agg(bounds.alias("_b"))
        df, b = df.join(per_key, keys, "left"), F.col("_b")
    else:
        b = df.agg(bounds.alias("_b")).scalar()
        df = df.withColumn("_b", b)
        b = F.col("_b")
    span = b["hi"] - b["lo"]
    return df.withColumn(out, F.when(span > 0, (F.col(col) - b["lo"]) / span)).drop("_b")


def parse_or_reject(df: DataFrame, casts: Mapping[str, str], rejects: str = "_rejects") -> DataFrame:
    """Cast text columns; a value that does not parse becomes NULL and its column is listed."""
    out = df
    bad = []
    for name, kind in casts.items():
        typed = F.col(name).try_cast(kind)
        bad.append(F.when(F.col(name).isNotNull() & typed.isNull(), F.lit(name)))
    out = out.withColumn(rejects, F.array_compact(F.array(*bad)))
    return out.withColumns({n: F.col(n).try_cast(k) for n, k in casts.items()})


def local_time(col: Column, zone: str) -> Column:
    """Show a UTC stamp in another zone."""
    return F.from_utc_timestamp(col, zone)


def register_sql_functions(spark: SparkSession) -> None:
    """SQL functions for interactive use: a Python one, a masking one and a pure SQL one."""

    def band(salary):
        if salary is None:
            return "Unknown"
        return "High" if salary >= 75000 else "Medium" if salary >= 60000 else "Low"

    spark.udf.register("salary_band_py", band, T.StringType())
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION salary_band(amount DOUBLE) RETURNS STRING RETURN "
        f"CASE WHEN amount >= {HIGH_FROM} THEN 'High' WHEN amount >= {MEDIUM_FROM} THEN 'Medium' ELSE 'Low' END"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION mask_email(address STRING) RETURNS STRING "
        "RETURN '***@' || split_part(address, '@', 2)"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION region_allowed(region STRING, member_of STRING) RETURNS BOOLEAN "
        "RETURN region IS NOT NULL AND region = member_of"
    )


def bounded_rows(df: DataFrame, limit: int) -> int | None:
    """The row count if it is at most ``limit``, else None. Reads no further than the limit."""
    n = df.limit(limit + 1).count()
    return n if n <= limit else None


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]
