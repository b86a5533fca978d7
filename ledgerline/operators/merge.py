"""Keyed table changes: upsert, insert-only merge, change feed, de-duplication."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACTION = "_action"


def dedup_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """One row per key: the first under ``order_by``; give an order that is total.

    Spark turns the ``= 1`` filter into a group limit that runs before the shuffle, so a hot key
    sends one row per task and not its whole group.
    """
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def one_row_per_key(source: DataFrame, keys: Sequence[str], prefix: str, present: str) -> DataFrame:
    """Prefix the columns and fail the job when a key occurs twice.

    The check is a partial aggregate: copies of a hot key meet inside the map tasks.
    """
    rest = [c for c in source.columns if c not in keys]
    grouped = source.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), *[F.any_value(c).alias(f"{prefix}{c}") for c in rest]
    )
    message = F.concat(F.lit("merge source has several rows for key "), F.to_json(F.struct(*keys)))
    return grouped.select(
        *[F.col(k).alias(f"{prefix}{k}") for k in keys],
        *[f"{prefix}{c}" for c in rest],
        F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)).alias(present),
    )


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    update: Mapping[str, Callable[[Callable, Callable], Column]] | None = None,
    when_matched: Callable[[Callable, Callable], Column] | None = None,
    insert: bool = True,
    null_safe: bool = True,
    unique_source: bool = False,
) -> DataFrame:
    """The state of ``target`` after merging ``source``, with an ``_action`` column.

    * ``update`` maps a column to ``f(t, s)`` where ``t('c')`` and ``s('c')`` read the two sides;
      without it every source column overwrites.
    * ``when_matched`` is a condition on matched rows, else they are kept.
    * New source columns are added (NULL for untouched rows); absent ones keep their value.
    * ``unique_source`` skips the duplicate-key check for a source that is already de-duplicated.

    ``_action`` is ``insert``, ``update`` or ``keep``.
    """
    keys = list(keys)
    left = target.select(*[F.col(c).alias(f"_t_{c}") for c in target.columns], F.lit(True).alias("_in_t"))
    if unique_source:
        right = source.select(*[F.col(c).alias(f"_s_{c}") for c in source.columns], F.lit(True).alias("_in_s"))
    else:
        right = one_row_per_key(source, keys, "_s_", "_in_s")

    def t(name: str) -> Column:
        return F.col(f"_t_{name}")

    def s(name: str) -> Column:
        return F.col(f"_s_{name}")

    on = None
    for k in keys:
        same = t(k).eqNullSafe(s(k)) if null_safe else t(k) == s(k)
        on = same if on is None else on & same
    joined = left.join(right, on, "full_outer" if insert else "left_outer")

    matched = F.col("_in_t").isNotNull() & F.col("_in_s").isNotNull()
    change = matched if when_matched is None else matched & F.coalesce(when_matched(t, s), F.lit(False))
    added = F.col("_in_t").isNull()

    extra = [c for c in source.columns if c not in target.columns]
    out = []
    for c in [*target.columns, *extra]:
        old = t(c) if c in target.columns else F.lit(None)
        new = s(c) if c in source.columns else F.lit(None)
        if c in keys:
            out.append(F.when(added, new).otherwise(old).alias(c))
            continue
        if update is None:
            after = new if c in source.columns else old
        else:
            after = update[c](t, s) if c in update else old
        out.append(F.when(added, new).when(change, after).otherwise(old).alias(c))
    action = F.when(added, "insert").when(change, "update").otherwise("keep")
    return joined.select(*out, action.alias(ACTION))


def first_load(source: DataFrame, keys: Sequence[str], unique_source: bool = False) -> DataFrame:
    """What an upsert into an empty table gives."""
    if not unique_source:
        checked = one_row_per_key(source, list(keys), "", "_in_s").filter("_in_s")
        source = checked.select(*source.columns)
    return source.withColumn(ACTION, F.lit("insert"))


def missing_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source rows whose key the target lacks."""
    on = None
    s = source.select(*[F.col(c).alias(f"_s_{c}") for c in source.columns])
    for k in keys:
        same = F.col(f"_s_{k}").eqNullSafe(F.col(f"_t_{k}"))
        on = same if on is None else on & same
    known = target.select(*[F.col(k).alias(f"_t_{k}") for k in keys])
    return s.join(known, on, "left_anti").select(*[F.col(f"_s_{c}").alias(c) for c in source.columns])


def insert_missing(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the source rows whose key the target lacks; matched rows stay as they are."""
    return target.withColumn(ACTION, F.lit("keep")).unionByName(
        missing_rows(target, source, keys).withColumn(ACTION, F.lit("insert")), allowMissingColumns=True
    )


def action_counts(df: DataFrame) -> DataFrame:
    """Rows inserted, updated and kept by a merge."""
    return df.agg(*action_metrics())


def action_metrics() -> list[Column]:
    return [
        F.count_if(F.col(ACTION) == "insert").alias("inserted"),
        F.count_if(F.col(ACTION) == "update").alias("updated"),
        F.count_if(F.col(ACTION) == "keep").alias("unchanged"),
    ]


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row-level difference of two states of a table with unique keys.

    ``_change_type`` is insert, delete, update_preimage or update_postimage. Columns are compared
    by value, not by digest.
    """
    keys = list(keys)
    cols = [*old.columns, *[c for c in new.columns if c not in old.columns]]
    kinds = {f.name: f.dataType for f in [*new.schema.fields, *old.schema.fields]}

    def side(df: DataFrame, p: str) -> DataFrame:
        have = [F.col(c).alias(f"{p}{c}") if c in df.columns else F.lit(None).cast(kinds[c]).alias(f"{p}{c}") for c in cols]
        return df.select(*have, F.lit(True).alias(f"{p}in"))

    def comparable(name: str, c: str) -> Column:
        return F.array_sort(F.map_entries(name)) if kinds[c].typeName() == "map" else F.col(name)

    a, b = side(old, "_a_"), side(new, "_b_")
    on = None
    for k in keys:
        same = F.col(f"_a_{k}").eqNullSafe(F.col(f"_b_{k}"))
        on = same if on is None else on & same
    equal = F.lit(True)
    for c in cols:
        if c not in keys:
            equal = equal & comparable(f"_a_{c}", c).eqNullSafe(comparable(f"_b_{c}", c))
    j = a.join(b, on, "full_outer")
    gone, born = F.col("_b_in").isNull(), F.col("_a_in").isNull()
    before = F.struct(*[F.col(f"_a_{c}").alias(c) for c in cols])
    after = F.struct(*[F.col(f"_b_{c}").alias(c) for c in cols])

    def row(kind: str, image: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), image.alias("image"))

    rows = (
        F.when(born, F.array(row("insert", after)))
        .when(gone, F.array(row("delete", before)))
        .when(~equal, F.array(row("update_preimage", before), row("update_postimage", after)))
    )
    return j.select(F.explode(rows).alias("_c")).select("_c.image.*", F.col("_c.kind").alias("_change_type"))


def apply_changes(old: DataFrame, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bring ``old`` to the state that a change feed describes."""
    cols = [c for c in feed.columns if c != "_change_type"]
    touched = feed.select(*keys).distinct()
    k = [F.col(f"o.{x}").eqNullSafe(F.col(f"f.{x}")) for x in keys]
    on = k[0]
    for more in k[1:]:
        on = on & more
    rest = old.alias("o").join(touched.alias("f"), on, "left_anti")
    now = feed.filter(F.col("_change_type").isin("insert", "update_postimage")).select(*cols)
    return rest.unionByName(now, allowMissingColumns=True)


def deactivate_missing(dim: DataFrame, seen: DataFrame, key: str, column: str = "status", value: str = "Inactive") -> DataFrame:
    """Set ``column`` on the dimension rows whose key was not seen any more."""
    live = seen.select(F.col(key).alias("_seen")).filter("_seen IS NOT NULL").distinct()
    j = dim.join(live, F.col(key) == F.col("_seen"), "left_outer")
    return j.withColumn(column, F.when(F.col("_seen").isNull(), F.lit(value)).otherwise(F.col(column))).drop("_seen")


def update_where(df: DataFrame, condition: Column, assignments: Mapping[str, Column]) -> DataFrame:
    """``UPDATE … SET … WHERE``: all assignments read the old row."""
    hit = F.coalesce(condition, F.lit(False))
    return df.select(
        *[F.when(hit, assignments[c]).otherwise(F.col(c)).alias(c) if c in assignments else F.col(c) for c in df.columns]
    )
