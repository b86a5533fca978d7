"""Tables as plain Parquet folders.

Two kinds, both with one writer at a time:

* ``Lake`` tables keep every committed state. A commit writes its files to a folder of its own
  and then adds one row to the table's history, which lists the folders that make up the state.
  Readers see a commit only once that row exists; a job that dies earlier leaves an unused folder.
* ``upsert_partitions`` is for large facts: it rewrites only the touched partitions of one folder.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.merge import ACTION, action_metrics, first_load, missing_rows, upsert

_HISTORY = (
    "version BIGINT, committed_at TIMESTAMP, operation STRING, folders ARRAY<STRING>, "
    "schema_json STRING, partition_by ARRAY<STRING>, metrics MAP<STRING,BIGINT>"
)
MAX_LISTED_PARTITIONS = 10_000
#: Up to so many partitions are written by each task as its rows come; for more, rows are first dealt by partition.
OPEN_FILES = 16
#: Keys that are sent to all tasks, to tell rows that stay from rows that are replaced: some 60 MB as a hash table.
BROADCAST_KEYS = 500_000
#: Whole rows that a task sorts, about: larger sorts go to disk.
SORTED_ROWS = 1_000_000


def path_exists(spark: SparkSession, path: str) -> bool:
    """Ask the path's own file system, whichever it is."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _files(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it does not exist."""
    fs, p = _files(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()] if fs.exists(p) else []


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _files(spark, path)
    fs.mkdirs(p)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _files(spark, path)
    fs.delete(p, True)


class Lake:
    """Named tables (``layer/table``) below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _log(self, name: str) -> str:
        return f"{self.root}/{name}/history"

    def exists(self, name: str) -> bool:
        return path_exists(self.spark, self._log(name))

    def history(self, name: str) -> DataFrame:
        """One row per committed version."""
        return self.spark.read.schema(_HISTORY).json(self._log(name))

    def _state(self, name: str, version: int | None = None, as_of: dt.datetime | None = None) -> Row | None:
        if not self.exists(name):
            return None
        h = self.history(name)
        if version is not None:
            h = h.filter(F.col("version") == version)
        if as_of is not None:
            h = h.filter(F.col("committed_at") <= F.lit(as_of))
        return h.orderBy(F.desc("version")).limit(1).first()

    def version(self, name: str) -> int | None:
        state = self._state(name)
        return None if state is None else state.version

    def read(self, name: str, version: int | None = None, as_of: dt.datetime | None = None) -> DataFrame:
        """The newest state, or that of a version or a point in time."""
        state = self._state(name, version, as_of)
        if state is None:
            raise ValueError(f"no such table or version: {name}")
        schema = T.StructType.fromJson(json.loads(state.schema_json))
        if not state.folders:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.root}/{f}" for f in state.folders]
        if not state.partition_by:
            return self.spark.read.schema(schema).parquet(*paths)
        # Partition columns are found below one folder at a time.
        out = self.spark.read.schema(schema).parquet(paths[0])
        for p in paths[1:]:
            out = out.unionByName(self.spark.read.schema(schema).parquet(p))
        return out

    def commit(
        self,
        name: str,
        df: DataFrame,
        operation: str,
        *,
        keep: bool = False,
        partition_by: Sequence[str] | None = (),
        metrics: Observation | dict | None = None,
    ) -> dict[str, int]:
        """Write ``df`` as the new state, or add it to the present one with ``keep``.

        With ``partition_by=None`` a table keeps the partitioning it has.
        """
        before = self._state(name)
        version = 0 if before is None else before.version + 1
        if before is not None and (keep or partition_by is None):
            partition_by = before.partition_by
        partition_by = partition_by or ()
        folder = f"{name}/data/v{version:06d}-{uuid.uuid4().hex[:8]}"
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.parquet(f"{self.root}/{folder}")
        folders, schema = [folder], df.schema
        if keep and before is not None:
            old = T.StructType.fromJson(json.loads(before.schema_json))
            folders = [*before.folders, folder]
            schema = merge_schemas(old, df.schema)
        found = metrics.get if isinstance(metrics, Observation) else (metrics or {})
        found = {k: int(v) for k, v in found.items()}
        now = dt.datetime.now(dt.timezone.utc)
        row = (version, now, operation, folders, schema.json(), list(partition_by), found)
        self.spark.createDataFrame([row], _HISTORY).coalesce(1).write.mode("append").json(self._log(name))
        return found

    def overwrite(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        """Replace the rows and, if it differs, the schema."""
        self.commit(name, df, "overwrite", partition_by=partition_by)

    def append(self, name: str, df: DataFrame) -> None:
        """Add rows; new columns widen the table."""
        self.commit(name, df, "append", keep=True)

    def truncate(self, name: str) -> None:
        self.commit(name, self.read(name).limit(0), "truncate", partition_by=None)

    def clone(self, source: str, target: str, version: int | None = None) -> None:
        """Copy one state of a table, files included."""
        self.commit(target, self.read(source, version), "clone", partition_by=self._state(source, version).partition_by)

    def merge(self, name: str, source: DataFrame, keys: Sequence[str], **options) -> dict[str, int]:
        """Upsert into the table; the counts are taken while the new state is written."""
        seen = Observation()
        if self.exists(name):
            state = upsert(self.read(name), source, keys, **options)
        else:
            state = first_load(source, keys, options.get("unique_source", False))
        return self.commit(name, state.observe(seen, *action_metrics()).drop(ACTION), "merge", partition_by=None, metrics=seen)

    def insert_missing(self, name: str, source: DataFrame, keys: Sequence[str]) -> dict[str, int]:
        """Insert-only merge: only the new rows are written."""
        fresh = missing_rows(self.read(name), source, keys) if self.exists(name) else source
        seen = Observation()
        rows = fresh.observe(seen, F.count(F.lit(1)).alias("inserted"))
        return self.commit(name, rows, "insert_missing", keep=True, metrics=seen)

def merge_schemas(old: T.StructType, new: T.StructType) -> T.StructType:
    """The old columns, then those that only the new schema has, all nullable."""
    have = {f.name for f in old.fields}
    fields = [*old.fields, *[f for f in new.fields if f.name not in have]]
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])


def upsert_partitions(
    spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], partition: str, parts: DataFrame | None = None, **options
) -> dict[str, int]:
    """Upsert into a partitioned Parquet folder, reading and rewriting only touched partitions.

    ``partition`` is part of the key, so a row never moves. The partition filter is static while
    the source touches few partitions, else a semi join. Spark writes beside the table and swaps
    the partitions when the job has succeeded; a repeated run gives the same state. The source is evaluated several
    times, so write it first if it is expensive to compute. A first load evaluates it once, if ``parts`` names its
    partitions.
    """
    keys = list(dict.fromkeys([*keys, partition]))
    values = _listed(source if parts is None else parts, partition)
    if not path_exists(spark, path):
        state = first_load(source, keys, options.get("unique_source", False))
        return _observed(state, path, partition, values)
    old = _only(spark.read.parquet(path), source, values, partition)
    return _merge(old, old, source, keys, path, partition, values, **options)


def _merge(
    old: DataFrame, known: DataFrame, source: DataFrame, keys: list[str], path: str, partition: str, values: list | None,
    gone: DataFrame | None = None, **options
) -> dict[str, int]:
    """Write ``old`` merged with ``source``; ``known`` are the keys of ``old`` and may still hold those of ``gone``.

    Where whole rows are replaced, keys alone are compared. Stored rows that stay are told by the shorter list of keys,
    without a shuffle of rows while that list is short; if none stays, the stored rows are not read.
    """
    whole = options == {"unique_source": True} and dict(old.dtypes) == dict(source.dtypes)
    if whole:
        tag = lambda df, o, n, g: df.select(*keys, F.lit(o).alias("_o"), F.lit(n).alias("_n"), F.lit(g).alias("_g"))
        tagged = tag(known, 1, 0, 0).unionByName(tag(source, 0, 1, 0))
        tagged = tagged if gone is None else tagged.unionByName(tag(gone, 0, 0, 1))
        both = tagged.groupBy(*keys).agg(F.when(F.max("_g") == 0, F.sum("_o")).otherwise(0).alias("_o"), F.sum("_n").alias("_n"))
        stays, replaced = (F.col("_n") == 0) & (F.col("_o") > 0), (F.col("_n") > 0) & (F.col("_o") > 0)
        n = both.agg(
            F.sum(F.when(F.col("_o") == 0, F.col("_n"))).alias("inserted"), F.sum(F.when(replaced, F.col("_n"))).alias("updated"),
            F.sum(F.when(stays, F.col("_o"))).alias("unchanged"), F.count_if(replaced).alias("keys"), F.max("_o").alias("most"),
        ).first().asDict()
        n = {k: int(v or 0) for k, v in n.items()}
        # A table that holds a key twice, as no upsert leaves it, goes the way of all pairs.
        whole = n.pop("most") <= 1
    if not whole:
        return _observed(upsert(old, source, keys, **options), path, partition, values, gone)
    met = n.pop("keys")
    state = source.select(*old.columns)
    if n["unchanged"]:
        rest, how, few = both.where(replaced), "left_anti", met <= BROADCAST_KEYS
        if not few and n["unchanged"] <= BROADCAST_KEYS:
            rest, how, few = both.where(stays), "left_semi", True
        rest = rest.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
        on = F.lit(True)
        for k in keys:
            on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        state = old.join(F.broadcast(rest) if few else rest, on, how).unionByName(state)
    _overwrite(state, path, partition, gone, values)
    return n


def _observed(state: DataFrame, path: str, partition: str, values: list | None, gone: DataFrame | None = None) -> dict[str, int]:
    """Write a merged state and count its actions on the way."""
    seen = Observation()
    _overwrite(state.observe(seen, *action_metrics()).drop(ACTION), path, partition, gone, values)
    return {k: int(v) for k, v in seen.get.items()}


def _listed(parts: DataFrame, partition: str) -> list | None:
    """The partitions that ``parts`` names, or None if there are too many for a list."""
    values = [r[0] for r in parts.select(partition).distinct().limit(MAX_LISTED_PARTITIONS + 1).collect()]
    return values if len(values) <= MAX_LISTED_PARTITIONS else None


def only_partitions(df: DataFrame, parts: DataFrame, partition: str) -> DataFrame:
    """The rows of ``df`` in the partitions that ``parts`` names: a static filter for few of them, else a semi join."""
    return _only(df, parts, _listed(parts, partition), partition)


def _only(df: DataFrame, parts: DataFrame, values: list | None, partition: str) -> DataFrame:
    if values is None:
        same = F.col(f"o.{partition}").eqNullSafe(F.col(f"n.{partition}"))
        return df.alias("o").join(parts.select(partition).distinct().alias("n"), same, "left_semi")
    some = [v for v in values if v is not None]
    hit = F.col(partition).isin(some) if some else F.lit(False)
    if len(some) < len(values):
        hit = hit | F.col(partition).isNull()
    return df.filter(hit)


def _file_names(spark: SparkSession, path: str) -> set[str]:
    fs, p = _files(spark, path)
    return {f.getPath().getName() for f in fs.listStatus(p)} if fs.exists(p) else set()


@contextmanager
def settings(spark: SparkSession, values: dict[str, object]) -> Iterator[None]:
    """Session settings for the duration of a write."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, str(value))
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def bounded_sorts(spark: SparkSession, rows: int) -> dict[str, int]:
    """Settings by which a job over so many stored rows sorts about ``SORTED_ROWS`` in a task, before and after a shuffle."""
    tasks, reads = -(-rows // SORTED_ROWS), "spark.sql.files.minPartitionNum"
    deals = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    now = {reads: spark.conf.get(reads, None) or spark.sparkContext.defaultParallelism,
           deals: spark.conf.get(deals, None) or spark.conf.get("spark.sql.shuffle.partitions")}
    return {name: 2 * tasks for name, n in now.items() if 2 * tasks > int(n)}


def write_rows(df: DataFrame, path: str) -> DataFrame:
    """Write rows that later jobs read several times, in files that tasks can share out; returns them as stored."""
    spark = df.sparkSession
    with settings(spark, _hashed_joins(spark)):
        df.write.option("maxRecordsPerFile", SORTED_ROWS).parquet(path)
    return spark.read.parquet(path)


def _hashed_joins(spark: SparkSession) -> dict[str, str]:
    """A joined side that fits into memory by parts, as found after its shuffle, is hashed, so whole rows are not sorted."""
    advised = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    return {"spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": advised}


def _overwrite(df: DataFrame, path: str, partition: str, parts: DataFrame | None = None, values: list | None = None) -> None:
    """Swap in the partitions that ``df`` has rows for; of ``parts``, those that it has none for are removed.

    ``values`` are all partitions of ``df``, where they are known. Rows of a few partitions are written by the tasks
    that make them, without a shuffle or a sort; for many, the rebalance hint brings the rows of a partition together
    and splits one that holds much of the data over several tasks and files.
    A partition whose files are still there after the swap was not written. Only folder names are kept on the driver.
    """
    spark, held = df.sparkSession, {}
    for row in [] if parts is None else parts.select(partition).distinct().toLocalIterator():
        folder = f"{path}/{partition}={'__HIVE_DEFAULT_PARTITION__' if row[0] is None else row[0]}"
        held[folder] = next(iter(_file_names(spark, folder)), None)
    few = values is not None and len(values) <= OPEN_FILES
    with settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": OPEN_FILES if few else 0, **_hashed_joins(spark)}):
        (df if few else df.hint("rebalance", partition)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    for folder, name in held.items():
        if name is not None and name in _file_names(spark, folder):
            delete_path(spark, folder)


def move_partitions(
    spark: SparkSession, path: str, source: DataFrame, key: str, partition: str, moved: DataFrame
) -> dict[str, int]:
    """``upsert_partitions`` for records that may change their partition; ``source`` has one row for each key.

    ``moved`` (key, partition) says where records of ``source`` are stored so far, if elsewhere. Old and new partitions
    are written by one job, and those left without a row are removed after it; repeated, it gives the same state.
    """
    if not path_exists(spark, path):
        return upsert_partitions(spark, path, source, [key], partition, unique_source=True)
    both = source.select(partition).union(moved.select(partition)).distinct()
    values, keys, left = _listed(both, partition), [key, partition], moved.select(key, partition)
    old = _only(spark.read.parquet(path), both, values, partition)
    return _merge(old.join(left, keys, "left_anti"), old.select(*keys), source, keys, path, partition, values, left, unique_source=True)


def replace_partitions(path: str, df: DataFrame, partition: str, parts: DataFrame | None = None) -> None:
    """Replace exactly the partitions present in ``df``: groups that vanished from them go too.

    With ``parts``, which then names all partitions of ``df``, those for which ``df`` has no row are removed.
    """
    _overwrite(df, path, partition, parts, None if parts is None else _listed(parts, partition))


def ensure_layers(spark: SparkSession, root: str, layers: Sequence[str] = ("bronze", "silver", "gold", "dims", "meta")) -> None:
    """One database per layer, for use by name in SQL."""
    for layer in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{root}/{layer}'")


def register_views(spark: SparkSession, views: dict[str, DataFrame]) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)
