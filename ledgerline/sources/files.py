"""File readers, lineage columns, schema store and idempotent loads."""

from __future__ import annotations

import csv
import datetime as dt
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.sources.drift import fitted, widened
from ledgerline.sources.tables import Lake, path_exists


def from_rows(spark: SparkSession, rows: Sequence, schema) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_text_table(spark: SparkSession, fmt: str, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header, or JSON lines."""
    reader = spark.read.options(**format_options(fmt))
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.format(fmt).load(path)


def format_options(fmt: str) -> dict[str, str]:
    return {"header": "true"} if fmt == "csv" else {}


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    partition_column: str,
    bounds: tuple,
    partitions: int,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Parallel JDBC scan: one range of ``partition_column`` per task."""
    return jdbc_reader(spark, url, table, partition_column, bounds, partitions, properties).load()


def jdbc_reader(spark, url, table, partition_column, bounds, partitions, properties=None):
    return (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("partitionColumn", partition_column)
        .option("lowerBound", str(bounds[0]))
        .option("upperBound", str(bounds[1]))
        .option("numPartitions", str(partitions))
        .option("fetchsize", "10000")
        .options(**dict(properties or {}))
    )


def with_source_file(df: DataFrame) -> DataFrame:
    """The path of the file each row came from."""
    return df.select("*", F.col("_metadata.file_path").alias("_source_file"))


LINEAGE = ("_ingestion_timestamp", "_ingestion_date", "_source_system", "_batch_id")


def with_lineage(df: DataFrame, source_system: str, batch_id: str, at: dt.datetime) -> DataFrame:
    """Ingestion time, date, source and batch as columns."""
    stamp = F.lit(at).cast("timestamp")
    return df.withColumns(
        {
            "_ingestion_timestamp": stamp,
            "_ingestion_date": stamp.cast("date"),
            "_source_system": F.lit(source_system),
            "_batch_id": F.lit(batch_id),
        }
    )


def land(df: DataFrame, root: str, source: str) -> str:
    """Write a source's rows to its landing folder."""
    path = f"{root}/{source}"
    df.write.mode("overwrite").parquet(path)
    return path


def stored_schema(spark: SparkSession, folder: str) -> tuple[T.StructType | None, dt.datetime | None]:
    """The newest stored schema and when it was stored."""
    if not path_exists(spark, folder):
        return None, None
    rows = spark.read.text(folder, wholetext=True).select("value", F.col("_metadata.file_modification_time").alias("at"))
    newest = rows.orderBy(F.get_json_object("value", "$.version").cast("int").desc_nulls_last()).first()
    return T.StructType.fromJson(json.loads(newest[0])), newest[1]


def store_schema(spark: SparkSession, folder: str, schema: T.StructType) -> None:
    """Add a version to the stored schemas."""
    version = spark.read.text(folder, wholetext=True).count() if path_exists(spark, folder) else 0
    text = json.dumps({**schema.jsonValue(), "version": version + 1})
    spark.createDataFrame([(text,)], "value STRING").coalesce(1).write.mode("append").text(folder)


def list_files(spark: SparkSession, src: str, after: dt.datetime | None = None) -> DataFrame:
    """Paths below a folder, from the file listing alone: ``path`` to read, ``file`` as in lineage."""
    reader = spark.read.format("binaryFile")
    return _since(reader, after).load(src).select("path", F.col("_metadata.file_path").alias("file"))


def _since(reader, after: dt.datetime | None):
    # An hour of slack covers clocks that differ and files that were being written.
    return reader if after is None else reader.option(
        "modifiedAfter", (after - dt.timedelta(hours=1)).strftime("%Y-%m-%dT%H:%M:%S")
    )


def resolve_schema(spark: SparkSession, fmt: str, src: str, folder: str) -> T.StructType:
    """The stored schema plus newly seen columns and types; stored again when it grew.

    Only files newer than the stored schema are looked at. A column whose new values do not fit
    becomes wider: doubles for whole numbers, text for the rest.
    """
    known, at = stored_schema(spark, folder)
    if known is not None and list_files(spark, src, at).limit(1).count() == 0:
        return known
    if fmt == "csv":
        seen = infer_csv(spark, src, at, "void")
    elif fmt == "json":
        seen = infer_json(spark, src, at, known)
    else:
        seen = _since(spark.read, at).option("mergeSchema", True).format(fmt).load(src).schema
    schema = widened(known or T.StructType([]), seen)
    if schema != known:
        store_schema(spark, folder, schema)
    return schema


def _header_names(frames):
    for frame in frames:
        yield frame.assign(names=[[n.strip() for n in next(csv.reader([h]))] for h in frame["header"]])[["header", "names"]]


def csv_columns(spark: SparkSession, src: str, after: dt.datetime | None = None) -> list[str]:
    """Column names of all files of a folder: the widest header.

    Spark maps CSV fields by position, so every other header has to be its beginning; a file with
    another order fails here instead of filling the wrong columns.
    """
    lines = _since(spark.read, after).text(src).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    )
    first = lines.filter("start = 0").groupBy("file").agg(F.min_by("value", "at").alias("header"))
    names = first.select("header").distinct().mapInPandas(_header_names, "header string, names array<string>")
    top = names.orderBy(F.desc(F.size("names")), "header").first()
    if top is None:
        raise ValueError(f"no CSV header in {src}")
    widest = top["names"]
    begin = F.slice(F.array(*[F.lit(n) for n in widest]), F.lit(1), F.size("names"))
    other = names.filter(begin != F.col("names")).first()
    if other is not None:
        raise ValueError(f"CSV header {other['names']} is not the beginning of {widest}")
    return widest


def infer_json(spark: SparkSession, src: str, after: dt.datetime | None, known: T.StructType | None) -> T.StructType:
    """Spark's own inference; a known column without a value in the new files says nothing about its type."""
    df = _since(spark.read, after).json(src)
    have = {f.name: f.dataType for f in (known or T.StructType([])).fields}
    doubtful = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and not isinstance(have.get(f.name, f.dataType), T.StringType)]
    if not doubtful:
        return df.schema
    filled = df.agg(*[F.count(F.col(f"`{c}`")).alias(str(k)) for k, c in enumerate(doubtful)]).first()
    empty = {c for k, c in enumerate(doubtful) if not filled[k]}
    return T.StructType([T.StructField(f.name, T.NullType() if f.name in empty else f.dataType, True) for f in df.schema.fields])


def infer_csv(spark: SparkSession, src: str, after: dt.datetime | None = None, empty: str = "string") -> T.StructType:
    """Column types from one pass: the first type that all values of a column parse as, ``empty`` without values."""
    names = csv_columns(spark, src, after)
    text = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
    df = _since(spark.read, after).schema(text).option("header", True).csv(src)
    kinds = {"bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType()}
    tests = [
        F.count_if(F.col(f"`{n}`").isNotNull() & fitted(F.col(f"`{n}`"), kind).isNull()).alias(f"{i}_{k}")
        for i, n in enumerate(names)
        for k, kind in kinds.items()
    ] + [F.count(F.col(f"`{n}`")).alias(f"{i}_n") for i, n in enumerate(names)]
    bad = df.agg(*tests).first()
    out = []
    for i, n in enumerate(names):
        fits = [k for k in kinds if bad[f"{i}_{k}"] == 0]
        out.append(f"`{n}` {empty if not bad[f'{i}_n'] else fits[0] if fits else 'string'}")
    return T.StructType.fromDDL(", ".join(out))


LOAD_FILES = 10_000


def copy_into(lake: Lake, name: str, fmt: str, src: str, schema: T.StructType | None = None) -> int:
    """Load the files of ``src`` that the table has not loaded yet; returns how many.

    The listing and the table's lineage column are compared in an anti join; only the new files are
    opened, at most about ``LOAD_FILES`` per commit.
    """
    spark = lake.spark
    new = list_files(spark, src)
    if lake.exists(name):
        done = lake.read(name).select(F.col("_source_file").alias("file")).distinct()
        new = new.join(done, "file", "left_anti")
    n = new.count()
    lots = -(-n // LOAD_FILES)
    for lot in range(lots):
        paths = [r.path for r in new.filter(F.pmod(F.xxhash64("file"), F.lit(lots)) == lot).select("path").collect()]
        if not paths:
            continue
        reader = spark.read.options(**format_options(fmt)).format(fmt)
        if schema is not None:
            reader = reader.schema(schema)
        elif fmt == "csv":
            reader = reader.schema(infer_csv(spark, src))
        lake.append(name, with_source_file(reader.load(paths)))
    return n
