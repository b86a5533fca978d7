"""Where the record of a key is stored: a table of keys, in the order of their hashes, beside a partitioned fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources.tables import delete_path, list_names, path_exists


class KeyIndex:
    """Key to partition of a fact, so that a record whose partition changes is found without reading the fact.

    Rows (key, part_date) are appended to numbered runs; the newest run that holds a key wins. A run is dealt by ranges
    of the key's hash and sorted by it, so files and row groups hold ranges. A lookup reads two columns and a hash, and
    Spark drops the rows that no looked-up key can match, by a Bloom filter of these, before anything is shuffled.
    Runs are merged into one once there are more than ``runs`` of them.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, runs: int = 30):
        self.spark, self.path, self.key, self.runs = spark, path, key, runs

    def _runs(self) -> list[int]:
        """Numbers of the runs whose jobs have succeeded, those that a merged one replaces left out."""
        names = [n for n in list_names(self.spark, self.path) if path_exists(self.spark, f"{self.path}/{n}/_SUCCESS")]
        merged = max((int(n.split("-")[0]) for n in names if n.endswith("-merged")), default=0)
        return sorted({int(n.split("-")[0]) for n in names if int(n.split("-")[0]) > merged}) + ([-merged] if merged else [])

    def _folder(self, number: int) -> str:
        return f"{self.path}/{-number:08d}-merged" if number < 0 else f"{self.path}/{number:08d}"

    def _rows(self, runs: list[int]) -> DataFrame | None:
        out = None
        for n in runs:
            one = self.spark.read.parquet(self._folder(n)).withColumn("_run", F.lit(abs(n)))
            out = one if out is None else out.unionByName(one)
        return out

    def find(self, keys: DataFrame) -> DataFrame:
        """The stored (key, part_date) of the keys that are known; each at most once."""
        rows = self._rows(self._runs())
        if rows is None:
            return keys.select(self.key).limit(0).withColumn("part_date", F.lit(None).cast("date"))
        wanted = keys.select(F.xxhash64(self.key).alias("hash"), self.key).distinct()
        rows = rows.join(wanted, ["hash", self.key], "left_semi")
        return rows.groupBy(self.key).agg(F.max_by("part_date", "_run").alias("part_date"))

    def moved(self, rows: DataFrame) -> DataFrame:
        """(key, part_date) of stored records that ``rows`` (key, part_date) now put into another partition."""
        known = self._rows(self._runs())
        if known is None:
            return rows.select(self.key, "part_date").limit(0)
        # Grouped by hashes, as a join of two large lists would sort both. A known place is that of the newest run.
        now = rows.select(F.xxhash64(self.key).alias("hash"), self.key, F.col("part_date").alias("_now"))
        both = known.unionByName(now, allowMissingColumns=True).where(F.col(self.key).isNotNull()).groupBy("hash", self.key)
        place = both.agg(F.max_by("part_date", "_run").alias("part_date"), F.min("_now").alias("_first"), F.max("_now").alias("_last"))
        return place.where("part_date <> _first OR part_date <> _last").select(self.key, "part_date")

    def record(self, rows: DataFrame) -> None:
        """Note where the records of a batch are now; to be called after they were written."""
        runs = self._runs()
        rows = rows.select(F.xxhash64(self.key).alias("hash"), self.key, "part_date")
        # An earlier try may have left a folder without its marker, so numbers rise above all folders.
        number = 1 + max((int(n.split("-")[0]) for n in list_names(self.spark, self.path)), default=0)
        self._write(rows, self._folder(number))
        if len(runs) >= self.runs:
            self.merge()

    def merge(self) -> None:
        """Make one run of all; the old ones go after the new one stands."""
        runs = self._runs()
        rows = self._rows(runs)
        if rows is None or len(runs) < 2:
            return
        newest = max(abs(n) for n in runs)
        one = rows.groupBy("hash", self.key).agg(F.max_by("part_date", "_run").alias("part_date"))
        self._write(one, self._folder(-newest))
        for n in runs:
            delete_path(self.spark, self._folder(n))

    def _write(self, rows: DataFrame, path: str) -> None:
        rows.repartitionByRange("hash").sortWithinPartitions("hash").write.parquet(path)
