"""A durable list of partitions that later steps still have to work on."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources.tables import delete_path, list_names, make_folder, path_exists


class WorkList:
    """Partitions that a change touches are listed before the change is made; each step that follows strikes off
    what it has done. A run that dies anywhere leaves the list, so the next one does the rest, whatever its own
    input is.

    A listing is a numbered folder of (source, part_date) rows, valid once its job has succeeded. A step's mark is the
    number up to which it has done all listings, kept as the name of an empty folder: one atomic call, no rewrite. So
    the list costs a small file for each change and nothing for each partition and step. One writer is assumed, as for
    the tables.
    """

    SCHEMA = "source STRING, part_date DATE"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _numbers(self) -> list[int]:
        return sorted(int(n) for n in list_names(self.spark, f"{self.path}/todo"))

    def _marks(self, step: str) -> list[int]:
        return sorted(int(n) for n in list_names(self.spark, f"{self.path}/done/{step}"))

    def _folder(self, number: int) -> str:
        return f"{self.path}/todo/{number:08d}"

    def add(self, source: str, parts: DataFrame) -> int:
        """List the partitions (``part_date``) of a source; returns the listing's number."""
        # Numbers of listings that are gone are not used again: a mark may stand above all that are left.
        marks = [m for s in list_names(self.spark, f"{self.path}/done") for m in self._marks(s)]
        number = 1 + max([*self._numbers(), *marks], default=0)
        rows = parts.select(F.lit(source).alias("source"), F.col("part_date").cast("date").alias("part_date")).distinct()
        rows.coalesce(1).write.parquet(self._folder(number))
        return number

    def listing(self, number: int) -> DataFrame:
        """The partitions (``part_date``) of one listing."""
        return self.spark.read.schema(self.SCHEMA).parquet(self._folder(number)).select("part_date")

    def last(self) -> int:
        return max(self._numbers(), default=0)

    def pending(self, step: str, upto: int | None = None) -> DataFrame:
        """(source, part_date) that the step has not done yet, each once."""
        mark = max(self._marks(step), default=0)
        upto = self.last() if upto is None else upto
        # A folder without the marker of a finished job belongs to a change that was never made.
        paths = [self._folder(n) for n in self._numbers() if mark < n <= upto and path_exists(self.spark, f"{self._folder(n)}/_SUCCESS")]
        if not paths:
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(*paths).distinct()

    def strike(self, step: str, upto: int) -> None:
        """The step has done all listings up to this number."""
        old = self._marks(step)
        if upto > max(old, default=0):
            make_folder(self.spark, f"{self.path}/done/{step}/{upto:08d}")
        for m in old:
            if m < upto:
                delete_path(self.spark, f"{self.path}/done/{step}/{m:08d}")

    def forget(self, steps: Iterable[str]) -> None:
        """Delete the listings that all steps have done."""
        least = min(max(self._marks(s), default=0) for s in steps)
        for n in self._numbers():
            if n <= least:
                delete_path(self.spark, self._folder(n))
