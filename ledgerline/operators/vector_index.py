"""Top-k cosine search over cells of similar vectors, exact by bounds on the cells."""

from __future__ import annotations

from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.similarity import _best, _kernel

#: Cells at most; vectors that the centres are fitted on, about; rounds of fitting.
CELLS, FITTED, ROUNDS = 2_048, 10_000, 8
#: Base rows of one part of a cell, and queries compared with it at once.
PART_ROWS, QUERY_BLOCK = 20_000, 2_000
#: Digits that scores are compared by; slack of the angles, beyond what rounding can shift.
DIGITS, SLACK = 9, 1e-6


@dataclass(frozen=True)
class CellIndex:
    """Rows (id, vector, cell, part and the kept columns) sorted by cell, and what is known of each cell."""

    spark: SparkSession
    path: str
    id: str
    centres: np.ndarray
    radius: np.ndarray
    parts: np.ndarray

    @property
    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows")


def _sound(vector: str) -> Column:
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & finite & F.exists(v, lambda x: x != 0)


def _units():
    """Vectors to unit length, as a nested function that travels to the workers by value."""

    def unit(vectors) -> np.ndarray:
        m = np.array(list(vectors), dtype=np.float64)
        m /= np.abs(m).max(axis=1, keepdims=True)
        return m / np.sqrt((m * m).sum(axis=1))[:, None]

    return unit


def _centres(sample: np.ndarray, cells: int) -> np.ndarray:
    """Spherical k-means from random members; a cell that runs empty keeps its centre."""
    centres = sample[np.random.default_rng(0).choice(len(sample), min(cells, len(sample)), replace=False)]
    for _ in range(ROUNDS):
        nearest = (sample @ centres.T).argmax(axis=1)
        total = np.zeros_like(centres)
        np.add.at(total, nearest, sample)
        norm = np.sqrt((total * total).sum(axis=1))
        centres = np.where(norm[:, None] > 0, total / np.where(norm > 0, norm, 1)[:, None], centres)
    return centres


def build_index(base: DataFrame, path: str, *, id: str, vector: str = "embedding", keep: tuple[str, ...] = ()) -> CellIndex:
    """Index every row of ``base`` below ``path``; ``keep`` names columns that searches may filter by.

    About the square root of the row count, at most CELLS, are the centres, fitted on a random sample of about FITTED, at
    most twice as many, vectors. Each vector goes to its nearest centre; a cell's radius is its members' largest angle to the centre.
    Cells are cut into parts of about PART_ROWS rows. Vectors that are NULL, zero or hold a NULL or non-finite
    component are left out, as they have no direction; all others need the same length. The driver holds the sample
    and one row per cell, tasks the centres.
    """
    spark, unit = base.sparkSession, _units()
    rows = base.where(_sound(vector)).select(
        F.col(id).cast("long").alias("b"), F.col(vector).cast("array<double>").alias("v"), *[F.col(c) for c in keep])
    n = rows.count()
    # By row and not by id or vector, of which one may hold a third of the rows.
    share = F.rand(0) < F.lit(FITTED / max(n, 1))
    taken = [r.v for r in rows.where(share).select("v").limit(2 * FITTED).collect() or rows.select("v").limit(1).collect()]
    centres = _centres(unit(taken), min(CELLS, max(1, round(n**0.5)))) if taken else np.zeros((0, 0))

    def place(frames):
        for f in frames:
            if len(f):
                s = unit(f["v"]) @ centres.T
                f["cell"] = s.argmax(axis=1)
                f["angle"] = np.arccos(np.clip(s.max(axis=1), -1, 1))
                yield f

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in rows.columns)
    if len(centres):
        placed = rows.mapInPandas(place, f"{kinds}, cell long, angle double")
    else:
        placed = rows.withColumns({"cell": F.lit(0).cast("long"), "angle": F.lit(0.0)})
    placed.write.mode("overwrite").parquet(f"{path}/placed")
    placed = spark.read.parquet(f"{path}/placed")
    seen = placed.groupBy("cell").agg(F.max("angle").alias("radius"), F.ceil(F.count("*") / PART_ROWS).alias("parts")).collect()
    radius, parts = np.zeros(len(centres)), np.zeros(len(centres), np.int64)
    for r in seen:
        radius[r.cell], parts[r.cell] = r.radius, r.parts
    split = F.element_at(F.lit([int(p) for p in parts] or [1]), (F.col("cell") + 1).cast("int"))
    dealt = placed.drop("angle").withColumn("part", F.pmod(F.monotonically_increasing_id(), split))
    # Sorted files, so that a search skips the row groups of other cells.
    dealt.repartitionByRange("cell", "part", "b").sortWithinPartitions("cell", "part").write.mode("overwrite").parquet(f"{path}/rows")
    return CellIndex(spark, path, id, centres, radius, parts)


def search_index(index: CellIndex, queries: DataFrame, k: int, *, query_id: str, vector: str = "embedding", condition=None, probes: int = 4) -> DataFrame:
    """``k`` nearest indexed rows per query: query id, base id, ``score``, ``rank``; ties, to DIGITS digits, by base id.

    First each query meets the ``probes`` cells with the nearest centres. Its k-th score there then bounds the rest:
    no member of a cell is nearer than the angle to the centre less the radius, so only cells within that bound are met
    in the second step, and the result is that of comparing all pairs. Only rows of cells that are met are shuffled.
    A cell that many queries meet is compared in blocks of parts and queries. Query ids are distinct; queries without a
    direction get no row; ``condition`` filters by kept columns.
    """
    out, run = "q long, b long, score double", f"search-{uuid4().hex}"
    named = [F.col("q").alias(query_id), F.col("b").alias(index.id), "score", "rank"]
    qs = queries.where(_sound(vector)).select(F.col(query_id).cast("long").alias("q"), F.col(vector).cast("array<double>").alias("v"))
    if not len(index.centres):
        return _best(index.spark.createDataFrame([], out), k).select(*named)
    first = _meet(index, qs.mapInPandas(_probe(index, probes, False), "q long, v array<double>, cell long"), k, condition, f"{run}/first")
    kth = first.groupBy("q").agg(F.when(F.count("*") >= k, F.min("score")).alias("bound"))
    rest = qs.join(kth, "q", "left").mapInPandas(_probe(index, probes, True), "q long, v array<double>, cell long")
    second = _meet(index, rest, k, condition, f"{run}/second")
    return _best(first.drop("rank").unionByName(second.drop("rank")), k).select(*named)


def _probe(index: CellIndex, probes: int, bounded: bool):
    """(query, cell) for the nearest cells, or for the others that may hold one of the k best."""
    centres, radius, used, unit = index.centres, index.radius, index.parts > 0, _units()

    def run(frames):
        for f in frames:
            if not len(f):
                continue
            angle = np.arccos(np.clip(unit(f["v"]) @ centres.T, -1, 1))
            angle[:, ~used] = np.inf
            near = np.argsort(angle, axis=1, kind="stable")[:, :probes]
            wanted = np.zeros(angle.shape, bool)
            np.put_along_axis(wanted, near, True, axis=1)
            if bounded:
                reach = np.arccos(np.clip(f["bound"].astype(float).fillna(-1.0).to_numpy(), -1, 1))
                wanted = ~wanted & (angle - radius - SLACK <= reach[:, None])
            row, cell = np.nonzero(wanted & used)
            yield pd.DataFrame({"q": f["q"].to_numpy()[row], "v": f["v"].to_numpy()[row], "cell": cell})

    return run


def _meet(index: CellIndex, asked: DataFrame, k: int, condition, step: str) -> DataFrame:
    """The k best of the cells asked for, one row for each query and base row."""
    folder = f"{index.path}/{step}"
    asked.write.parquet(folder)
    asked = index.spark.read.parquet(folder)
    loads = {r.cell: -(-r.n // QUERY_BLOCK) for r in asked.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    # At most one entry per cell, so both lists are bounded by CELLS.
    blocks = F.element_at(F.lit([int(loads.get(c, 1)) for c in range(len(index.centres))]), (F.col("cell") + 1).cast("int"))
    parts = F.element_at(F.lit([max(1, int(p)) for p in index.parts]), (F.col("cell") + 1).cast("int"))
    base = index.rows.where(F.col("cell").isin([int(c) for c in loads]))
    if condition is not None:
        base = base.where(condition)
    left = asked.withColumn("block", F.pmod(F.xxhash64("q"), blocks)).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), (parts - 1).cast("long"))))
    right = base.select("b", "v", "cell", "part").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), (blocks - 1).cast("long"))))
    (_, best, _), unit = _kernel(), _units()

    def compare(q, b):
        if not len(q) or not len(b):
            return pd.DataFrame({"q": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        s = np.round(unit(q["v"]) @ unit(b["v"]).T, DIGITS)
        if s.shape[1] > k:
            row, col = np.nonzero(s >= np.partition(s, -k, axis=1)[:, -k][:, None])
        else:
            row, col = np.indices(s.shape).reshape(2, -1)
        found = best(q["q"].to_numpy()[row], b["b"].to_numpy()[col], s[row, col], k)
        return pd.DataFrame(dict(zip(("q", "b", "score"), found)))

    key = ["cell", "part", "block"]
    met = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(compare, "q long, b long, score double")
    # Read twice, for the bound and for the result.
    _best(met, k).write.parquet(f"{folder}_found")
    return index.spark.read.parquet(f"{folder}_found")
