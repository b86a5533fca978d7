"""Feature tables, training sets, model fit and scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.joins import asof_join, lookup_latest


def feature_table(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The frame itself, if the key is complete and unique; otherwise an error."""
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    bad = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter((F.col("_n") > 1) | ~complete)
    if bad.limit(1).count():
        raise ValueError(f"primary key {list(keys)} is not unique or has NULLs")
    return df


def training_set(
    labels: DataFrame,
    features: DataFrame,
    *,
    key: str,
    values: Sequence[str],
    label_ts: str | None = None,
    feature_ts: str | None = None,
    exclude: Sequence[str] = (),
) -> DataFrame:
    """Label rows with looked-up features: as of ``label_ts`` if given, else the newest row."""
    if label_ts and feature_ts:
        out = asof_join(labels, features, [key], label_ts, feature_ts, values)
    else:
        out = lookup_latest(labels, features, key, [feature_ts] if feature_ts else [], values)
    return out.drop(*exclude)


def hash_split(df: DataFrame, key: str, train_share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Repeatable split: a row keeps its side whatever the partitioning."""
    side = F.pmod(F.xxhash64(key), F.lit(10_000)) < int(train_share * 10_000)
    return df.filter(side), df.filter(~side)


def modulus_split(df: DataFrame, key: str, parts: int = 10, train: int = 8) -> tuple[DataFrame, DataFrame]:
    """The same by the remainder of a whole-number key, which SQL elsewhere can repeat."""
    side = F.pmod(F.col(key), F.lit(parts)) < train
    return df.filter(side), df.filter(~side)


def fit_forest(train: DataFrame, inputs: Sequence[str], label: str, trees: int = 100, depth: int = 5, seed: int = 42):
    """Random-forest regression on the given columns; returns a function that adds ``prediction``."""
    pack = VectorAssembler(inputCols=list(inputs), outputCol="_features")
    forest = RandomForestRegressor(
        featuresCol="_features", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed, subsamplingRate=1.0
    )
    model = forest.fit(pack.transform(train))

    def score(df: DataFrame) -> DataFrame:
        return model.transform(pack.transform(df)).drop("_features")

    return score


RUNS = "meta/experiment_runs"


def record_run(lake, experiment: str, run_id: str, params: dict, metrics: dict[str, float]) -> None:
    """Append parameters and metrics of a run to the runs table."""
    row = [(experiment, run_id, {k: str(v) for k, v in params.items()}, metrics.get("rmse"), metrics.get("r2"))]
    schema = "experiment_name string, run_id string, params map<string,string>, rmse double, r2 double"
    lake.append(RUNS, lake.spark.createDataFrame(row, schema))


def regression_metrics(scored: DataFrame, label: str) -> dict[str, float]:
    def measure(name: str) -> float:
        return RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName=name).evaluate(scored)

    return {"rmse": measure("rmse"), "r2": measure("r2")}
