"""Language proportions of each document by expectation-maximisation over n-gram likelihoods."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ledgerline.llm.common import frugal, id_remainder, worker_cache

#: Letter trigrams are hashed into so many cells; a language is a distribution over them.
CELLS, SMOOTHING = 32_768, 0.5
#: Rounds of expectation-maximisation with all languages, and after each one taken out.
ROUNDS, MORE = 10, 4
#: Price of a further language, in units of log(n-grams). Cells that are handled together.
PENALTY, GROUP = 1.0, 500_000
NO_LETTER = re.compile(r"[\W\d_]+")
UNKNOWN = "und"


def cells(text: str) -> np.ndarray:
    """The cells of all letter trigrams of a text, in lower case; a run of other characters is one blank."""
    plain = NO_LETTER.sub(" ", text.lower()).strip()
    if not plain:
        return np.zeros(0, np.int64)
    c = np.frombuffer(f" {plain} ".encode("utf-32-le"), np.uint32).astype(np.uint64)
    mixed = (c[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (c[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (c[2:] * np.uint64(0x165667B19E3779F9))
    return ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(49)).astype(np.int64)


def _count(batches):
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            held = totals.setdefault(lang, np.zeros(CELLS, np.int64))
            held += np.bincount(cells(text), minlength=CELLS)
    for lang, held in totals.items():
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(held[at])], names=["lang", "cell", "n"])


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """The languages of ``docs`` (text, lang) in order and their cell probabilities, from all rows.

    What reaches the driver is one count for each language and cell.
    """
    rows = docs.select("lang", "text").mapInArrow(frugal(_count), "lang string, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(rows["lang"].unique())
    counts = np.zeros((len(langs), CELLS))
    for i, lang in enumerate(langs):
        own = rows[rows["lang"] == lang]
        counts[i, own["cell"].to_numpy()] = own["n"].to_numpy()
    counts += SMOOTHING
    return langs, (counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)


def mixtures(found: list[np.ndarray], model: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each array of cells (none empty) the proportions of the chosen languages, and each one's share if alone.

    From all languages the least one is taken out again and again; of the sets met this way, the one with the best
    log likelihood less PENALTY * log(n) for each language is chosen.
    """
    at, weight, sizes = [], [], []
    for c in found:
        n = np.bincount(c)
        k = np.flatnonzero(n)
        at.append(k)
        weight.append(n[k])
        sizes.append(len(k))
    at, weight = np.concatenate(at), np.concatenate(weight).astype(np.float32)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    doc = np.repeat(np.arange(len(found)), sizes)
    total = np.add.reduceat(weight, starts).astype(np.float64)
    p = model.T[at]
    scale = p.max(axis=1, keepdims=True)
    p = p / scale
    # The log likelihood of each language alone, less a constant of the document.
    alone = np.add.reduceat(np.log(p) * weight[:, None], starts, axis=0).astype(np.float64)
    d, langs = len(found), model.shape[0]
    share = np.full((d, langs), 1 / langs, np.float32)
    best, chosen = np.full(d, -np.inf), share.copy()
    for left in range(langs, 0, -1):
        for _ in range(ROUNDS if left == langs else MORE if left > 1 else 0):
            mixed = np.einsum("ij,ij->i", p, share[doc])
            share = share * np.add.reduceat(p * (weight / np.maximum(mixed, 1e-30))[:, None], starts, axis=0)
            share /= share.sum(axis=1, keepdims=True)
        mixed = np.einsum("ij,ij->i", p, share[doc])
        value = np.add.reduceat(np.log(np.maximum(mixed, 1e-30)) * weight, starts) - PENALTY * left * np.log(total + 1)
        better = value > best
        best[better], chosen[better] = value[better], share[better]
        if left > 1:
            least = np.where(share > 0, share, 2).argmin(axis=1)
            share = share.copy()
            share[np.arange(d), least] = 0
            empty = share.sum(axis=1) == 0
            share[empty, alone[empty].argmax(axis=1)] = 1
            share /= share.sum(axis=1, keepdims=True)
    posterior = np.exp(alone - alone.max(axis=1, keepdims=True))
    return chosen, posterior / posterior.sum(axis=1, keepdims=True)


def _predict(shared):
    def run(batches):
        worker_cache(None, None)
        langs, model = shared.value

        def result(found: list) -> list[tuple[str, float]]:
            at = [i for i, c in enumerate(found) if len(c)]
            out = [(UNKNOWN, 0.0)] * len(found)
            if at and langs:
                chosen, posterior = mixtures([found[i] for i in at], model)
                top = chosen.argmax(axis=1)
                score = np.clip(chosen[np.arange(len(at)), top] * posterior[np.arange(len(at)), top] / posterior.max(axis=1), 0, 1)
                for i, k, s in zip(at, top, score):
                    out[i] = (langs[k], float(s))
            return out

        for batch in batches:
            rows, held, size = [], [], 0
            for text in batch.column("text").to_pylist():
                held.append(cells(text))
                size += len(held[-1])
                if size >= GROUP:
                    rows += result(held)
                    held, size = [], 0
            rows += result(held)
            columns = [batch.column(c) for c in batch.schema.names if c != "text"]
            names = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.float64())], names=[*names, "lang_pred", "score"])

    return run


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """The columns of ``docs`` (text; others are carried), named c0, c1 and so on, with lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    named = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    named = named.withColumn("text", F.coalesce(F.col(f"c{docs.columns.index('text')}"), F.lit("")))
    fields = [StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema.fields)]
    schema = StructType([*fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return named.mapInArrow(frugal(_predict(shared)), schema)


def _learned(docs: DataFrame, held_out) -> tuple[list[str], np.ndarray]:
    rows = docs.where(F.col("lang").isNotNull() & ~held_out)
    return learn(rows.select("lang", F.coalesce("text", F.lit("")).alias("text")))


def accept(docs: DataFrame, condition, modulus: int = 5, out: int = 0) -> DataFrame:
    """The rows of ``docs`` whose prediction, as in ``identify``, meets ``condition(lang_pred, score)``."""
    found = predict(docs, _learned(docs, id_remainder("doc_id", modulus) == out))
    found = found.where(condition(F.col("lang_pred"), F.col("score")))
    return found.drop("lang_pred", "score").toDF(*docs.columns)


def identify(docs: DataFrame, modulus: int = 5, out: int = 0) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text, lang): doc_id, held_out, lang_pred, score.

    Languages are learned from all rows with a lang whose crc32(doc_id as text) modulo ``modulus`` is not ``out``;
    the prediction sees the text alone. lang_pred is the language with the largest share of the chosen set, score its
    share, lowered where another language alone fits better. Texts that are NULL or hold no letter get ``und`` and 0,
    as does every text if nothing could be learned. A NULL doc_id counts as the empty text in the remainder, repeated
    rows get equal results, an empty table gives none; other columns are ignored.
    """
    held_out = id_remainder("doc_id", modulus) == out
    found = predict(docs.select("doc_id", held_out.alias("held_out"), "text"), _learned(docs, held_out))
    return found.select(F.col("c0").alias("doc_id"), F.col("c1").alias("held_out"), "lang_pred", "score")
