"""Toxicity by boosted trees over dense features of learned lexicons, with isotonic calibration."""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import id_remainder, materialise

LETTERS = re.compile(r"[^\W\d_]+")
BROKEN = re.compile(r"(?<=[^\W\d_])[\d@$*!|+#%&]+(?=[^\W\d_])")
STRETCHED = re.compile(r"([^\W\d_])\1\1")
#: Characters that stand for letters, and words of address in several languages.
STANDS_FOR = str.maketrans("013457@$!|+", "oieastasiit")
SECOND_PERSON = frozenset(
    "you your yours yourself yourselves u ur du dich dir dein deine deiner deinen ihr euch euer eure "
    "tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros vosotras tus".split()
)
#: Prefixes of these lengths are terms beside whole words. The least evidence for a term: a rule, not a number of terms.
PREFIXES, LEAST_DOCS, LEAST_EVIDENCE, LEAST_LIFT = (4, 5, 6), 3, 12.0, 6.0
#: Labelled rows that trees and calibration are fitted on at most, by a hash of the id; every fourth calibrates.
FITTED = 40_000
TREES, DEPTH, RATE, BINS, RIDGE = 80, 3, 0.15, 32, 1.0
FEATURES = (
    "log_words word_density word_hits word_weight prefix_density prefix_hits prefix_weight near_second second "
    "capitals capital_words punctuation exclamations broken_density broken_hits stretched digits"
).split()


def terms(text: str) -> set[str]:
    """Distinct words and word prefixes of a text, in lower case; a prefix ends in an asterisk."""
    words = set(LETTERS.findall(text.lower()))
    return words.union(*({f"{w[:n]}*" for w in words if len(w) >= n} for n in PREFIXES))


def _count_terms(batches):
    held: dict[str, list[int]] = {}

    def flush():
        items = list(held.items())
        for i in range(0, len(items), 50_000):
            part = items[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in part], pa.string()), pa.array([v[0] for _, v in part], pa.int64()), pa.array([v[1] for _, v in part], pa.int64())], names=["term", "docs", "toxic"])
        held.clear()

    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            for t in terms(text):
                n = held.get(t)
                if n is None:
                    held[t] = [1, toxic]
                else:
                    n[0] += 1
                    n[1] += toxic
            if len(held) > 500_000:
                yield from flush()
    yield from flush()


def lexicon(rows: DataFrame) -> dict[str, float]:
    """Terms that mark toxic rows of ``rows`` (text, toxic), with their log odds, from all those rows.

    The evidence asked for rises with the number of terms that are frequent enough to be tested, so that fewer than one
    of them is expected to pass by chance, however many there are: the lexicon grows with the words that do mark toxic
    texts, not with the corpus.
    """
    total = rows.agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).first()
    n, t = total["n"], total["t"] or 0
    if not 0 < t < n:
        return {}
    counts = rows.select("text", "toxic").mapInArrow(_count_terms, "term string, docs long, toxic long")
    counts = counts.groupBy("term").agg(F.sum("docs").alias("docs"), F.sum("toxic").alias("toxic")).where(F.col("toxic") >= LEAST_DOCS)
    counts = materialise(counts, "terms")
    least = max(LEAST_EVIDENCE, 2 * math.log(max(1, counts.count())))
    expected = F.col("docs") * F.lit(t / n)
    clean = F.col("docs") - F.col("toxic")
    evidence = 2 * (F.col("toxic") * F.log(F.col("toxic") / expected) + F.when(clean > 0, clean * F.log(clean / (F.col("docs") - expected))).otherwise(0.0))
    lift = (F.col("toxic") + 0.5) / (t + 1) / ((clean + 0.5) / (n - t + 1))
    kept = counts.withColumn("evidence", evidence).withColumn("weight", F.log(lift)).where((F.col("evidence") >= least) & (lift >= LEAST_LIFT))
    return {r["term"]: r["weight"] for r in kept.select("term", "weight").toLocalIterator()}


def features(text: str, weights: dict[str, float]) -> list[float]:
    words = LETTERS.findall(text)
    lower = [w.lower() for w in words]
    n, chars = max(1, len(words)), max(1, len(text))
    distinct = set(lower)
    marked = distinct & weights.keys()
    by_prefix = {}
    for k in PREFIXES:
        for p in {f"{w[:k]}*" for w in distinct if len(w) >= k} & weights.keys():
            by_prefix[p[:-1]] = weights[p]
    hits = [i for i, w in enumerate(lower) if w in marked] if marked else []
    stems = [max((by_prefix[w[:k]] for k in PREFIXES if w[:k] in by_prefix), default=0.0) for w in lower] if by_prefix else []
    stem_hits = [i for i, v in enumerate(stems) if v]
    second = [i for i, w in enumerate(lower) if w in SECOND_PERSON] if distinct & SECOND_PERSON else []
    near = 0
    if second and (hits or stem_hits):
        at = np.array(second)
        for i in set(hits) | set(stem_hits):
            k = np.searchsorted(at, i)
            near += min(abs(int(at[min(k, len(at) - 1)]) - i), abs(int(at[max(0, k - 1)]) - i)) <= 5
    broken = BROKEN.findall(text)
    plain = [w.lower().translate(STANDS_FOR).strip(".,;:?") for w in text.split() if BROKEN.search(w)] if broken else []
    broken_hits = sum(w in weights for w in plain)
    upper = sum(map(str.isupper, words))
    capitals = sum(w[0].isupper() for w in words)
    marks = len(text) - sum(map(len, words)) - text.count(" ") - text.count("\n")
    return [
        float(np.log1p(len(words))), len(hits) / n, float(np.log1p(len(hits))), max((weights[w] for w in marked), default=0.0),
        len(stem_hits) / n, float(np.log1p(len(stem_hits))), max(stems, default=0.0), near / n, len(second) / n,
        capitals / n, upper / n, marks / chars, text.count("!") / chars, len(broken) / n, float(np.log1p(broken_hits)),
        len(STRETCHED.findall(text)) / n, sum(text.count(d) for d in "0123456789") / chars,
    ]


class Boosted:
    """Gradient-boosted trees for the logistic loss on binned features; a tree is complete to its depth."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        # Features that are mostly zero keep their other values apart.
        self.cuts = [np.unique(np.concatenate([k, np.quantile(c[c > 0], np.linspace(0, 1, 9)[:-1]) * (1 - 1e-9)])) if (c > 0).any() else k for k, c in zip(cuts, x.T)]
        b = self.binned(x)
        rate = float(np.clip(y.mean(), 1e-4, 1 - 1e-4))
        self.base, self.trees = float(np.log(rate / (1 - rate))), []
        f = np.full(len(y), self.base)
        width = max(len(c) for c in self.cuts) + 1
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-f))
            g, h = y - p, p * (1 - p)
            node, splits = np.zeros(len(y), np.int64), []
            for depth in range(DEPTH):
                k = 2**depth
                gs, hs = (np.stack([np.bincount(node * width + c, w, k * width).reshape(k, width) for c in b.T], axis=1).cumsum(axis=2) for w in (g, h))
                gt, ht = gs[:, :, -1:], hs[:, :, -1:]
                gain = gs**2 / (hs + RIDGE) + (gt - gs) ** 2 / (ht - hs + RIDGE)
                at = gain.reshape(k, -1).argmax(axis=1)
                feature, cut = at // width, at % width
                splits.append((feature, cut))
                node = 2 * node + (b[np.arange(len(y)), feature[node]] > cut[node])
            k = 2**DEPTH
            leaf = RATE * np.bincount(node, g, k) / (np.bincount(node, h, k) + RIDGE)
            self.trees.append((splits, leaf))
            f += leaf[node]

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(k, c, side="right") for k, c in zip(self.cuts, x.T)], axis=1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        b, f, rows = self.binned(x), np.full(len(x), self.base), np.arange(len(x))
        for splits, leaf in self.trees:
            node = np.zeros(len(x), np.int64)
            for feature, cut in splits:
                node = 2 * node + (b[rows, feature[node]] > cut[node])
            f += leaf[node]
        return f


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of a rising map from margins to rates: pooled neighbours, each pulled a little to the overall rate."""
    order = np.argsort(margin, kind="stable")
    blocks: list[list[float]] = []
    for m, v in zip(margin[order].tolist(), y[order].tolist()):
        blocks.append([m, v, 1.0])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            m2, v2, n2 = blocks.pop()
            blocks[-1] = [(blocks[-1][0] * blocks[-1][2] + m2 * n2) / (blocks[-1][2] + n2), blocks[-1][1] + v2, blocks[-1][2] + n2]
    rate = float(y.mean()) if len(y) else 0.0
    return np.array([b[0] for b in blocks]), np.maximum.accumulate([(b[1] + rate) / (b[2] + 1) for b in blocks])


def _rows_of_features(weights):
    def run(batches):
        for batch in batches:
            x = np.array([features(t, weights.value) for t in batch.column("text").to_pylist()], np.float64).reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), *(pa.array(c) for c in x.T)], names=["doc_id", "toxic", *FEATURES])

    return run


def _score(weights, model):
    def run(batches):
        trees, knots, rates, rate = model.value
        for batch in batches:
            x = np.array([features(t, weights.value) for t in batch.column("text").to_pylist()], np.float64).reshape(batch.num_rows, len(FEATURES))
            score = np.full(batch.num_rows, rate)
            if trees is not None and batch.num_rows:
                score = np.interp(trees.margin(x), knots, rates)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(np.clip(score, 0, 1))], names=["doc_id", "held_out", "score"])

    return run


def toxicity(docs: DataFrame, labels: DataFrame, modulus: int = 3, out: int = 1, threshold: float = 0.7) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.

    Learns from ``labels`` (doc_id, toxic) of rows whose crc32(doc_id as text) modulo ``modulus`` is not ``out``: of
    the other remainders, the first gives the lexicons, from all its rows, the rest the trees and their calibration,
    from at most FITTED rows that a hash of the id picks. The score sees the text alone.

    NULL and empty texts get the score of a text without words. A document with several labels is toxic if one says
    so; NULL labels and ids are no labels. Without labels of both kinds the score is the rate of toxic labels, or 0.
    Repeated rows get equal scores, an empty table gives none; other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    labels = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("long")).alias("toxic"))
    labels = labels.withColumn("part", id_remainder("doc_id", modulus)).where(F.col("part") != out)
    first = min(r for r in range(modulus) if r != out)
    # One plan at every size: labels grow with the documents, so they are never broadcast.
    taught = labels.where(F.col("part") == first).select("doc_id", "toxic").hint("merge")
    own = docs.where(id_remainder("doc_id", modulus) == first).join(taught, "doc_id")
    weights = spark.sparkContext.broadcast(lexicon(own))
    picked = labels.where(F.col("part") != first).orderBy(F.xxhash64("doc_id"), "doc_id").limit(FITTED).select("doc_id", "toxic")
    fitted = docs.where(~id_remainder("doc_id", modulus).isin(first, out)).join(F.broadcast(picked), "doc_id")
    schema = "doc_id long, toxic long, " + ", ".join(f"{c} double" for c in FEATURES)
    rows = fitted.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic", "text").mapInArrow(_rows_of_features(weights), schema)
    rows = rows.withColumn("turn", F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(4))).toPandas().sort_values(["doc_id", *FEATURES])
    y, turn = rows["toxic"].to_numpy(np.float64), rows["turn"].to_numpy()
    model = (None, None, None, float(y.mean()) if len(y) else 0.0)
    if all(len(np.unique(y[m])) == 2 for m in (turn > 0, turn == 0)):
        x = rows[FEATURES].to_numpy(np.float64)
        trees = Boosted(x[turn > 0], y[turn > 0])
        model = (trees, *isotonic(trees.margin(x[turn == 0]), y[turn == 0]), model[3])
    shared = spark.sparkContext.broadcast(model)
    scored = docs.select(F.col("doc_id"), (id_remainder("doc_id", modulus) == out).alias("held_out"), "text")
    scored = scored.mapInArrow(_score(weights, shared), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
