"""Quality by supervised subword embeddings: hashed word and letter n-gram vectors, averaged, with a softmax output."""

from __future__ import annotations

from itertools import count
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import id_remainder, mix64, text_groups

#: Hash cells of words and n-grams; lengths of n-grams, with a mark at each end of the word; size of a vector.
CELLS, GRAMS, SIZE = 1 << 17, (3, 4, 5), 8
#: Labelled documents that the model is fitted on at most, by a hash of the id; documents of a step, rounds, first rate.
FITTED, STEP, ROUNDS, RATE = 6_000, 128, 5, 0.3
CLASSES = 2
#: Stands for a word that is the same as the one before: a pair of words whose cell all such pairs share.
AGAIN = b"\n"


def tokens(text: str) -> list[bytes]:
    """The words of a text, split at blanks, and AGAIN for each that repeats the one before."""
    words = text.encode().split()
    return words + [AGAIN] * sum(map(eq, words, words[1:]))


def word_cells(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The cells of all words, word after word, and how many each has: one for the word, one for each n-gram."""
    marked = [f"<{w}>" for w in words]
    sizes = np.array([len(w) for w in marked], np.int64)
    c = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    owner = np.repeat(np.arange(len(words)), sizes)
    cells, owners = [], []
    for n in GRAMS:
        at = np.arange(max(0, len(c) - n + 1))
        at = at[owner[at] == owner[at + n - 1]]
        code = np.full(len(at), n, np.uint64)
        for k in range(n):
            code = mix64(code * np.uint64(0x9E3779B97F4A7C15) + c[at + k])
        cells.append(code)
        owners.append(owner[at])
    # The whole word: what its characters give at their places, added up.
    place = (np.arange(len(c)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.uint64)
    each = mix64(c * np.uint64(0xC2B2AE3D27D4EB4F) + place)
    cells.append(mix64(np.add.reduceat(each, np.cumsum(sizes) - sizes)) if len(words) else np.zeros(0, np.uint64))
    owners.append(np.arange(len(words)))
    cells, owners = np.concatenate(cells), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return (cells[order] % np.uint64(CELLS)).astype(np.int64), np.bincount(owners, minlength=len(words))


def in_parts(words: list[str], size: int = 10_000) -> tuple[np.ndarray, np.ndarray]:
    """As ``word_cells``, for many words: what is held on the way does not grow with them."""
    parts = [word_cells(words[i : i + size]) for i in range(0, len(words), size)] or [word_cells([])]
    return np.concatenate([c.astype(np.int32) for c, _ in parts]), np.concatenate([n for _, n in parts])


def _distinct(batches):
    """Each text as its distinct words and their counts."""
    for batch in batches:
        words, counts = [], []
        for text in batch.column("text").to_pylist():
            found: dict[bytes, int] = {}
            for w in tokens(text):
                found[w] = found.get(w, 0) + 1
            words.append(b" ".join(found).decode())
            counts.append(np.fromiter(found.values(), "<i4", len(found)).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(words, pa.string()), pa.array(counts, pa.binary())], names=["doc_id", "label", "words", "counts"])


class Model:
    """Vectors of the cells and the output layer, fitted by stochastic gradient descent with a rate for each cell."""

    def __init__(self, rows: pd.DataFrame):
        """``rows``: words (distinct, joined by a space), counts, label."""
        y = rows["label"].to_numpy(np.int64)
        rate = (np.bincount(y, minlength=CLASSES) + 1) / (len(y) + CLASSES)
        rng = np.random.default_rng(13)
        self.vectors = rng.uniform(-1 / SIZE, 1 / SIZE, (CELLS, SIZE)).astype(np.float32)
        self.output, self.bias = np.zeros((SIZE, CLASSES), np.float32), np.log(rate).astype(np.float32)
        self.rate = float(rate[1])
        if not len(y):
            return
        numbers: dict[bytes, int] = {}
        fresh = count()
        words = [np.array([numbers[w] if w in numbers else numbers.setdefault(w, next(fresh)) for w in (t.split(" ") if t else ())], np.int64) for t in rows["words"]]
        counts = [np.frombuffer(c, "<i4").astype(np.float32) for c in rows["counts"]]
        cells, sizes = in_parts(list(numbers))
        ends = np.cumsum(sizes)
        shares = [c / max(1.0, float(c @ sizes[w])) for w, c in zip(words, counts)]
        seen, seen_out, seen_bias = np.full(CELLS, 1e-8, np.float32), 1e-8, 1e-8
        steps = ROUNDS * -(-len(y) // STEP)
        step = 0
        for _ in range(ROUNDS):
            turn = rng.permutation(len(y))
            for i in range(0, len(y), STEP):
                rate_now = RATE * (1 - step / steps)
                step += 1
                docs = turn[i : i + STEP]
                own, of = np.unique(np.concatenate([words[d] for d in docs]), return_inverse=True)
                share = np.concatenate([shares[d] for d in docs]).astype(np.float32)
                doc = np.repeat(np.arange(len(docs)), [len(words[d]) for d in docs])
                # A table of documents by words, then the words' own cells.
                weight = np.zeros((len(docs), len(own)), np.float32)
                weight[doc, of] = share
                size = sizes[own]
                starts = np.cumsum(size) - size
                at = cells[np.repeat(ends[own] - size - starts, size) + np.arange(int(size.sum()))]
                per_word = np.add.reduceat(self.vectors[at], starts, axis=0) if len(own) else np.zeros((0, SIZE), np.float32)
                mean = weight @ per_word
                error = self._softmax(mean)
                error[np.arange(len(docs)), y[docs]] -= 1
                error /= len(docs)
                back = weight.T @ (error @ self.output.T)
                out = mean.T @ error
                seen_out += float((out**2).mean())
                seen_bias += float((error.sum(axis=0) ** 2).mean())
                self.output -= (rate_now / np.sqrt(seen_out)) * out
                self.bias -= 0.1 * (rate_now / np.sqrt(seen_bias)) * error.sum(axis=0)
                slope = np.stack([np.bincount(at, np.repeat(back[:, k], size), CELLS) for k in range(SIZE)], axis=1).astype(np.float32)
                seen += (slope**2).mean(axis=1)
                self.vectors -= (rate_now / np.sqrt(seen))[:, None] * slope
                if step == 1:
                    # The output layer begins apart from zero, so that the vectors have a direction to go.
                    self.output += rng.uniform(-0.5, 0.5, self.output.shape).astype(np.float32)

    def _softmax(self, mean: np.ndarray) -> np.ndarray:
        logits = mean @ self.output + self.bias
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def projected(self) -> np.ndarray:
        """Each cell's part in the outputs: the mean of these is the output of the mean vector."""
        return self.vectors.astype(np.float64) @ self.output


def _score(shared):
    def run(batches):
        table, bias = shared.value
        for batch in batches:
            for part in text_groups(batch, "text"):
                numbers: dict[str, int] = {}
                ids, bounds = [], [0]
                for text in part.column("text").to_pylist():
                    words = tokens(text)
                    numbers.update(zip([w for w in dict.fromkeys(words) if w not in numbers], count(len(numbers))))
                    ids += map(numbers.__getitem__, words)
                    bounds.append(len(ids))
                cells, sizes = word_cells([w.decode() for w in numbers])
                owner = np.repeat(np.arange(len(sizes)), sizes)
                sums = np.stack([*(np.bincount(owner, table[cells, k], len(sizes)) for k in range(CLASSES)), sizes], axis=1)
                total = np.zeros((part.num_rows, CLASSES + 1))
                bounds = np.array(bounds)
                full = np.flatnonzero(np.diff(bounds))
                if len(full):
                    total[full] = np.add.reduceat(sums[np.array(ids, np.int64)], bounds[full], axis=0)
                logits = total[:, :CLASSES] / np.maximum(total[:, CLASSES:], 1) + bias
                e = np.exp(logits - logits.max(axis=1, keepdims=True))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(e[:, 1] / e.sum(axis=1))], names=["doc_id", "held_out", "score"])

    return run


def quality_scores(docs: DataFrame, labels: DataFrame, modulus: int = 5, out: int = 0, threshold: float = 0.3) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.

    Learns from ``labels`` (doc_id, quality) of rows whose crc32(doc_id as text) modulo ``modulus`` is not ``out``, at
    most FITTED of them, which a hash of the id picks; their texts are used whole. Words, split at blanks, and their
    n-grams of letters are hashed into cells with a learned vector each; a text is the mean of its cells' vectors, and
    a softmax layer gives the score, the probability of label 1. The fit is on the driver, over the distinct words of
    the picked texts. Scoring is one pass without a shuffle, in groups of bounded size; a longer text stands alone. It
    sees the text alone, and only a table of CELLS x 2 numbers is sent to the tasks.

    NULL, empty and blank texts have no words and get the rate that the fit ends at for such. A document with several
    labels is good if one says so; NULL labels and ids are no labels. Without labels every score is 0.5, with labels of
    one kind their smoothed rate decides. Scores that tie stay tied; repeated rows get equal scores, an empty table
    gives none; other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    labels = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.max((F.col("quality") > 0).cast("long")).alias("label"))
    picked = labels.where(id_remainder("doc_id", modulus) != out).orderBy(F.xxhash64("doc_id"), "doc_id").limit(FITTED)
    # A bounded sample, so the hint is safe.
    taught = docs.join(F.broadcast(picked), "doc_id").select("doc_id", "label", "text")
    rows = taught.mapInArrow(_distinct, "doc_id long, label long, words string, counts binary").toPandas()
    model = Model(rows.sort_values(["doc_id", "words"], ignore_index=True))
    shared = spark.sparkContext.broadcast((model.projected(), model.bias.astype(np.float64)))
    scored = docs.select("doc_id", (id_remainder("doc_id", modulus) == out).alias("held_out"), "text")
    scored = scored.mapInArrow(_score(shared), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
