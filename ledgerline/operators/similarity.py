"""Exact top-k cosine search."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK = 2_000
CELL_ROWS = 50_000


def topk_cosine(
    queries: DataFrame,
    base: DataFrame,
    k: int,
    *,
    query_id: str,
    base_id: str,
    vector: str = "embedding",
    condition=None,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``k`` nearest base rows per query: query id, base id, ``score`` and ``rank``; ties by base id.

    ``condition`` filters the base before the search. Every task compares its part of the base with
    one block of queries as a matrix product and hands on at most ``k`` rows per query, so no group
    ever holds all candidates. Up to ``query_block`` queries travel as one block with the task; more
    are cut into blocks and the base is read once per block, spread over all tasks.

    Rows without a vector, or with a zero one, have no direction and are left out.
    """
    if condition is not None:
        base = base.filter(condition)
    qs = queries.filter(F.col(vector).isNotNull()).select(
        F.col(query_id).cast("long").alias("q"), F.col(vector).cast("array<double>").alias("v")
    )
    bs = base.filter(F.col(vector).isNotNull()).select(
        F.col(base_id).cast("long").alias("b"), F.col(vector).cast("array<double>").alias("v")
    )
    out = "q long, b long, score double"
    rows = qs.limit(query_block + 1).collect()
    if len(rows) <= query_block:
        block = (np.array([r.q for r in rows], dtype=np.int64), [r.v for r in rows])
        local = bs.mapInPandas(_against(block, k), out)
    else:
        local = _block_cells(qs, bs, k, query_block, out)
    best = _best(local, k)
    return best.select(F.col("q").alias(query_id), F.col("b").alias(base_id), "score", "rank")


def _best(df: DataFrame, k: int) -> DataFrame:
    """Largest ``k`` scores per query; the rank filter also runs before the shuffle."""
    w = Window.partitionBy("q").orderBy(F.desc("score"), F.asc("b"))
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _block_cells(qs: DataFrame, bs: DataFrame, k: int, query_block: int, out: str) -> DataFrame:
    """Cell (i, j) compares query block i with base part j."""
    q_blocks = -(-qs.count() // query_block)
    parts = max(1, -(-bs.count() // CELL_ROWS))
    left = qs.withColumn("i", F.pmod(F.xxhash64("q"), F.lit(q_blocks))).withColumn(
        "j", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))
    )
    right = bs.withColumn("j", F.pmod(F.xxhash64("b"), F.lit(parts))).withColumn(
        "i", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(q_blocks - 1).cast("long")))
    )
    return left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInPandas(_cell(k), out)


def _kernel():
    """The compare step. Nested functions travel to the workers by value, without this package."""

    def unit(ids, vectors):
        m = np.array(list(vectors), dtype=np.float64)
        if m.size == 0:
            return ids[:0], np.zeros((0, 0))
        norm = np.sqrt((m * m).sum(axis=1))
        ok = norm > 0
        return ids[ok], m[ok] / norm[ok, None]

    def best(qi, bi, sc, k):
        order = np.lexsort((bi, -sc, qi))
        qi, bi, sc = qi[order], bi[order], sc[order]
        first = np.flatnonzero(np.r_[True, np.diff(qi) != 0]) if len(qi) else np.empty(0, int)
        size = np.diff(np.r_[first, len(qi)])
        keep = np.arange(len(qi)) - np.repeat(first, size) < k
        return qi[keep], bi[keep], sc[keep]

    def compare(q, b, k):
        (qid, qm), (bid, bm) = q, b
        if len(qid) == 0 or len(bid) == 0:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        s = qm @ bm.T
        if s.shape[1] > k:
            # Everything level with the k-th score stays, so that ids decide ties.
            kth = np.partition(s, -k, axis=1)[:, -k]
            r, c = np.nonzero(s >= kth[:, None])
        else:
            r, c = np.indices(s.shape).reshape(2, -1)
        return best(qid[r], bid[c], s[r, c], k)

    return unit, best, compare


def _against(block, k: int):
    unit, best, compare = _kernel()
    ids, vectors = block

    def run(batches):
        q = unit(ids, vectors)
        have = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        for pdf in batches:
            new = compare(q, unit(pdf["b"].to_numpy(), pdf["v"]), k)
            have = best(*[np.concatenate(p) for p in zip(have, new)], k)
        yield pd.DataFrame(dict(zip(("q", "b", "score"), have)))

    return run


def _cell(k: int):
    unit, _, compare = _kernel()

    def run(q, b):
        found = compare(unit(q["q"].to_numpy(), q["v"]), unit(b["b"].to_numpy(), b["v"]), k)
        return pd.DataFrame(dict(zip(("q", "b", "score"), found)))

    return run
