"""Periodic runs of words by uniting suffix classes in the order of decreasing common prefixes."""

from __future__ import annotations

from bisect import bisect_left
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import mix64, text_groups

RUNS = "array<struct<start:long,length:long,period:long>>"


def least_prefix(min_length: int, min_powers: int) -> int:
    """What two suffixes a period apart share at least if they begin a run of these measures."""
    return min(max((min_powers - 1) * q, min_length - q) for q in range(1, min_length + 1))


def suffix_order(ids: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the order of their suffixes, and how much each shares with the one before it.

    Only positions whose next ``least`` symbols occur again (and those that follow such a stretch) are sorted: first by
    these symbols, then by doubled stretches among the ones still equal. Two that share less than ``least`` count 0.
    """
    n = len(ids)
    padded = np.concatenate([ids, np.full(least, -1, np.int64)])
    spread, code = mix64(padded.astype(np.uint64) + np.uint64(1)), np.zeros(n + 1, np.uint64)
    for k in range(least):
        code = code * np.uint64(0x9E3779B97F4A7C15) + spread[k : k + n + 1]
    in_order = np.sort(code)
    twice = np.unique(in_order[1:][in_order[1:] == in_order[:-1]])
    if not len(twice):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    again = np.flatnonzero(twice[np.minimum(np.searchsorted(twice, code), len(twice) - 1)] == code)
    base = np.union1d(again[again + least <= n], again[again + least <= n] + least)
    place = np.full(n + 1, -1, np.int64)
    place[base] = np.arange(len(base))
    columns = padded[base[:, None] + np.arange(least)]
    order = np.lexsort(columns.T[::-1])
    new = np.concatenate([[True], (columns[order[1:]] != columns[order[:-1]]).any(axis=1)])
    slots = np.arange(len(base))
    rank = np.empty(len(base), np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, slots, 0))
    ranks, step = [rank], least
    while True:
        group = rank[order]
        tied = np.flatnonzero((np.append(group[1:], -1) == group) | (np.append(-1, group[:-1]) == group))
        if not len(tied):
            break
        members = order[tied]
        # Those still equal share ``step`` symbols, so what follows them is in the base as well.
        after = rank[place[base[members] + step]]
        sort = np.lexsort((after, group[tied]))
        members, after, own = members[sort], after[sort], group[tied]
        new = np.concatenate([[True], (own[1:] != own[:-1]) | (after[1:] != after[:-1])])
        order[tied] = members
        rank = rank.copy()
        rank[members] = np.maximum.accumulate(np.where(new, tied, 0))
        ranks.append(rank)
        step *= 2
    shared = np.zeros(len(base), np.int64)
    at = np.flatnonzero(ranks[0][order[1:]] == ranks[0][order[:-1]]) + 1
    i, j = base[order[at - 1]], base[order[at]]
    length = np.full(len(at), least, np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        a, b = place[i + length], place[j + length]
        length += (least << level) * ((a >= 0) & (b >= 0) & (ranks[level][a] == ranks[level][b]))
    going = np.ones(len(at), bool)
    for _ in range(least - 1):
        going &= padded[i + length] == padded[j + length]
        length += going
    shared[at] = length
    return base[order], shared


def seeds(positions: np.ndarray, shared: np.ndarray, min_length: int, min_powers: int) -> np.ndarray:
    """(left position, distance, shared) of positions that come to lie side by side in a class of suffixes.

    Neighbours in the order of suffixes are united by decreasing shared length. The positions of a class are an ordered
    list; the shorter list goes into the longer one, and a pair so made shares exactly the current length. Pairs are
    kept whose distance goes often enough into it.
    """
    edges = np.flatnonzero(shared)
    edges = edges[np.argsort(-shared[edges], kind="stable")]
    parent, members, found = {}, {}, []

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    text_order = positions.tolist()
    for edge, length in zip(edges.tolist(), shared[edges].tolist()):
        a, b = root(edge - 1), root(edge)
        few, many = members.pop(a, None) or [text_order[a]], members.pop(b, None) or [text_order[b]]
        if len(few) > len(many):
            few, many = many, few
        far, near, last = length // (min_powers - 1), min_length - length, -1
        for p in few:
            k = bisect_left(many, p)
            if k and many[k - 1] != last and near <= p - many[k - 1] <= far:
                found.append((many[k - 1], p - many[k - 1], length))
            if k < len(many) and near <= many[k] - p <= far:
                found.append((p, many[k] - p, length))
            many.insert(k, p)
            last = p
        parent[a] = b
        members[b] = many
    return np.array(found, np.int64).reshape(-1, 3)


def find_runs(ids: np.ndarray, min_length: int, min_powers: int) -> np.ndarray:
    """(start, length, period) of all runs of a sequence of numbers, by start, then period.

    A run is a stretch with smallest period q and length at least max(min_length, min_powers * q) that neither
    neighbour extends; min_powers is at least 2. A run's start and the position a period later come together in a class
    when exactly what they share is united, so each run has its seed; one that could begin earlier is none.
    """
    seed = seeds(*suffix_order(ids, least_prefix(min_length, min_powers)), min_length, min_powers)
    start, period = seed[:, 0], seed[:, 1]
    before = np.maximum(start - 1, 0)
    seed = seed[(start == 0) | (ids[before] != ids[np.minimum(before + period, len(ids) - 1)])]
    start, period, length = seed[:, 0], seed[:, 1], seed[:, 1] + seed[:, 2]
    order = np.lexsort((period, length, start))
    start, period, length = start[order], period[order], length[order]
    # A multiple of the smallest period gives the same stretch.
    first = np.ones(len(order), bool)
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    runs = np.stack([start, length, period], axis=1)[first]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _runs(min_length: int, min_powers: int):
    def run(batches):
        for batch in batches:
            others = [c for c in batch.schema.names if c != "text"]
            for part in text_groups(batch, "text"):
                texts = [t.encode().split() for t in part.column("text").to_pylist()]
                ids, bounds = [], [0]
                for words in texts:
                    # Numbers of their own for each text, so that no stretch reaches from one into the next.
                    numbers = dict(zip(dict.fromkeys(words), count(len(ids))))
                    ids += map(numbers.__getitem__, words)
                    bounds.append(len(ids))
                runs = find_runs(np.array(ids, np.int64), min_length, min_powers)
                cuts = np.searchsorted(runs[:, 0], bounds)
                listed, left = [], []
                for words, start, low, high in zip(texts, bounds, cuts[:-1].tolist(), cuts[1:].tolist()):
                    own = runs[low:high]
                    listed.append([{"start": s - start, "length": n, "period": q} for s, n, q in own.tolist()])
                    if len(own):
                        edge = np.zeros(len(words) + 1, np.int64)
                        np.add.at(edge, own[:, 0] + own[:, 2] - start, 1)
                        np.add.at(edge, own[:, 0] + own[:, 1] - start, -1)
                        words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
                    left.append(b" ".join(words))
                kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in others), pa.array(np.diff(bounds)), pa.array(listed, kind), pa.array([x.decode() for x in left], pa.string())],
                    names=[*others, "n_words", "runs", "collapsed"],
                )

    return run


def periodic_runs(docs: DataFrame, min_length: int = 6, min_powers: int = 4) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n_words, runs, collapsed.

    ``runs`` lists (start, length, period), numbered in words from 0, of all runs of at least ``min_length`` words and
    ``min_powers`` (2 or more) periods, by start, then period. ``collapsed`` is the text with only the first period of
    each run left, its words joined by one space.

    Texts are handled whole, in groups of bounded size within a task, a longer text by itself; nothing is shuffled.
    Memory grows with the longest text, as the suffixes that occur again are sorted with all ranks kept. Words are equal
    byte by byte. NULL, empty and blank texts have no words, no runs and collapse to the empty text. Repeated rows get
    equal results, ties cannot occur (a stretch has one smallest period), an empty table gives none; other columns are
    ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_runs(min_length, min_powers), f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with a tail of period p for documents whose crc32(doc_id as text) is divisible by ten.

    Each word i >= a of such a text becomes word a + (i - a) % p, where g = floor(crc32 / 10), a = g % n and
    p = 1 + floor((n - a) / (3 + g % 8)). A NULL doc_id counts as the empty text; texts without words stay.
    """
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), h.alias("h"))
    rows = rows.withColumn("words", F.when(F.col("h") % 10 == 0, F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")))
    n, g = F.size("words").cast("long"), F.expr("h div 10")
    rows = rows.withColumn("a", F.when(n > 0, g % n))
    rows = rows.withColumn("p", F.expr("1 + (size(words) - a) div (3 + (h div 10) % 8)"))
    turned = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(turned, " ")).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """One row for each row of ``periodic_runs``: the run with the most periods, and hashes of all runs and the rest."""
    better = lambda a, x: a.isNull() | (x["length"] * a["period"] > a["length"] * x["period"])
    # By start, then period; a later run is better only if it has more periods.
    best = F.aggregate("runs", F.lit(None).cast("struct<start:long,length:long,period:long>"), lambda a, x: F.when(better(a, x), x).otherwise(a))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    rows = found.withColumn("best", best)
    milli: Column = F.expr("1000 * best.length div best.period")
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        milli.alias("exponent_milli"), F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
