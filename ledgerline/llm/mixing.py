"""Mixing sources to target weights: fixed blocks of words, drawn shard by shard without replacement."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ledgerline.llm.common import frugal, materialise

#: Words of a block, blocks of an output shard, rows of one step of a running sum.
BLOCK, SHARD, STEP = 256, 4_096, 256
SEED = 20_240_229
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def word_count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long")


def share_out(sizes: list[int], weights: list[float], factor: float, most: float) -> list[float]:
    """Targets that sum to ``factor`` of all sizes by weight, none above ``most`` times its size.

    What a target exceeds its limit by goes to the others by their weights, until none exceeds it.
    """
    left, full, targets = factor * sum(sizes), set(), [0.0] * len(sizes)
    while True:
        open_ = [i for i in range(len(sizes)) if i not in full]
        total = sum(weights[i] for i in open_)
        for i in open_:
            targets[i] = left * weights[i] / total
        over = [i for i in open_ if targets[i] > most * sizes[i]]
        if not over:
            return targets
        for i in over:
            targets[i] = float(most * sizes[i])
            left -= targets[i]
        full.update(over)


def _feistel(index: np.ndarray, n: int, key: int, back: bool) -> np.ndarray:
    """A pseudorandom permutation of range(n), or its inverse, by a Feistel network and cycle walking."""
    half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    keys = np.random.default_rng([SEED, key]).integers(0, 2**63, 6, dtype=np.uint64)

    def once(x):
        left, right = x >> half, x & mask
        for k in keys[::-1] if back else keys:
            a, b = (left, right) if back else (right, left)
            f = (a + k) * np.uint64(0x9E3779B97F4A7C15)
            f = ((f ^ (f >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)) & mask
            left, right = (b ^ f, a) if back else (a, b ^ f)
        return (left << half) | right

    out = once(index.astype(np.uint64))
    while (far := out >= n).any():
        out[far] = once(out[far])
    return out.astype(np.int64)


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    return _feistel(index, n, key, back=False)


class Plan:
    """What each source gives: its blocks, the slots it fills, and the words of its last slot."""

    def __init__(self, sizes: list[int], targets: list[float], block: int):
        self.sizes, self.block = sizes, block
        self.blocks = [-(-s // block) for s in sizes]
        self.slots, self.cuts = [], []
        for i, (size, target) in enumerate(zip(sizes, targets)):
            words = int(round(target))
            turns, rest = divmod(words, size) if size else (0, 0)
            n, cut = self.blocks[i], block
            used = 0
            if rest:
                short = n * block - size
                at = int(_feistel(np.array([n - 1]), n, self.key(i, turns), back=True)[0]) if short else n
                used = -(-rest // block)
                if at < used and used * block - short < rest:
                    used += 1
                cut = rest - ((used - 1) * block - (short if at < used - 1 else 0))
            self.slots.append(turns * n + used)
            self.cuts.append(cut)

    @staticmethod
    def key(source: int, turn: int) -> int:
        return source * 1_000 + turn


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` drawn from ``good`` and ``bad`` are good, by inversion; counts may be of any size.

    Ten spreads to either side of the mode hold all that a double-precision draw can tell from 0 and 1.
    """
    total, least, most = good + bad, max(0, n - bad), min(good, n)
    if least == most:
        return least
    mode = (n + 1) * (good + 1) // (total + 2)
    reach = int(10 * np.sqrt(n / total * good * (bad / total) * ((total - n) / max(total - 1, 1)))) + 100
    least, most = max(least, mode - reach), min(most, mode + reach)
    k = np.arange(least, most, dtype=np.float64)
    logs = np.concatenate([[0.0], np.cumsum(np.log((good - k) / (k + 1) * ((n - k) / (bad - n + k + 1))))])
    sums = np.cumsum(np.exp(logs - logs.max()))
    return least + min(int(np.searchsorted(sums, rng.random() * sums[-1], side="right")), most - least)


def halves(counts: np.ndarray, first: int, seed: list[int]) -> np.ndarray:
    """How many of each kind fall to the first half, drawn without replacement."""
    rng = np.random.default_rng(seed)
    rest, out = int(counts.sum()), np.zeros(len(counts), np.int64)
    for i, n in enumerate(counts.tolist()):
        rest -= n
        out[i] = hypergeometric(rng, n, rest, first)
        first -= int(out[i])
    return out


def _slots(plan: Plan, shards: int):
    """Rows (shard, slot, source, turn, block, words) of each shard, found by descending a tree of drawn halves."""

    def run(batches):
        # Draws for many slots, near the root, are met by every shard of a task.
        drawn: dict[tuple[int, int], np.ndarray] = {}
        for frame in batches:
            parts = []
            for shard in frame["id"].tolist():
                low, high, counts, before = 0, shards, np.array(plan.slots, np.int64), np.zeros(len(plan.slots), np.int64)
                while high - low > 1:
                    mid = (low + high) // 2
                    left = drawn.get((low, high))
                    if left is None:
                        left = halves(counts, min((mid - low) * SHARD, int(counts.sum())), [SEED, low, high])
                        if high - low > 256:
                            drawn[low, high] = left
                    if shard < mid:
                        high, counts = mid, left
                    else:
                        low, counts, before = mid, counts - left, before + left
                rng = np.random.default_rng([SEED, shard, 0, 1])
                place = rng.permutation(int(counts.sum()))
                at = 0
                for s in np.flatnonzero(counts):
                    k = before[s] + np.arange(counts[s])
                    turn, index = k // plan.blocks[s], k % plan.blocks[s]
                    block = np.empty(len(k), np.int64)
                    for t in np.unique(turn):
                        block[turn == t] = permuted(index[turn == t], plan.blocks[s], Plan.key(int(s), int(t)))
                    words = np.where(k == plan.slots[s] - 1, plan.cuts[s], plan.block)
                    parts.append(pd.DataFrame({"shard": shard, "slot": place[at : at + len(k)], "source_no": s, "turn": turn, "block": block, "words": words}))
                    at += len(k)
            yield pd.concat(parts) if parts else pd.DataFrame({c: pd.Series(dtype="int64") for c in SLOT})

    return run


SLOT = ["shard", "slot", "source_no", "turn", "block", "words"]


def running_start(rows: DataFrame, key: str, order: list[str], size: str) -> DataFrame:
    """``rows`` with ``start``: the sum of ``size`` over the rows of the same ``key`` that stand before.

    Rows are dealt to small steps by a hash and stand in the order (step, ``order``). Sums of steps are summed over
    in the same way, level by level, so that no window holds more than some STEP rows, however hot a key is.
    """
    count = rows.count()
    steps = [max(1, -(-count // STEP))]
    while steps[-1] > 2 * STEP:
        steps.append(-(-steps[-1] // STEP))
    rows = rows.withColumn("step0", F.pmod(F.xxhash64(*order), F.lit(steps[0])))
    totals = rows.groupBy(key, "step0").agg(F.sum(size).alias("sum0"))
    levels = [materialise(totals, "steps")]
    for i in range(1, len(steps)):
        up = levels[-1].withColumn(f"step{i}", (F.col(f"step{i - 1}") / STEP).cast("long"))
        levels.append(up.groupBy(key, f"step{i}").agg(F.sum(f"sum{i - 1}").alias(f"sum{i}")))
    before = lambda c, w: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    top = len(steps) - 1
    at = levels[top].select(key, f"step{top}", before(f"sum{top}", Window.partitionBy(key).orderBy(f"step{top}")).alias("at"))
    for i in range(top - 1, -1, -1):
        own = levels[i].withColumn(f"step{i + 1}", (F.col(f"step{i}") / STEP).cast("long"))
        own = own.withColumn("in", before(f"sum{i}", Window.partitionBy(key, f"step{i + 1}").orderBy(f"step{i}")))
        at = own.join(at, [key, f"step{i + 1}"]).select(key, f"step{i}", (F.col("at") + F.col("in")).alias("at"))
    inside = before(size, Window.partitionBy(key, "step0").orderBy(*order))
    return rows.withColumn("in", inside).join(at, [key, "step0"]).withColumn("start", F.col("at") + F.col("in")).drop("in", "at", "step0")


def mix(docs: DataFrame, carry: list[str], weights: tuple[float, ...] = (3, 1, 2), factor: float = 1.5, most: float = 2.0, block: int = BLOCK):
    """Mix the words of ``docs`` (doc_id, text, source) by source weight; the columns ``carry`` stay in a struct.

    Sources stand by code point, NULL last, and weigh ``weights``, repeating. Targets: see ``share_out``. Each source
    is one run of words, cut into blocks. Output shards of SHARD slots draw how many slots each source gets, without
    replacement from exact totals; the slots of a source walk through a pseudorandom permutation of its blocks, one
    for each turn through the source. A source's last slot takes the rest of its target only, so taken words equal
    the rounded target.

    Returns (rows, ranges): ``rows`` has doc (the carried columns), row, size, source_no, source_size and target;
    ``ranges`` says (row, shard, slot, turn, from, to) which words of a row stand in which slot. Texts that are NULL
    or have no word are never taken. Repeated rows are rows of their own. The same rows give the same mix, whatever
    their order. What reaches the driver is one row for each source.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.struct(*carry).alias("doc"), F.monotonically_increasing_id().alias("row"), "doc_id", "source",
        word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("text_hash"),
    )
    rows = materialise(rows, "mix")
    found = rows.groupBy("source").agg(F.sum("size").alias("size")).collect()
    found = sorted(found, key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    sizes = [int(r["size"]) for r in found]
    targets = share_out(sizes, [float(weights[i % len(weights)]) for i in range(len(found))], factor, most) if found else []
    plan = Plan(sizes, targets, block)
    named = spark.createDataFrame([(r["source"], i, sizes[i], targets[i]) for i, r in enumerate(found)], "name string, source_no long, source_size long, target double")
    rows = rows.join(F.broadcast(named), F.col("source").eqNullSafe(F.col("name"))).drop("name")
    slim = rows.where("size > 0").select("row", "doc_id", "text_hash", "source_no", "size")
    slim = running_start(slim, "source_no", ["doc_id", "text_hash", "row"], "size")
    own = slim.select("row", "source_no", "start", "size", F.explode(F.sequence((F.col("start") / block).cast("long"), ((F.col("start") + F.col("size") - 1) / block).cast("long"))).alias("block"))
    shards = -(-sum(plan.slots) // SHARD)
    slots = spark.range(shards).repartition(max(1, min(shards, 10_000))).mapInPandas(frugal(_slots(plan, shards)), ", ".join(f"{c} long" for c in SLOT))
    # Slots grow with the words; Spark would take them for as small as the range they come from and broadcast them.
    met = own.join(slots.hint("merge"), ["source_no", "block"])
    low = F.greatest(F.lit(0).cast("long"), F.col("block") * block - F.col("start"))
    high = F.least(F.col("size"), F.col("block") * block + F.col("words") - F.col("start"))
    ranges = met.select("row", "shard", "slot", "turn", low.alias("from"), high.alias("to")).where(F.col("from") < F.col("to"))
    return rows.select("doc", "row", "size", "source_no", "source_size", "target"), ranges


def mixed_counts(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: doc_id, size, source_size, target, taken (see ``mix``)."""
    rows, ranges = mix(docs, ["doc_id"])
    taken = ranges.groupBy("row").agg(F.sum(F.col("to") - F.col("from")).alias("taken"))
    out = rows.join(taken, "row", "left")
    return out.select("doc.doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))


def _cut(names: list[str]):
    def run(batches):
        for batch in batches:
            texts = []
            for text, size, ranges in zip(*(batch.column(len(names) + i).to_pylist() if i >= 0 else batch.column(names.index("text")).to_pylist() for i in (-1, 0, 1))):
                ranges = sorted((r["from"], r["to"]) for r in ranges)
                if sum(b - a for a, b in ranges) == size:
                    texts.append(text)
                    continue
                starts = [m.start() for m in WORDS.finditer(text)] + [len(text)]
                runs: list[list[int]] = []
                for a, b in ranges:
                    if runs and runs[-1][1] == a:
                        runs[-1][1] = b
                    else:
                        runs.append([a, b])
                texts.append("\n".join(text[starts[a] : starts[b]].rstrip() for a, b in runs))
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == "text" else batch.column(i) for i, c in enumerate(names)], names=[f"c{i}" for i in range(len(names))])

    return run


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as documents: for each turn through its source, a row with the words of a document that were taken.

    Columns are those of ``docs``. A document of which nothing is taken is not in the mix; one that is taken whole
    keeps its text as it is. Runs of words that do not touch are joined by a line break.
    """
    rows, ranges = mix(docs, docs.columns)
    parts = ranges.groupBy("row", "turn").agg(F.collect_list(F.struct("from", "to")).alias("ranges"))
    names = docs.columns
    taken = rows.join(parts, "row").select(*[F.col("doc").getField(c).alias(f"c{i}") for i, c in enumerate(names)], "size", "ranges")
    fields = [StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema.fields)]
    return taken.mapInArrow(frugal(_cut(names)), StructType(fields)).toDF(*names)
