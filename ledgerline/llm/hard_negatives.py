"""Hard negatives by inner product: length buckets, sorted coordinate lists, feasible ranges, exact verification."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import materialise
from ledgerline.session import work_root

#: Lengths in one bucket differ by less than this ratio. Bytes of a block, a part of a bucket, on average.
RATIO, BLOCK_BYTES = 1.1, 4_194_304
#: Bytes of the anchors that every task holds at once. Anchors whose scores of a block are computed together.
LOT_BYTES, TOGETHER = 16_000_000, 256
#: Focus coordinates of an anchor. A range that holds more than this share of a block is not worth an intersection.
FOCUS, WORTH = 4, 0.25
#: Sums of products of whole numbers are exact in doubles below this.
EXACT = 2.0**52
LONG = 2**63 - 1


def lengths_of(x: np.ndarray) -> np.ndarray:
    """Euclidean lengths; scaled first, so that squares neither overflow nor vanish."""
    top = np.abs(x).max(axis=1, initial=0.0)
    scale = np.where(top > 0, top, 1.0)
    with np.errstate(over="ignore"):
        return scale * np.sqrt(((x / scale[:, None]) ** 2).sum(axis=1))


class Block:
    """Rows of one label, dimension and length bucket; for each coordinate their order by its share of the length."""

    def __init__(self, ids: np.ndarray, numbers: np.ndarray, x: np.ndarray):
        self.ids, self.numbers, self.x = ids, numbers, x
        self.length = lengths_of(x)
        self.order = np.argsort(x / np.where(self.length > 0, self.length, 1.0)[:, None], axis=0, kind="stable").astype(np.uint32)

    def shares(self, f: int) -> np.ndarray:
        """The shares of the length that coordinate ``f`` has, rising."""
        at = self.order[:, f]
        return self.x[at, f] / np.where(self.length[at] > 0, self.length[at], 1.0)


def scores(x: np.ndarray, q: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products of whole numbers: doubles where these are exact, else Python's numbers, as the nearest long."""
    if exact:
        return x @ q
    whole = [int(v) for v in q.tolist()]
    sums = [sum(int(a) * b for a, b in zip(row, whole)) for row in x.tolist()]
    return np.array([max(-LONG - 1, min(LONG, s)) for s in sums], np.int64)


def candidates(block: Block, anchors: np.ndarray, lengths: np.ndarray, least: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    """(anchors, rows): groups of anchors with the rows of the block that may score ``least`` or more; None is all rows.

    A row that scores so much has a cosine of at least t = least / (both lengths), so its share p of a coordinate, where
    the anchor's is q, lies within q * t -+ sqrt((1 - t^2) * (1 - q^2)). The ranges of the anchor's largest coordinates
    are found in the sorted lists; what lies in all of them is verified. No row that scores enough is left out.
    """
    longest = float(block.length.max(initial=0.0))
    reach = lengths * longest
    with np.errstate(divide="ignore", invalid="ignore"):
        t = np.where(least <= 0, -1.0, np.where(reach > 0, least / reach, 2.0)) - 1e-9
    alive = np.flatnonzero(t <= 1.0)
    # A positive score is asked for where t > 0; else every row is feasible.
    tight = alive[t[alive] > 0]
    whole = [alive[t[alive] <= 0]]
    if len(tight):
        unit = anchors[tight] / lengths[tight, None]
        k = min(FOCUS, unit.shape[1])
        focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :k]
        q = np.take_along_axis(unit, focus, axis=1)
        wide = np.sqrt(np.maximum(0.0, 1 - t[tight, None] ** 2) * np.maximum(0.0, 1 - q**2)) + 1e-7
        # Shorter rows of the bucket need a larger cosine still, so the longest one's t gives the widest range.
        low, high = q * t[tight, None] - wide, q * t[tight, None] + wide
        # The range is one side of the cap only where the cap does not hold the axis itself.
        high = np.where(q >= t[tight, None], 2.0, high)
        low = np.where(-q >= t[tight, None], -2.0, low)
        start, end = np.empty(focus.shape, np.int64), np.empty(focus.shape, np.int64)
        for f in np.unique(focus):
            held, shares = focus == f, block.shares(int(f))
            start[held], end[held] = np.searchsorted(shares, low[held], "left"), np.searchsorted(shares, high[held], "right")
        size, n = end - start, len(block.ids)
        few = size.min(axis=1) <= WORTH * n
        whole.append(tight[~few])
        for a in np.flatnonzero(few).tolist():
            rows = None
            for c in np.argsort(size[a], kind="stable").tolist():
                if rows is not None and size[a, c] > WORTH * n:
                    break
                listed = block.order[start[a, c] : end[a, c], focus[a, c]]
                rows = listed if rows is None else np.intersect1d(rows, listed, assume_unique=True)
            if len(rows):
                yield tight[a : a + 1], rows
    every = np.concatenate(whole)
    for i in range(0, len(every), TOGETHER):
        yield every[i : i + TOGETHER], None


class Best:
    """The first ``limit`` rows by score, then vec_id, of those between two scores, for one anchor."""

    def __init__(self, limit: int, low, high):
        self.limit, self.low, self.high, self.found = limit, low, high, []

    @property
    def least(self):
        """Rows below this change nothing any more."""
        return max(self.low, self.found[-1][0]) if len(self.found) >= self.limit else self.low

    def add(self, s: np.ndarray, ids: np.ndarray) -> None:
        at = np.flatnonzero((s >= self.least) & (s <= self.high))
        if len(at) > 4 * self.limit:
            # Ties with the last place stay in.
            last = np.sort(s[at])[-self.limit]
            at = at[s[at] >= last]
        if len(at):
            rows = sorted([(int(s[i]), int(ids[i])) for i in at.tolist()] + self.found, key=lambda r: (-r[0], r[1]))
            self.found = rows[: self.limit]


def _search(shared, same_label: bool, limit: int):
    """Rows of blocks against all anchors of the lot: for each anchor and each of its ranges the best rows of the task.

    What was found in earlier blocks of the task raises the score that a row needs, so longer rows come first.
    """

    def run(frames):
        lot = shared.value
        state = [[Best(limit, low, high) for low, high in own] for own in lot["ranges"]]
        least = np.array([min((float(b.least) for b in own), default=np.inf) for own in state])
        for blob in (blob for frame in frames for blob in frame["block"]):
            label, block = pickle.loads(blob)
            met = np.flatnonzero((lot["size"] == block.x.shape[1]) & ((lot["label"] == label) == same_label) & (least < np.inf))
            if not len(met):
                continue
            anchors, lengths = np.stack([lot["vectors"][a] for a in met]), lot["length"][met]
            exact = lengths * float(block.length.max(initial=0.0)) < EXACT
            for group, rows in _groups(block, anchors, lengths, least[met], exact):
                x, ids, numbers = (block.x, block.ids, block.numbers) if rows is None else (block.x[rows], block.ids[rows], block.numbers[rows])
                table = anchors[group] @ x.T if exact[group[0]] else (scores(x, anchors[g], False) for g in group)
                for a, s in zip(met[group].tolist(), table):
                    own = ids
                    if same_label and (numbers == lot["number"][a]).any():
                        other = numbers != lot["number"][a]
                        s, own = s[other], ids[other]
                    for best in state[a]:
                        best.add(s, own)
                    least[a] = min(float(b.least) for b in state[a])
        out = [(a, r, i, s) for a, own in enumerate(state) for r, best in enumerate(own) for s, i in best.found]
        yield pd.DataFrame(np.array(out, np.int64).reshape(-1, 4), columns=["anchor", "nth", "vec_id", "score"])

    return run


def _groups(block: Block, anchors: np.ndarray, lengths: np.ndarray, least: np.ndarray, exact: np.ndarray):
    """As ``candidates``; anchors whose scores are not exact in doubles meet all rows."""
    sure, rest = np.flatnonzero(exact), np.flatnonzero(~exact)
    for group, rows in candidates(block, anchors[sure], lengths[sure], least[sure]):
        yield sure[group], rows
    for i in range(0, len(rest), TOGETHER):
        yield rest[i : i + TOGETHER], None


def _whole(frames):
    """Components as floor(256 * x), with the length's bucket; what overflows is the largest double."""
    most = np.finfo(np.float64).max
    for frame in frames:
        out = frame[["vec_id", "label", "number"]].copy()
        with np.errstate(over="ignore"):
            x = [np.clip(np.floor(256.0 * np.asarray(e, np.float64)), -most, most) for e in frame["embedding"]]
        length = np.array([lengths_of(v[None])[0] for v in x])
        bucket = np.floor(np.log(np.clip(length, 1.0, most)) / np.log(RATIO))
        out["vector"], out["size"], out["bucket"] = [v.tobytes() for v in x], [len(v) for v in x], np.where(length > 0, bucket, -1).astype(np.int64)
        yield out


def _build(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("number")
    x = np.frombuffer(b"".join(frame["vector"]), np.float64).reshape(len(frame), int(frame["size"].iloc[0]))
    block = Block(frame["vec_id"].to_numpy(np.int64), frame["number"].to_numpy(np.int64), x)
    label = frame["label"].iloc[0]
    return pd.DataFrame({"longest": [float(block.length.max())], "block": [pickle.dumps((label.item() if hasattr(label, "item") else label, block), protocol=5)]})


def _lots(anchors: DataFrame, dimension: int) -> int:
    return max(1, -(-anchors.count() * 8 * max(1, dimension) // LOT_BYTES))


def hard_negatives(
    vectors: DataFrame, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, every: int = 100
) -> DataFrame:
    """Rows of other labels that score nearly as well as an anchor's best rows of its own label.

    ``vectors``: vec_id, embedding, label. Components become floor(256 * x), scores are inner products of these whole
    numbers. Anchors are the rows whose vec_id is divisible by ``every``. An anchor's positives are its ``positives``
    best other rows of the same label; for each, the ``negatives`` best rows of other labels are returned whose score
    is from ``low`` to ``high`` per cent of the positive's (none where that is negative), higher scores first, ties by
    smaller vec_id: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows are dealt to blocks by label, dimension, bucket of length and a hash, so that a label or bucket with a third of
    all rows is many blocks. Anchors go round in lots of bounded bytes, each broadcast for two passes over the blocks:
    same label, then other labels. A task keeps the best rows of each anchor and range, so what leaves it is bounded
    by the lot; the best of all tasks are taken by a window that Spark cuts before its shuffle.

    Rows with a NULL vec_id, label or vector, or a NULL or non-finite component take no part. Vectors of different
    dimension never meet; an empty vector scores 0. Repeated rows count each: all but the anchor's own row may be its
    positives, and an anchor that is there twice gives its rows twice. Scores beyond 64 bits count as the nearest
    long. Other columns are ignored, an empty table gives none.
    """
    spark, kind = vectors.sparkSession, vectors.schema["label"].dataType.simpleString()
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), "label")
    sound = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & sound)
    # Written with its numbers, which tell repeated rows apart and must not change when a task is run again.
    rows = rows.withColumn("number", F.monotonically_increasing_id())
    rows = materialise(rows.mapInPandas(_whole, f"vec_id long, label {kind}, number long, vector binary, size int, bucket long"), "vectors")

    key = ["label", "size", "bucket"]
    bytes_ = F.count("*") * 8 * F.greatest(F.col("size"), F.lit(1))
    parts = rows.groupBy(*key).agg(F.ceil(bytes_ / BLOCK_BYTES).cast("int").alias("parts"))
    # One row for each label and length bucket; labels may be many, so the join is left to Spark.
    dealt = rows.join(parts, key).withColumn("part", F.pmod(F.xxhash64("number"), F.col("parts")))
    blocks = dealt.groupBy(*key, "part").applyInPandas(_build, "longest double, block binary")
    blocks = materialise(blocks.sortWithinPartitions(F.desc("longest")), "blocks")

    anchors = rows.where(F.col("vec_id") % every == 0).select("vec_id", "label", "number", "vector", "size")
    path = work_root(spark, "negatives")
    for size in sorted(r["size"] for r in anchors.select("size").distinct().collect()):
        own = anchors.where(F.col("size") == size)
        lots = max(1, -(-own.count() * 8 * max(1, size) // LOT_BYTES))
        for k in range(lots):
            lot = own.where(F.pmod(F.xxhash64("number", F.lit("lot")), F.lit(lots)) == k).toPandas().sort_values("number", ignore_index=True)
            if len(lot):
                _mine(spark, blocks, lot, positives, negatives, low, high).write.mode("append").parquet(path)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


FOUND = "anchor long, nth long, vec_id long, score long"


def _best(found: DataFrame, limit: int) -> DataFrame:
    order = Window.partitionBy("anchor", "nth").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)


def _mine(spark, blocks: DataFrame, lot: pd.DataFrame, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """The negatives of one lot of anchors of one dimension, in two passes over the blocks."""
    x = np.frombuffer(b"".join(lot["vector"]), np.float64).reshape(len(lot), -1)
    held = {"vectors": x, "length": lengths_of(x), "size": lot["size"].to_numpy(), "label": lot["label"].to_numpy(), "number": lot["number"].to_numpy()}
    shared = spark.sparkContext.broadcast({**held, "ranges": [[(-LONG - 1, LONG)]] * len(lot)})
    # At most ``positives`` rows for each anchor of the lot reach the driver.
    same = _best(blocks.mapInPandas(_search(shared, True, positives), FOUND), positives).toPandas().sort_values(["anchor", "rank"])
    ranges: list[list] = [[] for _ in range(len(lot))]
    known = []
    for a, i, s in zip(same["anchor"].tolist(), same["vec_id"].tolist(), same["score"].tolist()):
        known.append((a, len(ranges[a]), int(lot["vec_id"][a]), i, s))
        # Whole scores from low to high per cent, both ends included; a negative one has none.
        ranges[a].append((-(-low * s // 100), high * s // 100) if low * s <= high * s else (LONG, -LONG - 1))
    shared = spark.sparkContext.broadcast({**held, "ranges": ranges})
    other = _best(blocks.mapInPandas(_search(shared, False, negatives), FOUND), negatives)
    of = spark.createDataFrame(known, "anchor long, nth long, anchor_id long, positive_id long, positive_score long")
    # As many rows as the lot has anchors and positives, so the hint is safe.
    joined = other.join(F.broadcast(of), ["anchor", "nth"])
    return joined.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
