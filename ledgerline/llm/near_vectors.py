"""Near duplicates of vectors by a forest of random-projection trees with spill overlap."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import materialise
from ledgerline.llm.graph import components

#: Trees of the forest; vectors of a leaf at most, unless it cannot be split; vectors that a node's splits are
#: fitted on at most; levels that are fitted at once.
TREES, LEAF, FITTED, LEVELS = 8, 512, 2_000, 8
#: Half the width of the overlap at a split, in spreads of the projected difference of two vectors at the threshold.
OVERLAP = 0.5
#: A split that would put more than this share of a node on both sides is not made: such vectors lie closer than the
#: splits can tell apart, and are compared in blocks. Rows of a block of a large leaf, rows of it that are compared
#: together, leaves that are looked up together, rows that are routed together.
STUCK, BLOCK, ROWS, LEAVES, ROUTED_ROWS = 0.35, 2_048, 256, 1_024, 2_000
ROUTED = "num long, rep long, label {0}, copies long, vector binary, node long"


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), np.float64).reshape(len(vectors), -1)


def _directions(node: int, dimension: int, count: int) -> np.ndarray:
    """The random directions of the splits below a node, the same wherever they are needed."""
    d = np.random.default_rng([node & (2**63 - 1), dimension]).standard_normal((count, dimension))
    return d / np.linalg.norm(d, axis=1, keepdims=True)


def _margin(threshold: float, dimension: int) -> float:
    return OVERLAP * np.sqrt((2 - 2 * threshold) / dimension)


def _fit(threshold: float):
    """Cuts of the splits below a node, in heap order, NaN where a branch ends."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        node, total = int(frame["node"].iloc[0]), int(frame["total"].iloc[0])
        x = _matrix(frame.sort_values("num")["vector"])
        share = total / len(x)
        count = 2**LEVELS - 1
        cuts, at = np.full(count, np.nan), {0: np.arange(len(x))}
        directions, margin = _directions(node, x.shape[1], count), _margin(threshold, x.shape[1])
        for k in range(count):
            rows = at.pop(k, None)
            if rows is None or len(rows) * share <= LEAF or len(rows) < 8:
                continue
            p = x[rows] @ directions[k]
            cut = float(np.median(p))
            left, right = p <= cut + margin, p >= cut - margin
            if (left & right).mean() > STUCK:
                continue
            cuts[k] = cut
            if 2 * k + 2 < count:
                at[2 * k + 1], at[2 * k + 2] = rows[left], rows[right]
        return pd.DataFrame({"node": [node], "cuts": [cuts.tobytes()], "split": [bool(np.isfinite(cuts[0]))]})

    return run


def _route(threshold: float):
    """Each row into every leaf that it reaches; within the overlap of a split it goes both ways."""

    def run(frames):
        for frame in (f.iloc[k : k + ROUTED_ROWS] for f in frames for k in range(0, len(f), ROUTED_ROWS)):
            parts = []
            for node, rows in frame.groupby("node", sort=False):
                cuts = np.frombuffer(rows["cuts"].iloc[0], np.float64)
                x = _matrix(rows["vector"])
                margin, directions = _margin(threshold, x.shape[1]), _directions(int(node), x.shape[1], len(cuts))
                todo, found, leaves = [(0, np.arange(len(x)))], [], []
                while todo:
                    k, at = todo.pop()
                    if not len(at):
                        continue
                    if k >= len(cuts) or np.isnan(cuts[k]):
                        found.append(at)
                        leaves.append(np.full(len(at), np.random.default_rng([int(node) & (2**63 - 1), k + 1]).integers(1, 2**62)))
                        continue
                    p = x[at] @ directions[k]
                    todo += [(2 * k + 1, at[p <= cuts[k] + margin]), (2 * k + 2, at[p >= cuts[k] - margin])]
                # Rows are copied once for all leaves of the node.
                out = rows.iloc[np.concatenate(found)][["num", "rep", "label", "copies", "vector"]].copy()
                out["node"] = np.concatenate(leaves)
                parts.append(out)
            if parts:
                yield pd.concat(parts)

    return run


def _smallest(linked: np.ndarray, names: np.ndarray) -> np.ndarray:
    """For each row the smallest name that links reach from it; each row of the table is looked at once."""
    out, open_ = names.copy(), linked.any(axis=1)
    for start in np.argsort(names, kind="stable").tolist():
        if not open_[start]:
            continue
        front = np.array([start])
        while len(front):
            open_[front] = False
            out[front] = names[start]
            front = np.flatnonzero(linked[front].any(axis=0) & open_)
    return out


def _marks(frame: pd.DataFrame, node: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) for all leaves before ``node`` that the rows are in."""
    sizes = np.array([len(x) for x in frame["leaves"]])
    leaf = np.concatenate([np.asarray(x, np.int64) for x in frame["leaves"]])
    row = np.repeat(np.arange(len(frame)), sizes)
    return row[leaf < node], leaf[leaf < node]


def _compare(threshold: float):
    """Links of two blocks of a leaf: for each member the new linked rows, and the smallest member of its group there.

    A pair counts in the first leaf, by number, that both members are in. Pairs are cells of a table, links as well as
    earlier meetings (a product of the rows' marks for earlier leaves), so no list of pairs is made and a dense group
    costs no more than a sparse one.
    """

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        node = int(frame["node"].iloc[0])
        low, high = int(frame["low"].iloc[0]), int(frame["high"].iloc[0])
        frame = frame.sort_values("num", ignore_index=True)
        block = frame["block"].to_numpy()
        left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
        if not len(left) or not len(right):
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("num", "rep", "links", "peer")})
        x, copies, rep = _matrix(frame["vector"]), frame["copies"].to_numpy(), frame["rep"].to_numpy()
        row, leaf = _marks(frame, node)
        # A leaf says something about a pair only if two rows are in it.
        names, place, size = np.unique(leaf, return_inverse=True, return_counts=True)
        shared = np.flatnonzero(size > 1)
        number = np.full(len(names), -1)
        number[shared] = np.arange(len(shared))
        row, place = row[number[place] >= 0], number[place][number[place] >= 0]
        linked = np.zeros((len(frame), len(frame)), bool)
        links = np.zeros(len(frame), np.int64)
        for start in range(0, len(left), ROWS):
            some = left[start : start + ROWS]
            near = x[some] @ x[right].T >= threshold
            near &= some[:, None] != right[None, :]
            if not near.any():
                continue
            linked[np.ix_(some, right)] = near
            for k in range(0, len(shared), LEAVES):
                here = (place >= k) & (place < k + LEAVES)
                marks = np.zeros((len(frame), min(LEAVES, len(shared) - k)), np.float32)
                marks[row[here], place[here] - k] = 1
                near &= marks[some] @ marks[right].T == 0
            links[some] += near @ copies[right]
            if low != high:
                links[right] += near.T @ copies[some]
        linked |= linked.T
        out = pd.DataFrame({"num": frame["num"], "rep": rep, "links": links, "peer": _smallest(linked, rep)})
        return out[(out["links"] > 0) | (out["peer"] != out["rep"])]

    return run


def near_vectors(vectors: DataFrame, threshold: float = 0.93) -> DataFrame:
    """One row for each row of ``vectors`` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Vectors of equal, not NULL labels whose cosine, in double precision, is at least ``threshold`` are linked;
    n_links counts the other rows linked directly, component_id is the smallest vec_id reachable, and kept marks it.
    Equal vectors are folded first. The others go down TREES trees for each label: at a node, vectors are cut at the
    median of a random projection, and those near the cut go both ways. Nodes with more than LEAF vectors are split,
    round after round, by cuts fitted on at most FITTED of their vectors, until none can be split; a leaf that stays
    large, as its vectors lie too close, is compared in blocks. Vectors are compared within leaves, all with all.

    A task returns counts and, for each member of a linked group, the smallest member there, never its pairs. Links
    can be missed only if all trees part a pair. Vectors that are NULL, zero, or hold a NULL or non-finite component,
    and those with a NULL label or vec_id, link with nothing and are kept. Vectors of different length never link.
    Repeated rows are linked like any others, and so are different vectors of one vec_id, which each have their own
    count; a tie with the threshold links; other columns are ignored; an empty table gives no row.
    """
    spark, kind = vectors.sparkSession, vectors.schema["label"].dataType.simpleString()
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label")
    # Components are scaled by the largest one first, so that squares neither overflow nor vanish.
    rows = rows.withColumn("top", F.nullif(F.array_max(F.transform("embedding", lambda x: F.abs(x))), F.lit(0.0)))
    rows = rows.withColumn("norm", F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + (x / F.col("top")) * (x / F.col("top")))))
    finite = F.col("norm").isNotNull() & (F.col("top") < F.lit(float("inf")))
    sound = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False))
    rows = rows.withColumn("ok", sound).withColumn("a", F.xxhash64("embedding")).withColumn("b", F.xxhash64(F.lit(1), "embedding"))
    same = ["label", "a", "b"]
    good = rows.where("ok")
    folded = good.groupBy(*same).agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"), F.first("norm").alias("norm"), F.first("top").alias("top"))
    unit = F.transform("embedding", lambda x: x / F.col("top") / F.col("norm"))
    # Numbers tell folded rows apart: one vec_id may have several vectors.
    folded = folded.select(F.monotonically_increasing_id().alias("num"), *same, "rep", "copies", unit.alias("unit"))
    folded = materialise(folded, "folded")

    schema = ROUTED.format(kind)
    packed = folded.select("num", "rep", "label", "copies", "unit").mapInPandas(_pack, f"num long, rep long, label {kind}, copies long, vector binary, size long")
    trees = F.explode(F.sequence(F.lit(1), F.lit(TREES)))
    open_ = packed.withColumn("tree", trees).withColumn("node", F.xxhash64("label", "size", "tree").bitwiseAND(F.lit(2**62 - 1)))
    open_ = materialise(open_.drop("tree", "size"), "forest")
    leaves = None
    while True:
        sizes = materialise(open_.groupBy("node").agg(F.count("*").alias("total")).where(F.col("total") > LEAF), "large")
        # Every large node, in equal parts of its rows by hash, so that no node is gathered whole.
        taken = open_.join(sizes, "node").where(F.pmod(F.xxhash64("num", "node"), F.lit(1_000_000)) < F.lit(1_000_000.0 * FITTED) / F.col("total"))
        cuts = taken.groupBy("node").applyInPandas(_fit(threshold), "node long, cuts binary, split boolean").where("split").drop("split")
        cuts = materialise(cuts, "cuts")
        done = open_.join(cuts, "node", "left_anti").select("num", "rep", "label", "copies", "vector", "node")
        leaves = done if leaves is None else leaves.unionByName(done)
        if cuts.isEmpty():
            break
        open_ = materialise(open_.join(cuts, "node").mapInPandas(_route(threshold), schema), "forest")
    held = leaves.groupBy("num").agg(F.sort_array(F.collect_set("node")).alias("leaves"))
    blocks = leaves.groupBy("node").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = leaves.join(blocks, "node").withColumn("block", F.pmod(F.xxhash64("num"), F.col("blocks")).cast("int")).join(held, "num")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    row = ["num", "rep", "copies", "vector", "node", "leaves", "block"]
    dealt = dealt.select(*row, other).select(*row, F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    found = dealt.groupBy("node", "low", "high").applyInPandas(_compare(threshold), "num long, rep long, links long, peer long")
    found = materialise(found, "found")
    linked = found.groupBy("num").agg(F.sum("links").alias("links"))
    groups = components(found.where("peer <> rep").select(F.col("rep").alias("a"), F.col("peer").alias("b"))).withColumnRenamed("node", "rep")
    result = folded.select(*same, "num", "rep", "copies").join(linked, "num", "left").join(groups, "rep", "left")
    result = result.select(*same, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    out = rows.select("vec_id", "ok", *same).join(result, same, "left")
    component = F.when(F.col("ok"), F.coalesce("component", "vec_id")).otherwise(F.col("vec_id"))
    n = F.when(F.col("ok"), F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("long")
    return out.select("vec_id", n.alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))


def _pack(frames):
    for frame in frames:
        units = [np.asarray(u, np.float64) for u in frame["unit"]]
        out = frame[["num", "rep", "label", "copies"]].copy()
        out["vector"], out["size"] = [u.tobytes() for u in units], [len(u) for u in units]
        yield out
