"""Near duplicates of texts by MinHash with tensored banding."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import frugal, materialise, mix64, text_bytes, word_hashes, worker_cache
from ledgerline.llm.graph import components

#: Two collections of SIDE sub-keys, each of ROWS minhashes: SIDE * SIDE tables from 2 * SIDE * ROWS minhashes.
#: A pair at similarity 0.8 meets in no table with probability 2 * (1 - 0.8 ** ROWS) ** SIDE = 0.0006.
SIDE, ROWS = 8, 2
MINHASHES = 2 * SIDE * ROWS
#: Cells of a sketch that estimates similarity, and how many standard deviations below the limit a pair may lie there
#: and still be compared in full. Members of a block of a table's members.
CELLS, SLACK, BLOCK = 512, 4.0, 512
FACTORS = np.random.default_rng(7).integers(1, 2**63, MINHASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MULTIPLIERS = np.random.default_rng(11).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles; of the whole text if it has fewer words."""
    words = word_hashes(text)
    if len(words) == 0:
        return words
    n = max(1, len(words) - width + 1)
    size = min(width, len(words))
    total = np.full(n, size, np.uint64)
    for i in range(size):
        total = mix64(total + words[i : i + n] * MULTIPLIERS[i])
    return np.unique(total)


def sub_keys(found: np.ndarray) -> np.ndarray:
    """SIDE keys of either collection, each of ROWS minhashes."""
    least = np.full(MINHASHES, 2**64 - 1, np.uint64)
    for i in range(0, len(found), 2048):
        least = np.minimum(least, mix64(found[i : i + 2048, None] * FACTORS).min(axis=0))
    total = np.zeros(2 * SIDE, np.uint64)
    for r in range(ROWS):
        total = mix64(total + least[r::ROWS] * MULTIPLIERS[r])
    return (total >> np.uint64(32)).astype(np.uint32)


def sketch_cells(found: np.ndarray) -> np.ndarray:
    """One byte of the least hash in each of CELLS equal ranges of hashes; 0 where there is none."""
    cell = (found >> np.uint64(64 - CELLS.bit_length() + 1)).astype(np.int64)
    first = np.flatnonzero(np.diff(cell, prepend=-1))
    out = np.zeros(CELLS, np.uint8)
    out[cell[first]] = 1 + (mix64(found[first]) >> np.uint64(40)) % np.uint64(255)
    return out


def near_cells(x: np.ndarray, y: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Whether sketches, row by row, may belong to sets of at least this similarity; ``sizes`` are of both sets together.

    A filled cell is a draw from the union without replacement, so the spread shrinks as cells cover the union.
    """
    filled = ((x | y) != 0).sum(axis=1)
    same = ((x == y) & (x != 0)).sum(axis=1)
    limit = percent / 100
    left = np.clip(1 - filled * (1 + limit) / sizes, 0.05, 1)
    return same >= limit * filled - SLACK * np.sqrt(limit * (1 - limit) * filled * left) - 1


def _sketch(width: int):
    def run(batches):
        worker_cache(None, None)
        for batch in batches:
            sizes, a, b, keys, cells = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                s = shingles(text, width)
                sizes.append(len(s))
                a.append(int(np.bitwise_xor.reduce(s).view(np.int64)) if len(s) else 0)
                b.append(int(mix64(s * FACTORS[0]).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0)
                keys.append(sub_keys(s).tobytes() if len(s) else b"")
                cells.append(sketch_cells(s).tobytes() if len(s) else b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(keys, pa.binary()), pa.array(cells, pa.binary())],
                names=["doc_id", "n_shingles", "set_a", "set_b", "sub_keys", "cells"],
            )

    return run


def _tables(batches):
    """One row for each table that a document stands in: the key combines a sub-key of either collection."""
    place = np.arange(SIDE * SIDE, dtype=np.uint64)
    for batch in batches:
        n = batch.num_rows
        sub = np.frombuffer(b"".join(batch.column("sub_keys").to_pylist()), np.uint32).reshape(n, 2, SIDE).astype(np.uint64)
        keys = mix64((sub[:, 0, :, None] * MULTIPLIERS[60] + sub[:, 1, None, :] * MULTIPLIERS[61]).reshape(n, -1) + place * MULTIPLIERS[62])
        nodes, places = np.repeat(np.asarray(batch.column("rep")), SIDE * SIDE), np.tile(place.astype(np.int32), n)
        for i in range(0, nodes.size, 100_000):
            cut = slice(i, i + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()[cut].view(np.int64)), pa.array(places[cut]), pa.array(nodes[cut])], names=["key", "place", "rep"])


def _alike(percent: int):
    def run(batches):
        for batch in batches:
            n = batch.num_rows
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(n, CELLS) for c in ("x", "y"))
            yield batch.select(["a", "b"]).filter(pa.array(near_cells(x, y, np.asarray(batch.column("sizes")), percent), pa.bool_()))

    return run


def _pairs(rows: pa.Table, bounds: np.ndarray, percent: int):
    """Pairs of members, for each run of rows between ``bounds``, that may be similar and are not connected yet.

    A pair that meets in several tables is looked at in the first of them only.
    """
    get = {c: np.asarray(rows.column(c)) for c in ("rep", "component", "n_shingles", "block", "low", "high", "place")}
    sub = np.frombuffer(b"".join(rows.column("sub_keys").to_pylist()), np.uint32).reshape(-1, 2, SIDE)
    cells = np.frombuffer(b"".join(rows.column("cells").to_pylist()), np.uint8).reshape(-1, CELLS)
    rep, component, size = get["rep"], get["component"], get["n_shingles"]
    for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        low, high, place = (int(get[c][start]) for c in ("low", "high", "place"))
        x, y = (start + np.flatnonzero(get["block"][start:end] == k) for k in (low, high))
        near = component[x][:, None] != component[y]
        if low == high:
            near &= rep[x][:, None] < rep[y]
        p, q = np.nonzero(near)
        p, q = x[p], y[q]
        keep = 100 * np.minimum(size[p], size[q]) >= percent * np.maximum(size[p], size[q])
        p, q = p[keep], q[keep]
        for side, before in enumerate(divmod(place, SIDE)):
            new = ~(sub[p, side, :before] == sub[q, side, :before]).any(axis=1)
            p, q = p[new], q[new]
        for i in range(0, len(p), 10_000):
            a, b = p[i : i + 10_000], q[i : i + 10_000]
            a, b = (k[near_cells(cells[a], cells[b], size[a] + size[b], percent)] for k in (a, b))
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(rep[a], rep[b])), pa.array(np.maximum(rep[a], rep[b]))], names=["a", "b"])


def _apart(percent: int):
    """``_pairs`` over a partition that is sorted by (key, low, high); a run may go on in the next batch."""

    def run(batches):
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([held, rows]) if held is not None else rows
            key = [np.asarray(rows.column(c)) for c in ("key", "low", "high")]
            first = np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([k[1:] != k[:-1] for k in key])]))
            yield from _pairs(rows.slice(0, int(first[-1])), first, percent)
            held = rows.slice(int(first[-1]))
        if held is not None and held.num_rows:
            yield from _pairs(held, np.array([0, held.num_rows]), percent)

    return run


def _sets(width: int):
    def run(batches):
        for batch in batches:
            found = [shingles(t, width).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.binary())], names=["doc_id", "found"])

    return run


def _verify(percent: int):
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _links(near: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Those pairs (a, b) of representatives that are similar enough on their full sets."""
    needed = near.select(F.col("a").alias("doc_id")).union(near.select(F.col("b").alias("doc_id"))).distinct()
    sets = docs.join(needed, "doc_id", "left_semi").mapInArrow(frugal(_sets(width)), "doc_id long, found binary")
    sets = materialise(sets, "sets")
    full = near.join(sets.select(F.col("doc_id").alias("a"), F.col("found").alias("x")), "a")
    full = full.join(sets.select(F.col("doc_id").alias("b"), F.col("found").alias("y")), "b")
    return materialise(full.mapInArrow(frugal(_verify(percent)), "a long, b long").distinct(), "links")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Texts whose shingle sets have 100 * intersection >= percent * union are linked, after comparing the full sets;
    component_id is the smallest doc_id reachable, and kept marks it. Candidates come from tables whose keys pair two
    sub-keys of a smaller collection of minhashes. Equal sets are folded first. In each table all members are first
    compared with one of them, the one that meets most others over all tables: the common origin of copies, if there
    is one. Where a table's members are then not all connected, those in different components are compared with each
    other, block by block and by sketch; only pairs that may be similar leave the task, and are compared in full. So
    no pair that shares a table is skipped unless it is connected already.

    NULL or blank texts have no shingle, stand alone and are kept. Repeated rows give repeated results; rows of one
    doc_id count as one document in links. A NULL doc_id stands alone. Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
    sketch = docs.mapInArrow(frugal(_sketch(width)), "doc_id long, n_shingles long, set_a long, set_b long, sub_keys binary, cells binary")
    sketch = materialise(sketch, "sketch")
    same = ["set_a", "set_b", "n_shingles"]
    reps = sketch.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*same)
    reps = materialise(reps.agg(F.min("doc_id").alias("rep"), F.first("sub_keys").alias("sub_keys"), F.first("cells").alias("cells")), "reps")
    rows = reps.select("rep", "sub_keys").mapInArrow(frugal(_tables), "key long, place int, rep long")
    met = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    rows = materialise(rows.join(met, "key"), "tables")

    degree = rows.groupBy("rep").agg(F.sum("n").alias("degree"))
    center = rows.join(degree, "rep").groupBy("key").agg(F.min(F.struct((-F.col("degree")).alias("d"), "rep")).alias("first"))
    pairs = rows.join(center.select("key", F.col("first.rep").alias("a")), "key").where("rep <> a")
    pairs = pairs.select(F.least("a", "rep").alias("a"), F.greatest("a", "rep").alias("b")).distinct()
    size = "100 * least(n, m) >= {} * greatest(n, m)".format(percent)
    a = reps.select(F.col("rep").alias("a"), F.col("cells").alias("x"), F.col("n_shingles").alias("n"))
    b = reps.select(F.col("rep").alias("b"), F.col("cells").alias("y"), F.col("n_shingles").alias("m"))
    near = pairs.join(a, "a").join(b, "b").where(size).select("a", "b", "x", "y", (F.col("n") + F.col("m")).alias("sizes")).mapInArrow(frugal(_alike(percent)), "a long, b long")
    near = materialise(near, "near")
    first = _links(near, docs, width, percent)
    known = components(first).withColumnRenamed("node", "rep")

    named = rows.join(known, "rep", "left").select("key", "place", "rep", F.coalesce("component", "rep").alias("component"))
    mixed = named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n")).where("low <> high")
    mixed = mixed.select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    named = named.join(mixed, "key").join(reps.select("rep", "n_shingles", "sub_keys", "cells"), "rep")
    named = named.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    named = named.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    named = named.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")).drop("other", "blocks")
    sorted_ = named.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    apart = materialise(sorted_.mapInArrow(frugal(_apart(percent)), "a long, b long"), "apart").join(near, ["a", "b"], "left_anti")
    apart = materialise(apart, "near")
    second = _links(apart, docs, width, percent)

    groups = components(first.union(second)).withColumnRenamed("node", "rep")
    groups = reps.select("rep", *same).join(groups, "rep", "left").select(*same, F.coalesce("component", "rep").alias("component"))
    out = sketch.select("doc_id", *same).join(groups, same, "left")
    component = F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.coalesce("component", "doc_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
