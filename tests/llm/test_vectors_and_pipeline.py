"""Vectors against brute force, and the pipeline stage by stage."""

from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from ledgerline.llm import common, near_vectors
from conftest import DATA
from test_text_operators import SCHEMA, brute_components, odd_rows


def brute(rows, threshold):
    ok = [(i, v, np.array(e, float), lab) for i, (v, e, lab) in enumerate(rows) if v is not None and lab is not None and e and None not in e and np.isfinite(e).all() and np.any(e)]
    links, parent = Counter(), {v: v for v, _, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, v, x, a) in enumerate(ok):
        for j, w, y, b in ok[n + 1 :]:
            x1, y1 = x / np.abs(x).max(), y / np.abs(y).max()
            if a == b and len(x) == len(y) and x1 @ y1 / np.sqrt(x1 @ x1) / np.sqrt(y1 @ y1) >= threshold:
                links[i] += 1
                links[j] += 1
                p, q = root(v), root(w)
                parent[max(p, q)] = min(p, q)
    return Counter((v, links[i], root(v), root(v) == v if v is not None else True) for i, (v, _, _) in enumerate(rows))


def check(frame, threshold=0.93):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in frame.select("vec_id", "embedding", "label").collect()]
    got = Counter((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in near_vectors.near_vectors(frame, threshold).collect())
    assert got == brute(rows, threshold)


def test_given_vectors(spark):
    check(common.table(spark, DATA, "embeddings"))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1, 5), (2, [2.0, 0.0], 1, 5), (3, [1.0, 0.0], 2, 5), (4, [1.0, 0.0], None, 5), (5, None, 1, 5), (6, [0.0, 0.0], 1, 5), (7, [nan, 1.0], 1, 5)]
    rows += [(8, [inf, 1.0], 1, 5), (9, [None, 1.0], 1, 5), (10, [], 1, 5), (11, [1.0, 0.1], 1, 5), (12, [1.0, 0.0, 0.0], 1, 5), (2, [2.0, 0.0], 1, 5), (None, [1.0, 0.0], 1, 5), (13, [-0.0, 1.0], 1, 5), (14, [0.0, 1.0], 1, 5)]
    check(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, rep int"))
    assert near_vectors.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_forest_splits_and_blocks(spark, monkeypatch):
    """Small leaves, several rounds, and a dense group that no split can part."""
    for name, value in (("LEAF", 40), ("LEVELS", 2), ("BLOCK", 16), ("FITTED", 100), ("TREES", 12)):
        monkeypatch.setattr(near_vectors, name, value)
    rng = np.random.default_rng(6)
    centers = rng.standard_normal((40, 16))
    x = np.repeat(centers, 8, axis=0) + 0.08 * rng.standard_normal((320, 16))
    dense = rng.standard_normal(16) + 0.002 * rng.standard_normal((120, 16))
    rows = [(i, v.tolist(), 1) for i, v in enumerate(np.concatenate([x, dense]))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r for r in near_vectors.near_vectors(frame).collect()}
    want = {v: (n, c) for v, n, c, _ in brute(rows, 0.93)}
    found, total = sum(r["n_links"] for r in got.values()), sum(n for n, _ in want.values())
    assert 0.97 * total <= found <= total
    assert np.mean([got[v]["component_id"] == c for v, (_, c) in want.items()]) > 0.97
    assert all(got[v]["n_links"] <= n for v, (n, _) in want.items())


def test_recall_of_the_production_forest(spark):
    """One label far above the size of a leaf: a dense group near the threshold, lone pairs near it, single vectors."""
    rng, d = np.random.default_rng(3), 64

    def around(center, n, cosine):
        return center / np.linalg.norm(center) + np.sqrt((1 / cosine - 1) / d) * rng.standard_normal((n, d))

    alone = rng.standard_normal((600, d))
    x = np.concatenate([around(rng.standard_normal(d), 900, 0.935), *(around(c, 2, 0.936) for c in alone[:300]), alone])
    frame = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r["n_links"] for r in near_vectors.near_vectors(frame).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.93).sum(axis=1) - 1
    assert all(got[i] <= n for i, n in enumerate(want)) and sum(got.values()) >= 0.99 * want.sum()
    assert sum(got[i] for i in range(900, 1500)) >= 0.99 * want[900:1500].sum()


def test_extreme_vectors_and_shared_ids(spark):
    """Squares that overflow or vanish, and one vec_id with different vectors."""
    rows = [(1, [1e300, 1e300], 1), (2, [1e-300, 1e-300], 1), (3, [1e300, 0.0], 1), (4, [1.0, 0.0], 1), (4, [1.0, 1.0], 1), (4, [0.0, 1.0], 1), (5, [0.0, 3.0], 1)]
    check(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), 0.99)


def rows_of(frame):
    return [r.asDict() for r in frame.collect()]


@pytest.mark.parametrize("kind", ["given", "odd", "none"])
def test_pipeline(spark, kind):
    docs = common.table(spark, DATA, "documents") if kind == "given" else spark.createDataFrame(odd_rows() if kind == "odd" else [], SCHEMA)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "line_dedup", "near_dedup", "source_mixing", "best_fit_packing"]
    held = [common.materialise(docs, "input")]
    for name, stage in corpus_pipeline.STAGES:
        held.append(common.materialise(stage(spark, held[-1], DATA), name))
    for frame in held[1:-1]:
        assert frame.columns == docs.columns and frame.schema.simpleString() == docs.schema.simpleString()
    start, known, cut, apart, mixed = map(rows_of, held[:-1])
    if kind == "none":
        assert held[-1].count() == 0
        return
    key = lambda r: repr((r["doc_id"], r["text"]))
    assert not Counter(map(key, known)) - Counter(map(key, start))
    if kind == "given":
        clean = [r for r in start if r["lang"] and len(r["text"].split()) >= 50]
        assert len({r["doc_id"] for r in clean} - {r["doc_id"] for r in known}) <= 0.02 * len(clean)
    assert {r["doc_id"] for r in cut} <= {r["doc_id"] for r in known}
    before = {r["doc_id"]: r["text"] for r in known}
    assert all(set((r["text"] or "").split("\n")) <= set((before[r["doc_id"]] or "").split("\n")) for r in cut)
    want, _ = brute_components([(r["doc_id"], r["text"]) for r in cut if r["doc_id"] is not None], 5, 80)
    ids = Counter(r["doc_id"] for r in apart if r["doc_id"] is not None)
    assert ids == Counter({d for d, c in want.items() if c == d})
    size = lambda r: len((r["text"] or "").encode().split())
    taken, whole = Counter(), Counter()
    for r in mixed:
        taken[r["doc_id"]] += size(r)
    for r in apart:
        whole[r["doc_id"]] += size(r)
    assert all(n <= 2 * whole[d] for d, n in taken.items())
    assert abs(sum(taken.values()) - 1.5 * sum(whole.values())) <= 60
    assert all(r["n_chars"] == len(r["text"]) for r in mixed)
    packed = held[-1].groupBy("sequence_id").agg({"length": "sum"}).collect()
    assert all(r[1] <= 2048 for r in packed)
    assert held[-1].where("piece = 0").count() == len(mixed)
