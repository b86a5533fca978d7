"""Hard negatives, periodic runs and the quality classifier against brute force, held-out rows and odd input."""

import hashlib
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from ledgerline.llm import common, hard_negatives as hn, periodic, quality_model as qm
from conftest import DATA
from test_text_operators import SCHEMA, odd_rows, remainder, words_of

LONG = 2**63 - 1


# Periodic runs


def brute_runs(words, min_length, powers):
    found = {}
    for q in range(1, len(words)):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(min_length, powers * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("min_length,powers", [(6, 4), (1, 2), (5, 2), (8, 3)])
def test_runs_of_small_alphabets(min_length, powers):
    rng = np.random.default_rng(min_length * 10 + powers)
    for t in range(300):
        w = rng.integers(0, 1 + t % 4, rng.integers(0, 50))
        if t % 2:
            w = np.concatenate([w, np.tile(w[: rng.integers(0, 6)], rng.integers(0, 9)), w[:7]])
        assert [tuple(r) for r in periodic.find_runs(w.astype(np.int64), min_length, powers).tolist()] == brute_runs(w.tolist(), min_length, powers)


def test_runs_do_not_cross_texts(spark):
    rows = [(1, "a a a"), (2, "a a a"), (3, "a b " * 3), (4, "a b " * 4 + "c"), (5, "x " + "q " * 40)]
    got = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in periodic.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()}
    assert got == {1: [], 2: [], 3: [], 4: [(0, 8, 2)], 5: [(1, 40, 1)]}


def sha(lines):
    return hashlib.sha256(lines.encode()).hexdigest()


@pytest.mark.parametrize("kind", ["odd", "given", "none"])
def test_run_digest(spark, kind):
    docs = spark.createDataFrame(odd_rows() if kind == "odd" else [], SCHEMA) if kind != "given" else common.table(spark, DATA, "documents")
    got = [tuple(r) for r in periodic.digest(periodic.periodic_runs(periodic.planted(docs))).collect()]
    want = []
    for r in docs.select("doc_id", "text").collect():
        w, h = words_of(r["text"]), remainder(r["doc_id"], 2**32)
        if h % 10 == 0 and w:
            a, n = h // 10 % len(w), len(w)
            p = 1 + (n - a) // (3 + h // 10 % 8)
            w = [w[i if i < a else a + (i - a) % p] for i in range(n)]
        # Brute force takes all periods; the long odd texts hold none beyond a few words.
        runs = brute_runs(w, 6, 4) if len(w) < 5_000 else [r for r in brute_runs_near(w)]
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        want.append((r["doc_id"], len(runs), *top, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(kept)))
    assert Counter(got) == Counter(want)


def brute_runs_near(words):
    found = {}
    for q in range(1, 40):
        same = np.array([a == b for a, b in zip(words, words[q:])])
        edge = np.flatnonzero(np.diff(np.concatenate([[0], same.astype(np.int8), [0]])))
        for i, j in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


# Hard negatives


def brute_negatives(rows, positives=5, negatives=5):
    ok = []
    for i, (v, e, lab) in enumerate(rows):
        if v is not None and lab is not None and e is not None and None not in e and np.isfinite(np.array(e, float)).all():
            with np.errstate(over="ignore"):
                x = np.clip(np.floor(256.0 * np.array(e, float)), -1.7976931348623157e308, 1.7976931348623157e308)
            ok.append((i, v, lab, [int(c) for c in x]))
    out = Counter()
    for i, v, lab, x in ok:
        if v % 100:
            continue
        score = lambda y: max(-LONG - 1, min(LONG, sum(a * b for a, b in zip(x, y))))
        met = [(score(y), w, other) for j, w, other, y in ok if j != i and len(y) == len(x)]
        same = sorted(((s, w) for s, w, other in met if other == lab), key=lambda r: (-r[0], r[1]))[:positives]
        for ps, p in same:
            found = sorted(((s, w) for s, w, other in met if other != lab and 80 * ps <= 100 * s <= 100 * ps), key=lambda r: (-r[0], r[1]))
            out.update((v, p, k + 1, w, ps, s) for k, (s, w) in enumerate(found[:negatives]))
    return out


def mined(frame):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in frame.select("vec_id", "embedding", "label").collect()]
    got = Counter(tuple(r) for r in hn.hard_negatives(frame).collect())
    assert got == brute_negatives(rows)
    return got


def test_mined_given(spark):
    assert mined(common.table(spark, DATA, "embeddings"))


def test_mined_in_blocks_and_lots(spark, monkeypatch):
    """Small blocks and lots, lengths far apart, clusters so that ranges prune, ties and repeated rows."""
    for name, value in (("BLOCK_BYTES", 2_000), ("LOT_BYTES", 1_500), ("TOGETHER", 2)):
        monkeypatch.setattr(hn, name, value)
    rng = np.random.default_rng(5)
    centers = rng.standard_normal((12, 6))
    x = centers[rng.integers(0, 12, 500)] + 0.05 * rng.standard_normal((500, 6))
    x *= np.exp(rng.normal(0, 0.4, 500))[:, None]
    rows = [(20 * i, v.tolist(), int(rng.integers(0, 3)), "x") for i, v in enumerate(x)]
    rows += rows[:40] + [(200, rows[3][1], 1, "y"), (7, [0.0] * 6, 0, "z"), (9, [0.0] * 6, 1, "z"), (300, [0.0] * 6, 1, "z")]
    assert len(mined(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, anchor string"))) > 100


def test_ranges_lose_no_row():
    """Every row that reaches an anchor's least score is among its candidates, and ranges do leave rows out."""
    rng = np.random.default_rng(8)
    x = rng.standard_normal((40, 8))[rng.integers(0, 40, 2_000)] + 0.1 * rng.standard_normal((2_000, 8))
    x = np.floor(256 * x / np.linalg.norm(x, axis=1, keepdims=True) * rng.uniform(1, 1.1, (2_000, 1)))
    block, anchors = hn.Block(np.arange(2_000), np.arange(2_000), x), x[::50]
    table, left_out = anchors @ x.T, 0
    for place in (3, 30, 300):
        least = np.sort(table, axis=1)[:, -place]
        for group, rows in hn.candidates(block, anchors, hn.lengths_of(anchors), least):
            for a in group:
                need = set(np.flatnonzero(table[a] >= least[a]).tolist())
                assert rows is None or need <= set(rows.tolist())
                left_out += 0 if rows is None else len(x) - len(rows)
    assert left_out > 10_000


def test_mined_odd(spark):
    nan, inf, big = float("nan"), float("inf"), 1e300
    rows = [(0, [1.0, 0.5], 1, 2), (100, [1.0, 0.5], 1, 2), (1, [1.0, 0.25], 2, 2), (2, [0.9, 0.5], 2, 2), (3, [1.0, 0.4], 1, 2), (None, [1.0, 0.5], 1, 2), (200, None, 1, 2), (300, [1.0, 0.5], None, 2)]
    rows += [(400, [nan, 1.0], 1, 2), (500, [inf, 1.0], 2, 2), (600, [None, 1.0], 1, 2), (700, [], 1, 2), (701, [], 1, 2), (702, [], 2, 2), (800, [1.0, 0.5, 2.0], 1, 2), (0, [1.0, 0.5], 1, 2)]
    rows += [(900, [big, big], 3, 1), (901, [big, -big], 3, 1), (902, [big, 1.0], 3, 1), (903, [1.0, 1.0], 4, 1), (904, [big, 1.0], 4, 1), (905, [1e6, 1e6], 3, 1), (906, [-1.0, 0.0], 3, 1), (1000, [3e7, 3e7], 3, 1), (907, [1.5e308, 0.0], 4, 1)]
    assert mined(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, rank int"))
    assert hn.hard_negatives(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


# Quality classifier


def test_cells_of_words():
    cells, sizes = qm.word_cells(["abc", "a", "abc", "ß" * 70])
    assert sizes.tolist() == [3 + 2 + 1 + 1, 1 + 1, 7, 70 + 69 + 68 + 1]
    assert cells[:7].tolist() == cells[9:16].tolist() and ((0 <= cells) & (cells < qm.CELLS)).all()
    assert not len(qm.word_cells([])[0]) and not len(qm.word_cells([])[1])
    assert qm.tokens("a a  b\tb b c") == [b"a", b"a", b"b", b"b", b"b", b"c", qm.AGAIN, qm.AGAIN, qm.AGAIN]


def test_held_out_quality(spark):
    root = "/root/testdata/sf0.01"
    docs, labels = common.table(spark, root, "documents"), common.table(spark, root, "labels")
    rows = qm.quality_scores(docs, labels).join(labels, "doc_id").collect()
    assert qm.quality_scores(docs, labels).count() == docs.count()
    for r in rows:
        assert r["held_out"] == (remainder(r["doc_id"], 5) == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    good, bad = ([r["score"] for r in rows if r["held_out"] and r["quality"] == q] for q in (1, 0))
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.93 and np.mean([s >= 0.3 for s in good]) > 0.97


def test_scores_follow_the_model(spark):
    """A score is the softmax of the mean of a text's own vectors, and no label, id or other column moves it."""
    texts = {i: t for i, t in enumerate(["the of and", "the the the", "", "of " * 500, "the of and"])}
    docs = spark.createDataFrame([(i, t, "en", 1) for i, t in texts.items()], "doc_id long, text string, label string, score int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(4)], "doc_id long, quality int")
    got = {r["doc_id"]: r["score"] for r in qm.quality_scores(docs, labels, modulus=7, out=6).collect()}
    again = {r["doc_id"]: r["score"] for r in qm.quality_scores(docs.repartition(3), labels, modulus=7, out=6).collect()}
    assert got == pytest.approx(again) and got[0] == pytest.approx(got[4])


@pytest.mark.parametrize("kind", ["odd", "none"])
def test_odd_quality(spark, kind):
    docs = spark.createDataFrame(odd_rows() if kind == "odd" else [], SCHEMA)
    many = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, None, 0), (None, 1, 0), (4, 0, 0), (5, 0, 0), (7, 1, 0)], "doc_id long, quality int, text int")
    for labels in (many, many.where("quality = 1"), many.limit(0)):
        rows = qm.quality_scores(docs, labels).collect()
        assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in docs.collect())
        assert all(0 <= r["score"] <= 1 for r in rows)
        blank = {r["score"] for r in rows if r["doc_id"] in (3, 4, 5)}
        assert len(blank) <= 1
