"""Operators against brute force on random rows, with hot keys, ties and NULLs."""

import datetime as dt
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.functions import calc
from ledgerline.operators import joins
from ledgerline.operators.baseline import rolling_baseline
from ledgerline.operators.layout import cluster_rewrite, zorder_rewrite
from ledgerline.operators.merge import apply_changes, change_feed, dedup_latest, insert_missing, upsert
from ledgerline.operators.ordered import exact_percentile, ordered_functions
from ledgerline.operators.quality import expect, run_checks, duplicates, failing
from ledgerline.operators import vector_index
from ledgerline.operators.similarity import topk_cosine
from ledgerline.operators.summaries import ERROR, DayStates

FEW = settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
T0 = dt.datetime(2024, 1, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))


def skewed(n, seed=1):
    """(key, value, id): one key holds half of the rows, some keys are NULL, values repeat."""
    r = random.Random(seed)
    return [(r.choice(["hot"] * 5 + ["a", "b", None, "c", "d"]), r.randrange(60), i) for i in range(n)]


@pytest.mark.parametrize("descending", [False, True])
def test_ordered_functions_equal_plain_windows(spark, descending):
    df = spark.createDataFrame(skewed(900) + [("hot", None, 2000), ("hot", None, 2001), ("n", None, 2002)], "k string, v int, id int")
    got = ordered_functions(df, ["k"], "v", ["id"], F.floor(F.col("v") / 7), descending=descending, running="id", neighbours="id")
    by = F.desc("v") if descending else F.asc("v")
    w, r = Window.partitionBy("k").orderBy(by, "id"), Window.partitionBy("k").orderBy(by)
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("k", "v", "id", F.row_number().over(w), F.rank().over(r), F.dense_rank().over(r),
                     F.sum("id").over(run), F.lag("id").over(w), F.lead("id").over(w))
    assert rows(got) == rows(want)


def test_running_total_of_nulls(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 5, None), ("a", 9, 4), ("a", 20, None)], "k string, v int, x int")
    got = ordered_functions(df, ["k"], "v", ["v"], F.floor(F.col("v") / 7), running="x").orderBy("v")
    assert [r.running_total for r in got.collect()] == [None, None, 4, 4]


def test_global_rank_without_keys(spark):
    df = spark.createDataFrame(skewed(200), "k string, v int, id int")
    got = ordered_functions(df, [], "v", ["id"], F.floor(F.col("v") / 9)).select("id", "rank_val")
    want = df.select("id", F.rank().over(Window.orderBy("v")))
    assert rows(got) == rows(want)


@pytest.mark.parametrize("share", [0.0, 0.25, 0.5, 0.95, 1.0])
def test_exact_percentile(spark, share):
    df = spark.createDataFrame(skewed(501), "k string, v int, id int")
    got = {r.k: r.p for r in exact_percentile(df, ["k"], "v", share, F.floor(F.col("v") / 5), "p").collect()}
    data = {}
    for k, v, _ in skewed(501):
        data.setdefault(k, []).append(v)
    assert set(got) == set(data)
    for k, vs in data.items():
        assert got[k] == pytest.approx(float(np.quantile(vs, share)))


period = st.tuples(st.sampled_from(["hot", "hot", "x"]), st.integers(0, 40), st.one_of(st.none(), st.integers(0, 40)), st.integers(1, 9))


@FEW
@given(st.lists(period, min_size=1, max_size=25))
def test_price_lookup_takes_latest_start_exactly_once(spark, periods):
    at = lambda h: T0 + dt.timedelta(hours=h)
    prices = spark.createDataFrame([(k, at(s), None if e is None else at(e), p) for k, s, e, p in periods],
                                   "sku string, s timestamp, e timestamp, price int")
    use = [(k, at(h), i) for i, (k, h) in enumerate((k, h) for k in ("hot", "x", "none", None) for h in (-1, 0, 7, 20, 39, 40, 41, 900))]
    usage = spark.createDataFrame(use + [("hot", None, 99)], "u string, t timestamp, id int")
    want = {}
    for k, t, i in use:
        cover = [(s, p) for kk, s, e, p in periods if kk == k and at(s) <= t and (e is None or t < at(e)) and (e is None or s < e)]
        want[i] = max(cover)[1] if cover else None
    want[99] = None
    for limit in (100_000, 0):  # broadcast, and the shuffled way
        out = joins.price_lookup(usage, prices, {"u": "sku"}, "t", "s", "e", ["price"], max_rows=limit)
        got = out.collect()
        assert len(got) == len(want)
        assert {r.id: r.price for r in got} == want


def test_price_boundary_belongs_to_the_new_period(spark):
    prices = spark.createDataFrame([("a", T0, T0 + dt.timedelta(1), 1), ("a", T0 + dt.timedelta(1), None, 2)], "sku string, s timestamp, e timestamp, price int")
    usage = spark.createDataFrame([("a", T0 + dt.timedelta(1))], "u string, t timestamp")
    assert [r.price for r in joins.price_lookup(usage, prices, {"u": "sku"}, "t", "s", "e", ["price"]).collect()] == [2]


def test_empty_price_list(spark):
    prices = spark.createDataFrame([], "sku string, s timestamp, e timestamp, price int")
    usage = spark.createDataFrame([("a", T0)], "u string, t timestamp")
    assert joins.price_lookup(usage, prices, {"u": "sku"}, "t", "s", "e", ["price"]).collect()[0].price is None


@pytest.mark.parametrize("bucket", [3600, 7 * 86400])
def test_asof_join(spark, bucket):
    r = random.Random(3)
    key = lambda: r.choice(["hot"] * 4 + ["a", "b", None])
    left = [(key(), T0 + dt.timedelta(minutes=r.randrange(3000)), i) for i in range(300)] + [("hot", None, 999)]
    right = [(key(), T0 + dt.timedelta(minutes=r.randrange(3000)), r.randrange(50)) for _ in range(120)]
    l = spark.createDataFrame(left, "k string, t timestamp, id int")
    f = spark.createDataFrame(right, "k string, ft timestamp, v int")
    got = {x.id: x.v for x in joins.asof_join(l, f, ["k"], "t", "ft", ["v"], bucket).collect()}
    assert len(got) == len(left)
    for k, t, i in left:
        cand = [(ft, v) for kk, ft, v in right if t is not None and k is not None and kk == k and ft <= t]
        assert got[i] == (max(cand)[1] if cand else None)


def test_lookup_latest(spark):
    l = spark.createDataFrame([("a",), ("z",)], "k string")
    f = spark.createDataFrame([("a", 1, 5), ("a", 2, 3), ("a", 2, 4)], "k string, t int, v int")
    assert rows(joins.lookup_latest(l, f, "k", ["t"], ["v"])) == [("a", 4), ("z", None)]


def test_rolling_baseline_equals_self_join(spark):
    r = random.Random(5)
    data = [(k, dt.date(2024, 1, 1) + dt.timedelta(days=d), r.randrange(1, 99)) for k in "ab" for d in range(60) if r.random() < 0.7]
    df = spark.createDataFrame(data, "k string, d date, v int")
    got = {(x.k, x.d): x.baseline_value for x in rolling_baseline(df, ["k"], "d", "v").collect()}
    for k, d, _ in data:
        past = [v for kk, dd, v in data if kk == k and 1 <= (d - dd).days <= 7]
        assert got[k, d] == (pytest.approx(sum(past) / len(past)) if past else None)


row = st.tuples(st.one_of(st.none(), st.integers(0, 8)), st.integers(0, 3), st.sampled_from(["p", "q"]))


def table(spark, data):
    unique = {k: (k, v, s) for k, v, s in data}
    return spark.createDataFrame(list(unique.values()), "k int, v int, s string")


@FEW
@given(st.lists(row, max_size=9), st.lists(row, max_size=9))
def test_upsert_and_change_feed(spark, a, b):
    old, src = table(spark, a), table(spark, b)
    new = upsert(old, src, ["k"]).drop("_action")
    want = {k: (k, v, s) for k, v, s in a} | {k: (k, v, s) for k, v, s in b}
    assert rows(new) == sorted(want.values(), key=lambda r: tuple((x is None, str(x)) for x in r))
    assert rows(upsert(new, src, ["k"]).drop("_action")) == rows(new)
    assert rows(apply_changes(old, change_feed(old, new, ["k"]), ["k"])) == rows(new)
    assert change_feed(new, new, ["k"]).count() == 0
    kept = {k: (k, v, s) for k, v, s in b} | {k: (k, v, s) for k, v, s in a}
    assert rows(insert_missing(old, src, ["k"]).drop("_action")) == sorted(kept.values(), key=lambda r: tuple((x is None, str(x)) for x in r))


def test_upsert_rejects_ambiguous_source(spark):
    t = spark.createDataFrame([(1, "a")], "k int, s string")
    s = spark.createDataFrame([(1, "b"), (1, "c")], "k int, s string")
    with pytest.raises(Exception, match="several rows for key"):
        upsert(t, s, ["k"]).collect()


def test_upsert_keeps_absent_and_adds_new_columns(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, old string")
    s = spark.createDataFrame([(2, 7), (3, 8)], "k int, fresh int")
    assert rows(upsert(t, s, ["k"]).drop("_action")) == [(1, "a", None), (2, "b", 7), (3, None, 8)]


def test_upsert_condition_that_is_null_keeps_the_row(spark):
    t = spark.createDataFrame([(1, None, "x")], "k int, status string, v string")
    s = spark.createDataFrame([(1, "y")], "k int, v string")
    out = upsert(t, s, ["k"], when_matched=lambda t, s: t("status") == "Active").collect()[0]
    assert (out.v, out._action) == ("x", "keep")


def test_change_feed_compares_maps(spark):
    a = spark.createDataFrame([(1, {"x": "1", "y": "2"}), (2, {"x": "1"})], "k int, m map<string,string>")
    b = spark.createDataFrame([(1, {"y": "2", "x": "1"}), (2, {"x": "2"})], "k int, m map<string,string>")
    assert {(r.k, r._change_type) for r in change_feed(a, b, ["k"]).collect()} == {(2, "update_preimage"), (2, "update_postimage")}


def test_dedup_latest_limits_before_the_shuffle(spark):
    df = spark.createDataFrame(skewed(500), "k string, v int, id int")
    out = dedup_latest(df, ["k"], [F.desc("v"), F.desc("id")])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert out.count() == 6


def brute(q, b, k):
    out = []
    for qi, qv in q:
        score = [(float(np.dot(qv, bv) / np.linalg.norm(qv) / np.linalg.norm(bv)), -bi) for bi, bv in b if np.linalg.norm(bv) > 0]
        out += [(qi, -nb, rank + 1) for rank, (_, nb) in enumerate(sorted(score, reverse=True)[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [2000, 3])
def test_topk_cosine_both_ways(spark, block):
    g = np.random.default_rng(0)
    b = [(i, [float(x) for x in g.normal(size=5)]) for i in range(200)] + [(900, [0.0] * 5), (901, [1.0, 0.0, 0.0, 0.0, 0.0]), (902, [2.0, 0.0, 0.0, 0.0, 0.0])]
    q = [(i, [float(x) for x in g.normal(size=5)]) for i in range(7)] + [(50, [3.0, 0.0, 0.0, 0.0, 0.0])]
    base = spark.createDataFrame(b, "vec_id long, embedding array<double>").repartition(5)
    ask = spark.createDataFrame(q, "qid long, embedding array<double>")
    got = topk_cosine(ask, base, 4, query_id="qid", base_id="vec_id", query_block=block)
    assert sorted((r.qid, r.vec_id, r.rank) for r in got.collect()) == brute(q, b, 4)


def clustered(seed, count, size=8):
    g = np.random.default_rng(seed)
    centre = g.normal(size=(12, size))
    return [(i, [float(x) for x in centre[i % 12] + 0.3 * g.normal(size=size)], i % 3) for i in range(count)]


@pytest.mark.parametrize("limits", [{}, {"PART_ROWS": 40, "QUERY_BLOCK": 4}])
def test_index_search_equals_all_pairs(spark, folder, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(vector_index, name, value)
    b = clustered(1, 900) + [(2_000 + j, [1.0] * 8, 0) for j in range(30)]  # equal vectors: ties by id
    odd = [(5_000, None, 0), (5_001, [0.0] * 8, 0), (5_002, [None] + [1.0] * 7, 0), (5_003, [float("nan")] * 8, 0)]
    base = spark.createDataFrame(b + odd, "vec_id long, embedding array<double>, label int").repartition(4)
    q = [(i, v) for i, v, _ in clustered(2, 40)] + [(99, [2.0] * 8)]
    ask = spark.createDataFrame(q + [(77, None), (78, [0.0] * 8)], "qid long, embedding array<double>")
    index = vector_index.build_index(base, folder, id="vec_id", keep=("label",))
    assert index.rows.count() == len(b)
    for probes in (1, 4):
        got = vector_index.search_index(index, ask, 7, query_id="qid", probes=probes).collect()
        scored = sorted((r.qid, r.rank, r.score) for r in got)
        assert len(got) == 7 * len(q)
        m = np.array([v for _, v, _ in b])
        for qid, v in q:
            all_ = np.round(m @ np.array(v) / np.linalg.norm(m, axis=1) / np.linalg.norm(v), 9)
            order = np.lexsort(([i for i, _, _ in b], -all_))[:7]
            mine = sorted((r.rank, r.vec_id) for r in got if r.qid == qid)
            assert [x for _, x in mine] == [b[o][0] for o in order]
        assert scored == sorted(scored)
    only = vector_index.search_index(index, ask, 7, query_id="qid", condition=F.col("label") == 2).collect()
    kept = {i for i, _, label in b if label == 2}
    assert len(only) == 7 * len(q) and {r.vec_id for r in only} <= kept


def test_index_skips_cells_and_takes_an_empty_base(spark, folder):
    base = spark.createDataFrame([(i, v, l) for i, v, l in clustered(1, 2_000)], "vec_id long, embedding array<double>, label int")
    index = vector_index.build_index(base, folder, id="vec_id")
    ask = base.where("vec_id % 100 = 0").select(F.col("vec_id").alias("qid"), "embedding")
    vector_index.search_index(index, ask, 3, query_id="qid").count()
    met = spark.read.parquet(f"{folder}/search-*/first", f"{folder}/search-*/second").count()
    assert met < 20 * len(index.centres) / 2
    none = vector_index.build_index(base.limit(0), f"{folder}/none", id="vec_id")
    assert vector_index.search_index(none, ask, 3, query_id="qid").collect() == []


def test_day_states_unite_and_follow_changes(spark, folder):
    g = np.random.default_rng(3)
    rows = [(f"2024-01-0{1 + j % 4}", "ab"[j % 2], int(g.integers(0, 500)), float(x)) for j, x in enumerate(g.lognormal(3, 2, 1_500))]
    rows += [("2024-01-01", "a", 1, x) for x in (0.0, -5.0, -0.001, 1e300, 1e-300, float("nan"), float("inf"), None)] + [(None, "a", 9, 1.0), ("2024-01-02", None, None, 3.0)]
    kind = "day string, k string, who int, x double"
    s = DayStates(spark, folder, "day", ("k",), "who", "x")

    def check(now, admitted):
        got = {(r.k, r.share): (r.value, r.n) for r in s.quantiles([F.col("k")], [0.0, 0.5, 0.95, 1.0], F.col("day").isin(admitted)).collect()}
        want = {}
        for k in {r[1] for r in now if r[0] in admitted}:
            x = sorted(r[3] for r in now if r[0] in admitted and r[1] == k and r[3] is not None and np.isfinite(r[3]))
            want |= {(k, p): (x[max(int(np.ceil(p * len(x))), 1) - 1], len(x)) for p in (0.0, 0.5, 0.95, 1.0)}
        assert got.keys() == want.keys()
        for key, (value, n) in want.items():
            assert got[key][1] == n and abs(got[key][0] - value) <= ERROR * 1.0001 * abs(value)
        seen = {r.k: r["values"] for r in s.distinct([F.col("k")], F.col("day").isin(admitted)).collect()}
        for k, n in seen.items():
            exact = len({r[2] for r in now if r[0] in admitted and r[1] == k and r[2] is not None})
            assert abs(n - exact) <= max(1, 0.025 * exact)

    days = sorted({r[0] for r in rows if r[0]})
    s.refresh(spark.createDataFrame(rows, kind))
    check(rows, days)
    check(rows, days[1:3])
    # One day grows, one loses all its rows.
    later = [r for r in rows if r[0] != "2024-01-03"] + [("2024-01-04", "b", 7_000 + j, 50.0) for j in range(300)]
    s.refresh(spark.createDataFrame(later, kind), spark.createDataFrame([("2024-01-03",), ("2024-01-04",), (None,)], "d string"))
    check(later, days)


def test_day_states_of_an_empty_fact(spark, folder):
    s = DayStates(spark, folder, "day", ("k",), "who", "x")
    none = spark.createDataFrame([("2024-01-01", "a", 1, 2.0)], "day string, k string, who int, x double")
    s.refresh(none)
    s.refresh(none.limit(0), none.select("day"))
    assert s.quantiles([F.col("k")], [0.5]).collect() == [] and s.distinct([F.col("k")]).collect() == []


def test_quality_rules(spark):
    df = spark.createDataFrame([(1, 5), (1, -1), (None, 0)], "id int, q int")
    log = {r.check_name: (r.total_records, r.failed_records, r.status) for r in
           run_checks(df, "t", {"neg": failing(F.col("q") < 0), "dup": duplicates("id"), "ok": failing(F.col("q") > 9)}).collect()}
    assert log == {"neg": (3, 1, "FAIL"), "dup": (3, 2, "FAIL"), "ok": (3, 0, "PASS")}
    assert run_checks(df.limit(0), "t", {"neg": failing(F.col("q") < 0)}).collect()[0].status == "WARN"
    kept, gone = expect(df, {"positive": F.col("q") > 0, "has_id": F.col("id").isNotNull()})
    assert kept.count() == 1
    assert {(r.id, tuple(r._missed)) for r in gone.collect()} == {(1, ("positive",)), (None, ("positive", "has_id"))}


def test_layout_keeps_all_rows_and_narrows_files(spark, folder):
    df = spark.range(20_000).select(F.pmod(F.xxhash64("id"), F.lit(1000)).alias("a"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).alias("b"))
    for name, out in {"range": cluster_rewrite(df, ["a"], 8), "z": zorder_rewrite(df, ["a", "b"], 16)}.items():
        out.write.parquet(f"{folder}/{name}")
        back = spark.read.parquet(f"{folder}/{name}")
        assert rows(back.agg(F.count("a"), F.sum("a"), F.sum("b"))) == rows(df.agg(F.count("a"), F.sum("a"), F.sum("b")))
        per = back.groupBy(F.input_file_name()).agg((F.max("a") - F.min("a")).alias("w")).agg(F.avg("w")).first()[0]
        assert per < 600


def test_parse_or_reject_and_min_max(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,)], "v string")
    out = calc.parse_or_reject(df, {"v": "double"}).collect()
    assert [(r.v, r._rejects) for r in out] == [(1.5, []), (None, ["v"]), (None, [])]
    n = calc.min_max_norm(spark.createDataFrame([(1,), (3,), (5,)], "x int").repartition(3), "x", "n")
    assert [r.n for r in n.orderBy("x").collect()] == [0.0, 0.5, 1.0]


def test_percent_rounds_exact_halves_up(spark):
    out = spark.createDataFrame([(4.545, 3.232), (1.0, 0.0), (1e300, 1e-300)], "a double, b double").select(calc.change_pct(F.col("a"), F.col("b")).alias("p"))
    assert [None if r.p is None else float(r.p) for r in out.collect()] == [40.63, None, None]


def test_emails_and_masks(spark):
    df = spark.createDataFrame([("mail a.b+c@x-1.example.com, or q@w. and z@k.org!",)], "t string")
    assert df.select(calc.extract_emails(F.col("t"))).first()[0] == ["a.b+c@x-1.example.com", "z@k.org"]
    assert df.select(calc.mask_email(F.lit("joe@corp.test"))).first()[0] == "***@corp.test"


def test_registered_functions(spark):
    calc.register_sql_functions(spark)
    r = spark.sql("SELECT salary_band_py(80000), salary_band_py(NULL), salary_band(60000), mask_email('a@b.c'), region_allowed('US', 'US')").first()
    assert tuple(r) == ("High", "Unknown", "Medium", "***@b.c", True)
