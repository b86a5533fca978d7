"""Operators on texts against brute force on small fixtures, with the odd cases each docstring names."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerline.llm import common, graph, langid, line_dedup, lm, mixing, near_text, packing, quality_rules, tokens, toxicity
from conftest import DATA

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, row string, own int, c0 string, lang_pred int"
WORDS = "the of and to in is that for it was on with as by at from".split()


def sentence(rng, n, extra=()):
    words = [*WORDS, *extra, *(f"w{k}" for k in range(400))]
    return " ".join(words[i] for i in rng.integers(0, len(words), n))


def odd_rows():
    """NULLs in any column, empty and blank texts, a very long one, repeated rows, ties, strange blanks."""
    rng = np.random.default_rng(3)
    base = "\n".join(sentence(rng, 30) for _ in range(4))
    texts = [
        base, base, base + " more", None, "", "   \n\t ", "a", "\x1c\x1d odd blanks here 　 x", "12345 !!! 678",
        sentence(rng, 60_000), "word" * 20_000, base.upper(), "\n".join(["same line here"] * 50), "the <|endoftext|> of  <|endoftext|>",
        "\n".join(sentence(rng, 30) for _ in range(5)),
    ]
    rows = [(i, t, "en" if i % 4 else None, [None, "b", "a", "B", ""][i % 5], 1, 2, "x", 3, "y", 4) for i, t in enumerate(texts)]
    rows += [rows[0], rows[9], rows[4], (None, base, None, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def given(spark):
    return common.table(spark, DATA, "documents")


def remainder(doc, n):
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % n


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (200, 7), (300, 301), (301, 300)]
    found = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(41)) and found[200] == 0 and found[159] == 100 and found[301] == 300
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_components(rows, width, percent):
    sets, parent = defaultdict(set), {}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for doc, text in rows:
        w = (text or "").encode().lower().split()
        s = frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()
        sets[doc].add(s)
        parent[doc] = doc
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: root(d) for d in ids}, sets


def test_near_duplicates(given, odd, none):
    for frame, width in ((given, 4), (odd, 5)):
        rows = [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]
        want, sets = brute_components([r for r in rows if r[0] is not None], width, 80)
        got = near_text.near_duplicates(frame, width, 80).collect()
        assert len(got) == len(rows)
        for r in got:
            if r["doc_id"] is not None:
                assert r["component_id"] == want[r["doc_id"]] and r["kept"] == (want[r["doc_id"]] == r["doc_id"])
                assert r["n_shingles"] in {len(s) for s in sets[r["doc_id"]]}
            else:
                assert r["component_id"] is None and r["kept"]
    assert near_text.near_duplicates(none).count() == 0


def test_near_duplicates_in_mixed_tables(spark):
    """Chains of texts of which only neighbours are similar, so that stars alone would not find every link."""
    rng = np.random.default_rng(5)
    rows, doc = [], 0
    for _ in range(6):
        text = sentence(rng, 120).split()
        for _ in range(12):
            at = rng.integers(0, len(text), 3)
            for i in at:
                text[i] = f"n{rng.integers(0, 10**6)}"
            rows.append((doc, " ".join(text)))
            doc += 1
    want, _ = brute_components(rows, 4, 80)
    got = {r["doc_id"]: r["component_id"] for r in near_text.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4, 80).collect()}
    assert got == want


def test_token_counts(given, odd, none):
    path = tokens.public_path("byte_bpe_50k.json")
    tok = tokens.tokenizer(path)
    for frame in (given, odd):
        got = tokens.token_counts(frame, path, 512).collect()
        want = Counter()
        for r in frame.select("doc_id", "text").collect():
            n = len(tok.encode(r["text"] or "", add_special_tokens=False).ids)
            want[r["doc_id"], len((r["text"] or "").encode()), n, n > 512] += 1
        assert Counter(tuple(r) for r in got) == want
    assert tokens.token_counts(none, path).count() == 0


def test_pieces_of_strange_blanks():
    path = tokens.public_path("byte_bpe_50k.json")
    tok, rng = tokens.tokenizer(path), np.random.default_rng(1)
    signs = [" ", "  ", "\n", "\t", "\x0b", "\x1c", "\x1f", "\x85", " ", " ", "᠎", " ", "​", " ", "　", "a", "it's", "I'll", "9", "é", "!", "'", "ß1", "\U0001f600"]
    for _ in range(400):
        text = "".join(signs[i] for i in rng.integers(0, len(signs), 12))
        pieces = tokens.PIECE.findall(text)
        assert "".join(pieces) == text
        assert sum(tokens.lengths(path, pieces)) == len(tok.encode(text, add_special_tokens=False).ids), repr(text)
    path = tokens.public_path("word_bpe_49k.json")
    for _ in range(400):
        text = "".join(signs[i] for i in rng.integers(0, len(signs), 12))
        assert np.frombuffer(packing.encoded([text], path)[0], "<u4").tolist() == tokens.tokenizer(path).encode(text, add_special_tokens=False).ids, repr(text)


def test_summaries_stay_bounded():
    merged = {}
    for k in range(50):
        merged = tokens._merge(merged, {"often": 10, **{f"{k}-{i}": 1 for i in range(30)}}, 40)
    assert len(merged) <= 40 and max(merged, key=merged.get) == "often"


def test_best_fit(given, odd, none):
    path = tokens.public_path("word_bpe_49k.json")
    tok = tokens.tokenizer(path)
    for frame in (given, odd):
        got = packing.best_fit(frame, path, 2048, 0).collect()
        want, total = Counter(), 0
        for r in frame.select("doc_id", "text").collect():
            ids = [*tok.encode(r["text"] or "", add_special_tokens=False).ids, 0]
            total += len(ids)
            for k in range(0, len(ids), 2048):
                part = np.array(ids[k : k + 2048], "<u4")
                want[r["doc_id"], k // 2048, k, len(part), zlib.crc32(part.tobytes())] += 1
        assert Counter(tuple(r)[:5] for r in got) == want
        filled = defaultdict(list)
        for r in got:
            filled[r["sequence_id"]].append((r["offset"], r["length"]))
        for parts in filled.values():
            at = 0
            for start, size in sorted(parts):
                assert start == at
                at += size
            assert at <= 2048
        assert len(filled) <= math.ceil(total / 2048) * 1.1 + 1
    assert packing.best_fit(none, path).count() == 0


def test_best_fit_merges_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(packing, "POOL", 8)
    rows = [(i, "the " * (i % 60 + 1)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    got = packing.best_fit(docs, tokens.public_path("word_bpe_49k.json"), 64, 0).collect()
    filled = defaultdict(list)
    for r in got:
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    assert len(got) == 300 and all(sum(n for _, n in p) <= 64 for p in filled.values())
    for parts in filled.values():
        at = 0
        for start, size in sorted(parts):
            assert start == at
            at += size
    assert len(filled) <= 1.12 * math.ceil(sum(i % 60 + 2 for i in range(300)) / 64)


def test_language(given, odd, none):
    got = {r["doc_id"]: r for r in langid.identify(given).collect()}
    held = [r for r in given.select("doc_id", "lang", "text").collect() if remainder(r["doc_id"], 5) == 0 and len(r["text"]) > 60]
    assert all(got[r["doc_id"]]["held_out"] for r in held)
    assert np.mean([got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held]) > 0.97
    rows = langid.identify(odd).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    texts = {r["doc_id"]: r["text"] for r in odd.where("doc_id is not null").collect()}
    for r in rows:
        if r["doc_id"] is not None:
            assert (r["lang_pred"] == "und") == (not re.search(r"[^\W\d_]", texts[r["doc_id"]] or ""))
    assert langid.identify(none).count() == 0
    assert {r["lang_pred"] for r in langid.identify(odd.withColumn("lang", odd["lang"].substr(9, 1)).where("lang is null")).collect()} <= {"und", ""}


def test_language_mixture():
    model = np.full((3, langid.CELLS), 1e-6, np.float32)
    for i in range(3):
        model[i, i * 100 : i * 100 + 100] = 0.01
    both = np.concatenate([np.arange(0, 70), np.arange(100, 130)])
    chosen, _ = langid.mixtures([np.tile(both, 5), np.arange(200, 260)], model)
    assert abs(chosen[0][0] - 0.7) < 0.02 and abs(chosen[0][1] - 0.3) < 0.02 and chosen[0][2] == 0
    assert chosen[1].tolist() == [0, 0, 1]


def test_toxicity(spark, given, odd, none):
    labels = common.table(spark, DATA.replace("0.001", "0.01"), "labels")
    docs = common.table(spark, DATA.replace("0.001", "0.01"), "documents")
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    held = [r for r in labels.collect() if remainder(r["doc_id"], 3) == 1]
    toxic = [got[r["doc_id"]]["score"] for r in held if r["toxic"] == 1]
    clean = [got[r["doc_id"]]["score"] for r in held if r["toxic"] == 0]
    assert np.mean([(t > c) + 0.5 * (t == c) for t in toxic for c in clean]) > 0.85
    assert all(r["predicted"] == (r["score"] >= 0.7) and r["held_out"] == (remainder(d, 3) == 1) for d, r in got.items())
    rows = toxicity.toxicity(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.toxicity(none, labels).count() == 0
    assert toxicity.toxicity(odd, labels.where("false")).where("score <> 0").count() == 0


def test_boosted_trees_and_calibration():
    rng = np.random.default_rng(2)
    x = rng.random((2000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    trees = toxicity.Boosted(x, y)
    margin = trees.margin(x)
    assert ((margin > 0) == (y > 0)).mean() > 0.95
    knots, rates = toxicity.isotonic(margin, y)
    assert (np.diff(rates) >= 0).all() and (np.diff(knots) > 0).all()
    assert len(toxicity.features("", {})) == len(toxicity.FEATURES)


def brute_lm(rows):
    train = [[*(t or "").encode().lower().split(), None] for d, t in rows if remainder(d, 7) != 2]
    counts = Counter(w for t in train for w in t)
    return counts, sum(counts.values()), len(counts), train


@pytest.mark.parametrize("which", ["given", "odd"])
def test_lm_scores(which, request):
    frame = request.getfixturevalue(which)
    rows = [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]
    counts, n, v, train = brute_lm(rows)
    pairs = Counter(p for t in train for p in zip([0, *t], t))
    contexts = Counter(c for t in train for c in [0, *t][:-1])
    want = defaultdict(list)
    for d, t in rows:
        seq = [*(t or "").encode().lower().split(), None]
        base = [math.log10((counts[w] + 1) / (n + v + 1)) for w in seq]
        score = sum(math.log10((pairs[c, w] + lm.PRIOR * 10**b) / (contexts[c] + lm.PRIOR)) for c, w, b in zip([0, *seq], seq, base))
        want[d].append((len(seq), sum(counts[w] > 0 for w in seq), sum(base), score))
    got = lm.score_texts(frame).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["held_out"] == (remainder(r["doc_id"], 7) == 2) and r["train_tokens"] == n
        assert any(
            (r["n_tokens"], r["n_known"]) == w[:2] and abs(r["base_score"] - w[2]) < 1e-6 * max(1, -w[2]) and abs(r["score"] - w[3]) <= lm.STEP * w[0]
            for w in want[r["doc_id"]]
        )


def test_lm_small_vocabulary(given, monkeypatch, none):
    """Words outside the vocabulary: the base score stays exact, and a context's probabilities sum to one."""
    monkeypatch.setattr(lm, "SHARD", 5_000)
    rows = [(r["doc_id"], r["text"]) for r in given.select("doc_id", "text").collect()]
    counts, n, v, _ = brute_lm(rows)
    top = [np.array([5, 9, 7], np.uint64), np.array([30, 20, 10], np.int64)]
    voc = lm.Vocabulary(*top, docs=8, tokens=100, types=12)
    for context in range(lm.FIRST + 3):
        if context != lm.END:
            ids = np.array([i for i in range(lm.FIRST + 3) if i != lm.START])
            seen = np.zeros(len(ids))
            assert abs((10 ** voc.log((context << 16) | ids, seen)).sum() * (voc.contexts[context] + lm.PRIOR) / lm.PRIOR - 1) < 1e-9
    got = {r["doc_id"]: r for r in lm.score_texts(given).collect()}
    for d, t in rows:
        seq = [*(t or "").encode().lower().split(), None]
        assert abs(got[d]["base_score"] - sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in seq)) < 1e-6 * len(seq)
    assert lm.score_texts(none).count() == 0


@pytest.mark.parametrize("which", ["given", "odd"])
@pytest.mark.parametrize("size", [lm.FIRST, lm.FIRST + 5, 300])
def test_lm_more_words_than_are_broadcast(which, size, request, monkeypatch):
    """Pairs of words without a broadcast id are counted one by one: the score is that of the whole vocabulary."""
    monkeypatch.setattr(lm, "VOCABULARY", size)
    monkeypatch.setattr(lm, "SHARD", 5_000)
    test_lm_scores(which, request)


def test_elias_fano_and_trie():
    rng = np.random.default_rng(4)
    for n, top in ((1, 1), (5, 3), (1000, 50), (1000, 10**7), (3000, 2**32)):
        values = np.sort(rng.integers(0, top, n))
        ef = lm.EliasFano(np.frombuffer(lm.EliasFano.encode(values), np.uint8))
        assert ef.get(np.arange(n)).tolist() == values.tolist()
    pairs = np.unique((rng.integers(0, 300, 4000) << 16) | rng.integers(0, 65_536, 4000))
    steps = rng.integers(0, 65_536, len(pairs))
    trie = lm.Trie(np.frombuffer(lm.Trie.encode(pairs, steps), np.uint8))
    assert trie.find(pairs).tolist() == steps.tolist()
    other = np.setdiff1d(rng.integers(0, 2**32, 2000), pairs)
    assert (trie.find(other) == -1).all()
    empty = np.zeros(0, np.int64)
    assert lm.Trie(np.frombuffer(lm.Trie.encode(empty, empty), np.uint8)).find(pairs).tolist() == [-1] * len(pairs)


def brute_quality(text):
    w = words_of(text)
    windows = defaultdict(list)
    for i in range(len(w) - 2):
        windows[tuple(w[i : i + 3])].append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_quality_rules(given, odd, none, monkeypatch):
    for frame, most in ((given, 64), (odd, 64), (odd, 0)):
        monkeypatch.setattr(quality_rules, "LOOKED_UP", most)
        want = Counter()
        for r in frame.select("doc_id", "text").collect():
            m = brute_quality(r["text"])
            want[r["doc_id"], *m, m[0] < 50 or 100 * m[4] > 50 * m[0]] += 1
        got = quality_rules.judge(frame).collect()
        assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in got) == want
        assert not any(r["kept"] and r["base_failed"] for r in got)
    assert quality_rules.judge(none).count() == 0


def test_divergence_against_brute_force(given):
    rows = given.select("doc_id", "lang", "text").collect()

    def classes(text):
        kinds = [0] * 7
        for c in text:
            if c.isspace():
                kinds[1] += 1
            elif c.islower():
                kinds[0] += 1
            elif c.isupper():
                kinds[2] += 1
            elif c in """.,;:!?'"()-""":
                kinds[3] += 1
            elif c.isnumeric():
                kinds[4] += 1
            elif c in "#*$%&|<>":
                kinds[5] += 1
            else:
                kinds[6] += 1
        return np.array(kinds, float)

    def distance(p, q):
        p, q = p / p.sum(), q / q.sum()
        m = (p + q) / 2
        part = lambda x: np.sum(np.where(x > 0, x * np.log2(np.where(x > 0, x, 1) / np.where(m > 0, m, 1)), 0))
        return math.sqrt(max(0, (part(p) + part(q)) / 2))

    split = lambda t: re.findall(r"[^\W\d_]+", t.lower())
    refs = {}
    for lang in {r["lang"] for r in rows}:
        own = [r["text"] for r in rows if r["lang"] == lang]
        words = Counter(w for t in own for w in split(t))
        common_ = [w for w, _ in sorted(((w, n) for w, n in words.items() if len(w) <= quality_rules.COMMON_LETTERS), key=lambda x: (-x[1], x[0].encode()))][: quality_rules.COMMON]
        refs[lang] = (sum(map(classes, own)), common_, np.array([*(words[w] for w in common_), sum(words.values()) - sum(words[w] for w in common_)], float))
    got = {r["doc_id"]: r for r in quality_rules.judge(given).collect()}
    for r in rows:
        ref, common_, counts = refs[r["lang"]]
        assert abs(got[r["doc_id"]]["char_distance"] - distance(classes(r["text"]), ref)) < 1e-9
        words = Counter(split(r["text"]))
        own = np.array([*(words[w] for w in common_), sum(words.values()) - sum(words[w] for w in common_)], float)
        if own.sum():
            assert abs(got[r["doc_id"]]["word_distance"] - distance(own, counts)) < 1e-6


def test_line_dedup(spark, odd, none):
    rng = np.random.default_rng(8)
    lines = [sentence(rng, 12) for _ in range(200)]
    passage = [sentence(rng, 20) for _ in range(3)]
    other = [sentence(rng, 30) for _ in range(2)]
    docs = [
        (5, lines[:6] + passage + lines[6:8] + other), (9, lines[10:14] + other + lines[20:23] + passage + lines[30:31]),
        (11, passage), (12, lines[40:50] + [lines[0]]), (3, lines[60:66] + passage[:1]), (13, passage + lines[70:72] + passage), (14, lines[80:84]),
    ]
    frame = spark.createDataFrame([(d, "\n".join(t), "x") for d, t in docs], "doc_id long, text string, cuts string")
    got = {r["doc_id"]: r["text"].split("\n") for r in line_dedup.dedup_lines(frame).collect()}
    assert got[3] == docs[4][1] and got[14] == docs[6][1] and got[12] == docs[3][1]
    assert got[5] == docs[0][1]
    assert got[9] == lines[10:14] + lines[20:23] + lines[30:31]
    assert got[11] == [""] and got[13] == lines[70:72]
    rows = line_dedup.dedup_lines(odd).collect()
    assert len(rows) == odd.count() and rows[0].__fields__ == [*odd.columns, "n_lines", "lines_cut", "words_cut"]
    texts = {r["doc_id"]: r["text"] for r in rows if r["doc_id"] is not None}
    assert texts[0] == odd_rows()[0][1] and texts[1] == "" and texts[3] is None and texts[9] == odd_rows()[9][1]
    assert line_dedup.dedup_lines(none).count() == 0


def test_line_dedup_without_a_common_first_holder(spark):
    """Blocks whose lines were first seen in different documents, and blocks of lines of one or two words."""
    rng = np.random.default_rng(9)
    block, short = [sentence(rng, 15) for _ in range(4)], [f"s{k}" if k % 2 else f"s{k} t" for k in range(20)]
    uneven = [sentence(rng, n) for n in (20, 20, 3)]
    own = {d: [sentence(rng, 30) for _ in range(2)] for d in range(1, 20)}
    docs = {d: [own[d][0], block[d - 1], own[d][1]] for d in (1, 2, 3, 4)}
    docs |= {d: [own[d][0], *block, own[d][1]] for d in (5, 9)} | {d: [own[d][0], *short, own[d][1]] for d in (10, 11)}
    docs |= {12: [own[12][0], *uneven[:2], own[12][1]], 13: [own[13][0], uneven[2], own[13][1]]}
    docs |= {d: [own[d][0], *uneven, own[d][1]] for d in (14, 15)}
    frame = spark.createDataFrame([(d, "\n".join(t)) for d, t in docs.items()], "doc_id long, text string")
    got = {r["doc_id"]: r["text"].split("\n") for r in line_dedup.dedup_lines(frame).collect()}
    assert got[9] == own[9] and got[11] == own[11] and got[15] == own[15]
    assert got[14] == [own[14][0], uneven[2], own[14][1]]
    assert all(got[d] == docs[d] for d in (1, 2, 3, 4, 5, 10, 12, 13))


def test_runs_of_lines_cover_every_block():
    rng = np.random.default_rng(10)
    for _ in range(50):
        words = rng.choice([0, 1, 2, 9, 14, 30], rng.integers(1, 40)).astype(np.int32)
        lines = np.where(words > 0, rng.integers(1, 2**62, len(words)), 0).astype(np.uint64)
        kept, sizes = lines[words > 0], words[words > 0]
        keys, spans = set(line_dedup.runs(lines, words, 25)), []
        for i in range(len(kept)):
            for j in range(i + 1, len(kept) + 1):
                if (j - i == 1 and sizes[i] >= 25) or set(line_dedup.runs(kept[i:j], sizes[i:j], 0 + sizes[i:j].sum())) & keys:
                    spans.append((i, j))
        for i in range(len(kept)):
            for j in range(i + 1, len(kept) + 1):
                if sizes[i:j].sum() >= 25:
                    inside = {k for a, b in spans if i <= a and b <= j for k in range(a, b)}
                    assert inside == set(range(i, j))


def test_patience():
    assert line_dedup.patience([1, 2, 3, 4], [1, 9, 3, 4]) == [(0, 0), (2, 2), (3, 3)]
    assert line_dedup.patience([7, 1, 1, 2, 1, 8], [9, 1, 1, 2, 1, 6]) == [(1, 1), (2, 2), (3, 3), (4, 4)]
    assert line_dedup.rising([3, 1, 2, 5, 4]) in ([1, 2, 3], [1, 2, 4])
    words = [1] * 6
    assert line_dedup.common_lines([1, 2, 3, 4, 5, 6], [4, 5, 6, 1, 2, 3], words, 3) == [0, 1, 2, 3, 4, 5]


def test_mixing(given, odd, none):
    for frame in (given, odd):
        rows = [(r["doc_id"], len(words_of(r["text"])), r["source"]) for r in frame.select("doc_id", "text", "source").collect()]
        sizes = Counter()
        for _, n, s in rows:
            sizes[s] += n
        names = sorted(sizes, key=lambda s: (s is None, s or ""))
        targets = dict(zip(names, mixing.share_out([sizes[s] for s in names], [(3, 1, 2)[i % 3] for i in range(len(names))], 1.5, 2.0)))
        assert all(t <= 2 * sizes[s] + 1e-6 for s, t in targets.items())
        got = mixing.mixed_counts(frame).collect()
        again = mixing.mixed_counts(frame.repartition(5)).collect()
        assert Counter(map(tuple, got)) == Counter(map(tuple, again))
        source = defaultdict(set)
        for d, n, s in rows:
            source[d, n].add(s)
        assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((d, n) for d, n, _ in rows)
        assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
        assert all(any((r["source_size"], r["target"]) == (sizes[s], targets[s]) for s in source[r["doc_id"], r["size"]]) for r in got)
        by_target = Counter()
        for r in got:
            by_target[r["source_size"], r["target"]] += r["taken"]
        for (size, target), taken in by_target.items():
            assert abs(taken - target * sum((sizes[s], targets[s]) == (size, target) for s in names)) <= len(names)
    assert mixing.mixed_counts(none).count() == 0


def test_shards_and_permutations(monkeypatch):
    monkeypatch.setattr(mixing, "SHARD", 16)
    for n in (1, 2, 7, 100, 1025):
        x = np.arange(n)
        p = mixing.permuted(x, n, 3)
        assert sorted(p.tolist()) == x.tolist() and mixing._feistel(p, n, 3, back=True).tolist() == x.tolist()
    sizes, targets = [1000, 37, 0, 4096], [1500.0, 74.0, 0.0, 900.0]
    plan = mixing.Plan(sizes, targets, 16)
    shards = -(-sum(plan.slots) // 16)
    import pandas as pd

    slots = pd.concat(mixing._slots(plan, shards)([pd.DataFrame({"id": [i]}) for i in range(shards)]))
    assert (slots.groupby("shard").size()[:-1] == 16).all() and not slots.duplicated(["shard", "slot"]).any()
    for s in range(4):
        own = slots[slots["source_no"] == s]
        length = np.minimum(own["words"], sizes[s] - own["block"] * 16)
        assert length.sum() == round(targets[s]) and not own.duplicated(["turn", "block"]).any()


def test_draws_at_any_size():
    """Counts spread as drawn without replacement, also beyond 10**9, where numpy's generator ends."""
    for counts in (np.array([5, 0, 9, 20]), np.array([2 * 10**9, 10**8, 0, 19 * 10**8])):
        total = int(counts.sum())
        first = total * 2 // 5
        got = np.array([mixing.halves(counts, first, [7, k]) for k in range(100)])
        assert (got.sum(axis=1) == first).all() and (got >= 0).all() and (got <= counts).all()
        for i in np.flatnonzero(counts):
            share = counts[i] / total
            spread = np.sqrt(first * share * (1 - share) * (total - first) / (total - 1))
            z = (got[:, i] - first * share) / spread
            assert abs(z.mean()) < 0.45 and 0.7 < z.std() < 1.3


def test_running_start(spark, monkeypatch):
    monkeypatch.setattr(mixing, "STEP", 3)
    rows = [(i, i % 3 % 2, i % 7) for i in range(200)]
    got = mixing.running_start(spark.createDataFrame(rows, "row long, k long, size long"), "k", ["row"], "size").collect()
    for k in (0, 1):
        at = 0
        for r in sorted((r for r in got if r["k"] == k), key=lambda r: (r["start"], r["size"] > 0)):
            assert r["start"] == at
            at += r["size"]


def test_quality_measures_need_no_regular_expression(spark):
    """Words, their letters and symbols are counted by plain replacement; all six blanks part words, others do not."""
    text = "a\tbb\nccc\u000bd\u000ce\rf  g h #*$%&|<> ä€\U0001f600 <<"
    df = spark.createDataFrame([(text,), ("",), (" \t\n",)], "text string")
    plan = quality_rules.measures(df)
    rows = [(r.n_words, r.word_chars, r.n_symbols) for r in plan.collect()]
    assert rows == [(10, 25, 10), (0, 0, 0), (0, 0, 0)]
    assert "regexp" not in plan._jdf.queryExecution().optimizedPlan().toString()
