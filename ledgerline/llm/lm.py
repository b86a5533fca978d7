"""Language-model scores from Elias-Fano n-gram tries, built and queried shard by shard."""

from __future__ import annotations

import tempfile
from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import id_remainder, materialise, mix64, text_bytes, word_hashes

#: Ids that every worker knows, those of the most frequent words. Other words are told apart by hash, flagged by RARE,
#: and have ids within their shard; OTHER only marks them.
VOCABULARY, START, END, OTHER, FIRST = 65_536, 0, 1, 2, 3
RARE = np.uint64(1 << 63)
#: Weight of the unigram distribution in each context, in tokens.
PRIOR = 100.0
#: Tokens that a task handles together, and of a shard. Pairs at most that every worker holds.
GROUP, SHARD, HOT, LEAST_HOT = 300_000, 250_000, 1_000_000, 16
#: Numbers whose low bits are packed at once, a multiple of eight. Texts of a group at most, as their numbers have 16 bits.
PACKED, TEXTS = 1 << 14, 65_535
#: Probabilities are kept as 16-bit steps of log10.
STEP = 16 / 65_535
ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)
SELECT = np.array([[([k for k in range(8) if i >> k & 1] + [8] * 8)[j] for j in range(8)] for i in range(256)], np.uint8)


class EliasFano:
    """A rising sequence in about 2 + log2(universe / n) bits for each number, read in place from a byte array."""

    @staticmethod
    def encode(values: np.ndarray) -> bytes:
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        low = max(0, min(24, (top // max(n, 1)).bit_length() - 1))
        # Low bits are packed block by block: a number takes a byte for each of them meanwhile.
        parts = []
        for k in range(0, n if low else 0, PACKED):
            bits = (values[k : k + PACKED, None] >> np.arange(low)).astype(np.uint8) & 1
            parts.append(np.packbits(bits.ravel(), bitorder="little").tobytes())
        lows = b"".join(parts) + b"\0" * 4
        size = (n + (top >> low) + 64) // 64 * 64
        flags = np.zeros(size, np.uint8)
        flags[(values >> low) + np.arange(n)] = 1
        highs = np.packbits(flags, bitorder="little")
        ranks = np.concatenate([[0], np.cumsum(flags.reshape(-1, 64).sum(axis=1, dtype=np.int64))]).astype(np.uint32)
        return np.array([n, low, len(lows), len(highs), len(ranks)], np.int64).tobytes() + ranks.tobytes() + highs.tobytes() + lows

    def __init__(self, data: np.ndarray):
        self.n, self.low, lows, highs, ranks = (int(x) for x in data[:40].view(np.int64))
        self.ranks = data[40 : 40 + 4 * ranks].view(np.uint32)
        self.highs = data[40 + 4 * ranks :][:highs]
        self.lows = data[40 + 4 * ranks + highs :][:lows]

    def get(self, index: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.ranks, index, side="right") - 1
        left = index - self.ranks[word].astype(np.int64)
        at, out = word * 8, np.full(len(index), -1, np.int64)
        for byte in range(8):
            value = self.highs[at + byte]
            ones = ONES[value]
            here = (out < 0) & (left < ones)
            out[here] = (at[here] + byte) * 8 + SELECT[value[here], left[here]]
            left = left - np.where(out < 0, ones, 0)
        high = out - index
        if not self.low:
            return high
        bit = index * self.low
        byte = bit >> 3
        window = sum(self.lows[byte + k].astype(np.int64) << (8 * k) for k in range(4))
        return (high << self.low) | ((window >> (bit & 7)) & ((1 << self.low) - 1))


class Trie:
    """Contexts with monotone pointers to their successors, and a quantised probability for each of these.

    Successors of a context follow the last one of the context before, so that one rising sequence holds them all; a
    search is relative to that last one.
    """

    @staticmethod
    def encode(pairs: np.ndarray, steps: np.ndarray, bits: int = 16) -> bytes:
        """``pairs``: sorted, the word in the low ``bits`` bits and the context above."""
        context, word = (pairs >> bits).astype(np.int64), (pairs & ((1 << bits) - 1)).astype(np.int64)
        pointers = np.concatenate([[0], np.cumsum(np.bincount(context))])
        new = np.flatnonzero(np.diff(context, prepend=-1))
        last = np.zeros(len(pairs), np.int64)
        if len(new) > 1:
            last[new[1:]] = word[new[1:] - 1]
        parts = [EliasFano.encode(pointers), EliasFano.encode(word + np.cumsum(last)), steps.astype("<u2").tobytes()]
        parts = [p + b"\0" * (-len(p) % 8) for p in parts]
        return np.array([*(len(p) for p in parts), bits], np.int64).tobytes() + b"".join(parts)

    def __init__(self, data: np.ndarray):
        *sizes, self.bits = data[:32].view(np.int64).tolist()
        at = 32 + np.concatenate([[0], np.cumsum(sizes)])
        self.pointers, self.words = EliasFano(data[at[0] : at[1]]), EliasFano(data[at[1] : at[2]])
        self.steps = data[at[2] : at[3]].view("<u2")

    def find(self, pairs: np.ndarray) -> np.ndarray:
        """The step of each pair, -1 where it is not in the trie."""
        out = np.full(len(pairs), -1, np.int64)
        if not self.words.n or not len(pairs):
            return out
        context, word = (pairs >> self.bits).astype(np.int64), (pairs & ((1 << self.bits) - 1)).astype(np.int64)
        inside = context < self.pointers.n - 1
        context = np.where(inside, context, 0)
        low, end = self.pointers.get(context), self.pointers.get(context + 1)
        target = word + np.where(low > 0, self.words.get(np.maximum(low - 1, 0)), 0)
        high = end.copy()
        while (open_ := low < high).any():
            mid = (low + high) // 2
            less = open_ & (self.words.get(np.minimum(mid, self.words.n - 1)) < target)
            low, high = np.where(less, mid + 1, low), np.where(open_ & ~less, mid, high)
        at = np.minimum(low, self.words.n - 1)
        hit = inside & (low < end) & (self.words.get(at) == target)
        out[hit] = self.steps[at[hit]]
        return out


class Vocabulary:
    """Word counts of the model, and what follows from them."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, docs: int, tokens: int, types: int):
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], (order + FIRST).astype(np.int64)
        self.tokens, self.types = tokens, types
        other = tokens - docs - int(counts.sum())
        #: How often each id stands as a token, and as a context.
        self.counts = np.concatenate([[0, docs, other], counts]).astype(np.float64)
        self.contexts = self.counts.copy()
        self.contexts[START], self.contexts[END] = docs, 0
        self.rest = other + max(0, types - (docs > 0) - len(counts)) + 1.0
        total = tokens + types + 1.0
        self.base = np.log10((self.counts + 1) / total)
        unigram = (self.counts + 1) / total
        unigram[START], unigram[OTHER] = 1, self.rest / total
        self.unigram = unigram
        self.total = total

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(hashes), OTHER, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.ids[at], OTHER)

    def log(self, pairs: np.ndarray, counts: np.ndarray | float) -> np.ndarray:
        """log10 probability of the second id after the first, seen ``counts`` times."""
        context, word = pairs >> 16, pairs & 0xFFFF
        return np.log10((counts + PRIOR * self.unigram[word]) / (self.contexts[context] + PRIOR))

    def steps(self, pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return np.clip(np.rint(-self.log(pairs, counts) / STEP), 0, 65_535).astype(np.int64)


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mix64(keys.astype(np.uint64)) >> np.uint64(32)).astype(np.int64) % shards


def _by_shard(shard: np.ndarray, *arrays: np.ndarray) -> Iterable[tuple]:
    order = np.argsort(shard, kind="stable")
    found, start = np.unique(shard[order], return_index=True)
    arrays = [a[order] for a in arrays]
    for s, low, high in zip(found.tolist(), start, [*start[1:], len(order)]):
        yield s, *(a[low:high] for a in arrays)


def _groups(batches):
    """Texts with their ids and flags, in runs of about GROUP tokens."""
    held, size = [], 0
    for batch in batches:
        for doc, out, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "held_out", "text"))):
            words = word_hashes(text)
            held.append((doc, out, words))
            size += len(words) + 1
            if size >= GROUP or len(held) == TEXTS:
                yield held
                held, size = [], 0
    if held:
        yield held


def _count_words(batches):
    for group in _groups(batches):
        found, counts = np.unique(np.concatenate([w for _, _, w in group]), return_counts=True)
        for i in range(0, len(found), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(found[i : i + 100_000].view(np.int64)), pa.array(counts[i : i + 100_000])], names=["word", "n"])


def _ids(group, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, pairs and the place of the text of every token of a group, ends included."""
    sizes = np.array([len(w) + 1 for _, _, w in group])
    ids = np.full(int(sizes.sum()), END, np.int64)
    ends = np.cumsum(sizes) - 1
    inside = np.ones(len(ids), bool)
    inside[ends] = False
    ids[inside] = vocabulary.of(np.concatenate([w for _, _, w in group]))
    before = np.concatenate([[START], ids[:-1]])
    before[ends[:-1] + 1] = START
    return ids, (before << 16) | ids, np.repeat(np.arange(len(group)), sizes)


def _count_pairs(shared, shards: int):
    def run(batches):
        def out(pairs):
            pairs, counts = np.unique(np.concatenate(pairs), return_counts=True)
            rows = list(_by_shard(shard_of(pairs, shards), pairs, counts))
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), *(pa.array([r[k].astype("<u4").tobytes() for r in rows], pa.binary()) for k in (1, 2))],
                names=["shard", "pairs", "counts"],
            )

        held, size = [], 0
        for group in _groups(batches):
            pairs = _ids(group, shared.value)[1]
            # Pairs with a rare word are counted in that word's shard, from the queries of the training texts.
            held.append(pairs[(pairs >> 16 != OTHER) & (pairs & 0xFFFF != OTHER)].astype(np.uint32))
            size += len(held[-1])
            if size >= 4 * GROUP:
                yield out(held)
                held, size = [], 0
        if held:
            yield out(held)

    return run


def _numbers(blobs, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), kind)


def _build(shared):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        pairs, inverse = np.unique(_numbers(frame["pairs"], "<u4"), return_inverse=True)
        counts = np.bincount(inverse, _numbers(frame["counts"], "<u4")).astype(np.int64)
        steps = shared.value.steps(pairs.astype(np.int64), counts)
        often = counts >= LEAST_HOT
        sizes = np.bincount(np.log2(np.maximum(counts, 1)).astype(np.int64), minlength=64)
        return pd.DataFrame({
            "shard": [int(frame["shard"].iloc[0])], "trie": [Trie.encode(pairs.astype(np.int64), steps)], "sizes": [sizes.tolist()],
            "often": [pairs[often].astype("<u4").tobytes()], "often_counts": [counts[often].astype("<i8").tobytes()], "often_steps": [steps[often].astype("<u2").tobytes()],
        })

    return run


QUERIES = "kind int, shard long, part long, trained long, a binary, b binary, c binary"


def _ask(shared, hot, shards: int, other_shards: int):
    """Queries of a group of texts: kind 0 the texts with what is known here, 1 pairs of words with ids, 2 rare words.

    A rare word is asked for with the word before it and, if that has an id, the word after it; its shard answers for
    the pair that it ends, for the pair that it begins unless a rare word ends that, and for its own counts.
    """

    def run(batches):
        vocabulary, (hot_pairs, hot_logs) = shared.value, hot.value
        task = TaskContext.get().partitionId() << 24
        for number, group in enumerate(_groups(batches)):
            # Training texts first, so that one number tells them from the others.
            group.sort(key=lambda g: g[1])
            trained = sum(not g[1] for g in group)
            ids, pairs, place = _ids(group, vocabulary)
            n = len(group)
            known = np.bincount(place, vocabulary.counts[ids] * (ids != OTHER) > 0, n)
            base = np.bincount(place, np.where(ids == OTHER, -np.log10(vocabulary.total), vocabulary.base[ids]), n)
            before, rare = pairs >> 16, ids == OTHER
            mixed = rare | (before == OTHER)
            weight = np.where(rare, 1 / vocabulary.total, vocabulary.unigram[ids])[mixed]
            context = np.where(before == OTHER, 1.0, vocabulary.contexts[before] + PRIOR)[mixed]
            score = np.bincount(place[mixed], np.log10(PRIOR * weight / context), n)
            at = np.minimum(np.searchsorted(hot_pairs, pairs), max(len(hot_pairs) - 1, 0))
            local = hot_pairs[at] == pairs if len(hot_pairs) else np.zeros(len(pairs), bool)
            if local.any():
                score += np.bincount(place[local], hot_logs[at[local]], n)
            rows = [(0, 0, np.array([-1 if g[0] is None else g[0] for g in group], "<i8").tobytes() + np.array([[len(g[2]) + 1, g[1], g[0] is None] for g in group], "<i8").T.tobytes(), known.astype("<i8").tobytes(), np.stack([base, score]).astype("<f8").tobytes())]
            cold = ~local & ~mixed
            cold, times = np.unique((pairs[cold].astype(np.uint64) << np.uint64(32)) | place[cold].astype(np.uint64), return_counts=True)
            cold, texts = (cold >> np.uint64(32)).astype(np.int64), cold.astype(np.uint32)
            for s, q, t, m in _by_shard(shard_of(cold, shards), cold, texts, times):
                rows.append((1, s, q.astype("<u4").tobytes(), t.astype("<u2").tobytes(), m.astype("<u4").tobytes()))
            hashes = np.zeros(len(ids), np.uint64)
            hashes[ids != END] = np.concatenate([g[2] for g in group])
            at = np.flatnonzero(rare)
            if len(at):
                left = np.where(before[at] == OTHER, hashes[at - 1] | RARE, before[at].astype(np.uint64))
                words, right = hashes[at] | RARE, (place[at] << 16) | ids[at + 1]
                order = np.lexsort((left, right, words))
                words, left, right = words[order], left[order], right[order]
                first = np.flatnonzero(np.concatenate([[True], (words[1:] != words[:-1]) | (left[1:] != left[:-1]) | (right[1:] != right[:-1])]))
                times = np.diff(np.concatenate([first, [len(words)]]))
                words, left, right = words[first], left[first], right[first]
                for s, w, t, m in _by_shard(shard_of(words, other_shards), np.stack([words, left], axis=1), right >> 16, np.stack([times, right & 0xFFFF], axis=1)):
                    rows.append((2, s, w.astype("<u8").tobytes(), t.astype("<u2").tobytes(), m.astype("<u4").tobytes()))
            for i in range(0, len(rows), 256):
                part = rows[i : i + 256]
                size = len(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in part], pa.int32()), pa.array([r[1] for r in part], pa.int64()), pa.array([task + number] * size, pa.int64()), pa.array([trained] * size, pa.int64()), *(pa.array([r[k] for r in part], pa.binary()) for k in (2, 3, 4))],
                    names=["kind", "shard", "part", "trained", "a", "b", "c"],
                )

    return run


ANSWERS = "part long, texts binary, known binary, base binary, score binary"


def _answers(parts, texts, known, base, score) -> pd.DataFrame:
    """Sums for each text, a row for each part."""
    key = (parts << 24) | texts
    found, inverse = np.unique(key, return_inverse=True)
    sums = [np.bincount(inverse, x, len(found)) if x is not None else np.zeros(len(found)) for x in (known, base, score)]
    number, start = np.unique(found >> 24, return_index=True)
    cut = [slice(a, b) for a, b in zip(start, [*start[1:], len(found)])]
    return pd.DataFrame({
        "number": number, "texts": [(found[c] & 0xFFFFFF).astype("<u4").tobytes() for c in cut],
        **{name: [x[c].astype("<f8").tobytes() for c in cut] for name, x in zip(("known", "base", "score"), sums)},
    })


def _spread(frame: pd.DataFrame, kind: str):
    """The arrays of all query rows of a shard; parts as positions in the list of parts."""
    sizes = np.array([len(x) // 2 for x in frame["b"]])
    names, number = np.unique(frame["part"].to_numpy(), return_inverse=True)
    trained = np.repeat(frame["trained"].to_numpy(), sizes)
    texts = _numbers(frame["b"], "<u2").astype(np.int64)
    return names, np.repeat(number, sizes), _numbers(frame["a"], kind), texts, _numbers(frame["c"], "<u4").astype(np.float64), texts < trained


def _named(names, answers: pd.DataFrame) -> pd.DataFrame:
    answers["part"] = names[answers.pop("number").to_numpy()]
    return answers[["part", "texts", "known", "base", "score"]]


def _mapped(trie: bytes, pairs: np.ndarray) -> np.ndarray:
    """The steps of pairs in a trie that is memory-mapped."""
    with tempfile.TemporaryFile() as file:
        file.write(trie)
        file.flush()
        return Trie(np.memmap(file, np.uint8, "r")).find(pairs)


def _answer_pairs(shared):
    def run(key, frame: pd.DataFrame, tries: pd.DataFrame) -> pd.DataFrame:
        if not len(frame):
            return pd.DataFrame({"part": pd.Series(dtype="int64"), **{c: pd.Series(dtype="object") for c in ("texts", "known", "base", "score")}})
        names, parts, pairs, texts, times, _ = _spread(frame, "<u4")
        wanted, inverse = np.unique(pairs, return_inverse=True)
        wanted = wanted.astype(np.int64)
        logs = shared.value.log(wanted, 0.0)
        if len(tries):
            steps = _mapped(tries["trie"].iloc[0], wanted)
            logs = np.where(steps >= 0, -steps * STEP, logs)
        return _named(names, _answers(parts, texts, None, None, times * logs[inverse]))

    return run


def _answer_words(shared):
    """Rare words of a shard: ids of their own here, counts and a trie from the training texts' queries.

    The trie holds what a pair's count adds to the logarithm of its weighted unigram.
    """

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        vocabulary = shared.value
        names, parts, keys, texts, rest, trained = _spread(frame, "<u8")
        times, after = rest[::2], rest[1::2].astype(np.int64)
        known = 1 << 16
        rare = np.unique(keys[keys >= RARE])
        ids = np.where(keys >= RARE, known + np.searchsorted(rare, keys), (keys & ~RARE).astype(np.int64))
        word, before = ids[::2], ids[1::2]
        counts = np.bincount(word - known, times * trained, len(rare))
        # The pair that a word ends, and the one that it begins; a pair of two rare words is the second one's.
        begins = after != OTHER
        pairs = np.concatenate([(before << 32) | word, ((word << 32) | after)[begins]])
        wanted, inverse = np.unique(pairs, return_inverse=True)
        seen = np.bincount(inverse, np.concatenate([times * trained, (times * trained)[begins]]), len(wanted))
        second = wanted & 0xFFFF_FFFF
        unigram = np.empty(len(wanted))
        own = second >= known
        unigram[own] = (counts[second[own] - known] + 1) / vocabulary.total
        unigram[~own] = vocabulary.unigram[second[~own]]
        gain = np.clip(np.rint(np.log10(1 + seen / (PRIOR * unigram)) / STEP), 0, 65_535).astype(np.int64)
        held = seen > 0
        steps = _mapped(Trie.encode(wanted[held], gain[held], 32), wanted)
        gains = (np.maximum(steps, 0) * STEP)[inverse]
        count = counts[word - known]
        base = np.log10(count + 1)
        score = base - np.log10(count + PRIOR) + gains[: len(word)]
        score[begins] += gains[len(word) :]
        return _named(names, _answers(parts, texts, times * (count > 0), times * base, times * score))

    return run


def _gather(frame: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    row = frame.iloc[0]
    n = len(row["b"]) // 8
    docs, tokens, out, null = _numbers([row["a"]], "<i8").reshape(4, n)
    known = _numbers([row["b"]], "<i8").astype(np.float64)
    base, score = _numbers([row["c"]], "<f8").reshape(2, n).copy()
    if len(answers):
        texts = _numbers(answers["texts"], "<u4")
        known += np.bincount(texts, _numbers(answers["known"], "<f8"), n)
        base += np.bincount(texts, _numbers(answers["base"], "<f8"), n)
        score += np.bincount(texts, _numbers(answers["score"], "<f8"), n)
    ids = pd.Series(docs).astype("Int64").where(null == 0)
    return pd.DataFrame({"doc_id": ids, "held_out": out > 0, "n_tokens": tokens, "n_known": np.rint(known).astype(np.int64), "base_score": base, "score": score})


def score_texts(docs: DataFrame, modulus: int = 7, out: int = 2) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from rows whose crc32(doc_id as text) modulo ``modulus`` is not ``out``. The model is a bigram with a
    Dirichlet prior: (count of the pair + PRIOR * unigram) / (count of the context + PRIOR), where the unigram is the
    add-one one of the base score. All training words and pairs count, however rare.

    Pairs of the VOCABULARY most frequent words have 16-bit ids and are dealt to shards by a hash; each shard is a trie
    of its own, stored with quantised probabilities, memory-mapped by the task that answers the shard's queries.
    Every other word belongs to a shard by its hash and has an id there; that shard's trie holds the pairs the word
    ends and those it begins, unless another rare word ends them. Such a word is less frequent than all with ids, so
    none is hot. Queries are sums for each text and pair, dealt in packed arrays. The most frequent pairs, at most
    HOT, are known to every worker with the same probabilities, so that no pair is hot in a shard. Shards follow the
    number of tokens, so their size does not grow. Words are told apart by 64-bit hashes, rare ones by 63 bits.

    NULL texts count as empty: the end alone. Without training texts the base score is 0. Repeated rows each count
    and are scored each; a NULL doc_id counts as empty text in the remainder; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (id_remainder("doc_id", modulus) == out).alias("held_out"), text_bytes().alias("text"))
    train = rows.where("NOT held_out")
    words = materialise(train.mapInArrow(_count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    n_docs, (types, tokens) = train.select("doc_id").count(), words.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    top = words.orderBy(F.desc("n"), "word").limit(VOCABULARY - FIRST).toPandas()
    vocabulary = Vocabulary(top["word"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64), n_docs, tokens + n_docs, types + (n_docs > 0))
    shared = spark.sparkContext.broadcast(vocabulary)
    shards = -(-vocabulary.tokens // SHARD) + 1
    # A rare word brings two pairs and their ids, so its shards hold fewer tokens.
    other_shards = -(-4 * int(vocabulary.counts[OTHER]) // SHARD) + shards // 8 + 1

    pairs = train.mapInArrow(_count_pairs(shared, shards), "shard long, pairs binary, counts binary")
    schema = "shard long, trie binary, sizes array<long>, often binary, often_counts binary, often_steps binary"
    tries = materialise(pairs.groupBy("shard").applyInPandas(_build(shared), schema), "tries")
    sizes = tries.select(F.posexplode("sizes").alias("power", "n")).groupBy("power").agg(F.sum("n").alias("n")).collect()
    power, above = 63, 0
    held = {r["power"]: r["n"] for r in sizes}
    while power > 0 and 2**power > LEAST_HOT and above + held.get(power, 0) <= HOT:
        above += held.get(power, 0)
        power -= 1
    least = 2 ** (power + 1)
    found = tries.select("often", "often_counts", "often_steps").mapInPandas(_often(least), "pairs binary, steps binary").collect()
    hot_pairs, hot_steps = _numbers([r[0] for r in found], "<u4").astype(np.int64), _numbers([r[1] for r in found], "<u2")
    order = np.argsort(hot_pairs)
    hot = spark.sparkContext.broadcast((hot_pairs[order], hot_steps[order] * -STEP))

    asked = materialise(rows.mapInArrow(_ask(shared, hot, shards, other_shards), QUERIES), "queries", "zstd")
    one = asked.where("kind = 1").groupBy("shard").cogroup(tries.select("shard", "trie").groupBy("shard")).applyInPandas(_answer_pairs(shared), ANSWERS)
    two = asked.where("kind = 2").groupBy("shard").applyInPandas(_answer_words(shared), ANSWERS)
    texts = asked.where("kind = 0").select("part", "a", "b", "c")
    scored = texts.groupBy("part").cogroup(one.union(two).groupBy("part"))
    result = scored.applyInPandas(_gather, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return result.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(vocabulary.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def _often(least: int):
    def run(frames):
        for frame in frames:
            out = []
            for pairs, counts, steps in zip(frame["often"], frame["often_counts"], frame["often_steps"]):
                keep = _numbers([counts], "<i8") >= least
                out.append((_numbers([pairs], "<u4")[keep].tobytes(), _numbers([steps], "<u2")[keep].tobytes()))
            yield pd.DataFrame(out, columns=["pairs", "steps"])

    return run
