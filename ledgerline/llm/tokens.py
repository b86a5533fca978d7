"""Token counts by table lookup: a broadcast table of frequent pieces, worker caches for the others."""

from __future__ import annotations

import os
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Generations, worker_cache

#: The characters with the Unicode property White_Space.
SPACE = "\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Pieces that a byte-level tokenizer never joins: a word with at most one blank before it, or blanks. Its own, finer
#: pieces lie inside these, so that lengths add up.
PIECE = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
WORDS = re.compile(f"[^{SPACE}]+")
#: Entries of the broadcast table, of one task's summary, and of one generation of a worker's cache.
FREQUENT, SUMMARY, CACHED = 65_536, 131_072, 150_000
#: Characters of text that are looked up together, and of a piece that is worth a cache entry.
GROUP, LONGEST = 1_000_000, 48


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The tokenizer of a file of the tokenizers library, one thread, once in each worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


@lru_cache(maxsize=4)
def special_strings(path: str) -> re.Pattern | None:
    """What the tokenizer takes out of a text before anything else."""
    words = [t.content for t in tokenizer(path).get_added_tokens_decoder().values()]
    return re.compile("|".join(map(re.escape, sorted(words, key=len, reverse=True)))) if words else None


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def lengths(path: str, pieces: list[str]) -> list[int]:
    return [len(e.ids) for e in tokenizer(path).encode_batch_fast(pieces, add_special_tokens=False)]


def grouped(texts: list[str]):
    """Runs of texts of about GROUP characters; a longer text stands alone and whole."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= GROUP:
            yield held
            held, size = [], 0
    if held:
        yield held


def _merge(a: dict, b: dict, limit: int) -> dict:
    """Misra-Gries merge: the sum, cut to ``limit`` entries by taking the next count off all."""
    small, large = sorted((a, b), key=len)
    out = dict(large)
    for k, v in small.items():
        out[k] = out.get(k, 0) + v
    if len(out) > limit:
        cut = sorted(out.values(), reverse=True)[limit]
        out = {k: v - cut for k, v in out.items() if v > cut}
    return out


def _summary(batches):
    from collections import Counter

    held: dict = {}
    for batch in batches:
        for texts in grouped(batch.column("text").to_pylist()):
            counts: Counter = Counter()
            for text in texts:
                counts.update(PIECE.findall(text))
            held = _merge(held, {k: v for k, v in counts.items() if len(k) <= LONGEST}, SUMMARY)
    import pickle

    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(held)], pa.binary())], names=["summary"])


def frequent_pieces(docs: DataFrame) -> list[str]:
    """The most frequent pieces over all texts, by bounded summaries that are merged in a tree; no piece is shuffled."""
    import pickle

    rows = docs.select("text").mapInArrow(_summary, "summary binary").rdd.map(lambda r: pickle.loads(r[0]))
    merged = rows.treeAggregate({}, lambda a, b: _merge(a, b, SUMMARY), lambda a, b: _merge(a, b, SUMMARY), depth=3)
    return sorted(merged, key=lambda k: (-merged[k], k))[:FREQUENT]


def _counter(path: str, shared):
    def run(batches):
        table = shared.value
        cache = worker_cache(("lengths", path), lambda: Generations(lambda pieces: lengths(path, pieces), CACHED))
        special = special_strings(path)
        for batch in batches:
            counts = []
            for texts in grouped(batch.column("text").to_pylist()):
                found, missed = [], []
                for text in texts:
                    parts, extra = [text], 0
                    if special is not None and special.search(text):
                        parts, extra = special.split(text), len(special.findall(text))
                    pieces = [p for part in parts for p in PIECE.findall(part)]
                    known = list(map(table.get, pieces))
                    misses = [p for p, n in zip(pieces, known) if n is None]
                    found.append(extra + sum(filter(None, known)))
                    missed.append(misses)
                long = [[p for p in m if len(p) > LONGEST] for m in missed]
                short = [[p for p in m if len(p) <= LONGEST] for m in missed]
                cache.fill([p for m in short for p in m])
                for n, few, many in zip(found, long, short):
                    counts.append(n + sum(map(cache.__getitem__, many)) + (sum(lengths(path, few)) if few else 0))
            sizes = [len(t.encode()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    Lengths are those of the tokenizer in the file ``path`` without added special tokens; special strings inside a
    text are special tokens, as is its default. A first pass finds frequent pieces; a table of their lengths, at most
    FREQUENT entries, is broadcast. The table changes speed only: a piece outside it is encoded and kept in the
    worker's cache, which holds two generations of CACHED entries. NULL and empty texts have 0 bytes and 0 tokens.
    Texts of any length are counted whole. Repeated rows and NULL ids stay as they are; other columns are ignored.
    """
    docs = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    pieces = frequent_pieces(docs)
    shared = docs.sparkSession.sparkContext.broadcast(dict(zip(pieces, lengths(path, pieces))) if pieces else {})
    counted = docs.mapInArrow(_counter(path, shared), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
