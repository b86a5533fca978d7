"""What the operators share: reading, written intermediate tables, hashing, bounded caches."""

from __future__ import annotations

import ctypes
import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import work_root

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def materialise(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """Write a frame below the shared checkpoint folder and read it back: cuts lineage, survives lost executors."""
    path = work_root(df.sparkSession, label)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_remainder(column: str, modulus: int):
    """crc32 of an id as text, modulo; NULL ids count as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def text_bytes(column: str = "text"):
    """UTF-8 bytes of a text, empty where it is NULL."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text, A-Z in lower case.

    bytes.lower() changes ASCII letters only, and bytes.split() parts at space and 0x09-0x0D only.
    """
    words = text.lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_groups(batch, column: str, size: int = 2_000_000):
    """Slices of a batch of about ``size`` bytes of a text column; a longer text stands alone and whole."""
    total = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start, done = 0, 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(total, done + size, side="right")))
        yield batch.slice(start, end - start)
        start, done = end, int(total[end - 1])


_held: dict[tuple, object] = {}


def worker_cache(key: tuple, make):
    """What a worker process keeps from one task to the next: the thing of this key alone.

    Workers outlive their stage, so a task of another kind drops it, as ``worker_cache(None, None)`` does.
    """
    if key not in _held:
        _held.clear()
        if key is not None:
            _held[key] = make()
    return _held.get(key)


def give_back() -> None:
    """Return what Arrow and the C library hold free to the system, where the platform can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def frugal(work):
    """``work`` (batches to batches) that gives freed memory back at the end of its partition.

    Spark keeps idle workers for a minute; without this they hold their largest size beside those of the next stage.
    """

    @functools.wraps(work)
    def run(batches):
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


class Generations(dict):
    """A map that fills itself through ``find(keys)`` and holds at most two generations of ``limit`` entries."""

    def __init__(self, find, limit: int):
        super().__init__()
        self.find, self.limit, self.old = find, limit, {}

    def fill(self, keys) -> None:
        """Make sure that all keys of this call are there; the call's own keys are never dropped during it."""
        missing = [k for k in set(keys) if k not in self]
        if len(self) + len(missing) > self.limit:
            self.old = dict(self)
            self.clear()
            missing = list(set(keys))
        kept = [k for k in missing if k in self.old]
        self.update((k, self.old[k]) for k in kept)
        new = [k for k in missing if k not in self]
        if new:
            self.update(zip(new, self.find(new)))
