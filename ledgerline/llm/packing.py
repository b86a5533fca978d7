"""Best-fit packing of token sequences by partitions, with the underfull bins merged in a tree."""

from __future__ import annotations

import re
import zlib
from struct import pack

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Generations, frugal, materialise, worker_cache
from ledgerline.llm.tokens import LONGEST, WORDS, grouped, tokenizer

#: A bin with at most this share of room left is emitted; one task of a later round packs about POOL bins.
NEARLY_FULL, POOL = 0.005, 20_000
#: Pieces of a Latin-1 text in lower case, split as the tokenizer of lower-case words does (fixed values).
LATIN = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^\\t-\\r \x85\xa0a-zªµºß-öø-ÿ0-9²³¹¼½¾]+")
CACHED = 400_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, place long"


class BestFit:
    """Bins of one capacity; an item goes to the fullest bin that has room, or to a new one."""

    def __init__(self, capacity: int):
        self.capacity, self.rooms, self.free = capacity, 0, [[] for _ in range(capacity + 1)]

    def put(self, size: int, new) -> tuple[object, int]:
        """The bin and the place in it; ``new()`` names a new bin."""
        fit = self.rooms >> size
        if fit:
            room = size + (fit & -fit).bit_length() - 1
            bin_ = self.free[room].pop()
            if not self.free[room]:
                self.rooms &= ~(1 << room)
        else:
            room, bin_ = self.capacity, new()
        left = room - size
        if left:
            self.free[left].append(bin_)
            self.rooms |= 1 << left
        return bin_, self.capacity - room


def _ids(path: str):
    """Ids of whole words, by the tokenizer as it is."""

    def find(words: list[str]) -> list[bytes]:
        return [pack(f"<{len(e.ids)}I", *e.ids) for e in tokenizer(path).encode_batch_fast(words, add_special_tokens=False)]

    return find


def _piece_ids(path: str):
    """Ids of pieces of LATIN: what is left of the tokenizer's work is its byte alphabet and its merges."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (b for b in range(256) if b not in plain)
    signs = {b: 256 + k for k, b in enumerate(rest)}

    def find(pieces: list[str]) -> list[bytes]:
        merge, out = tokenizer(path).model.tokenize, []
        for piece in pieces:
            ids = [t.id for t in merge(piece if piece.isascii() and piece.isprintable() else piece.encode().decode("latin-1").translate(signs))]
            out.append(pack(f"<{len(ids)}I", *ids))
        return out

    return find


def latin(text: str) -> str | None:
    """The text in lower case if it is plain Latin-1 without special strings, else None."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return None
    return None if "<|" in text else text.lower()


def _caches(path: str) -> tuple[Generations, Generations]:
    return worker_cache(("ids", path), lambda: (Generations(_ids(path), CACHED // 4), Generations(_piece_ids(path), CACHED)))


def encoded(texts: list[str], path: str) -> list[bytes]:
    """The ids of each text as little-endian 32-bit numbers, for a tokenizer that drops blanks between words."""
    out = []
    for group in grouped(texts):
        words, low = [], [latin(t) for t in group]
        for cache, found in zip(_caches(path), ((WORDS.findall(t) if x is None else () for t, x in zip(group, low)), (LATIN.findall(x or "") for x in low))):
            split = list(found)
            cache.fill([w for ws in split for w in ws if len(w) <= LONGEST])
            words.append([b"".join(map(cache.__getitem__, ws)) if max(map(len, ws), default=0) <= LONGEST else b"".join(cache[w] if len(w) <= LONGEST else cache.find([w])[0] for w in ws) for ws in split])
        out += [a or b for a, b in zip(*words)]
    return out


def _local(path: str, capacity: int, separator: int):
    end = separator.to_bytes(4, "little")

    def run(batches):
        task, made, bins = TaskContext.get().partitionId() << 40, 0, BestFit(capacity)

        def new():
            nonlocal made
            made += 1
            return task + made

        for batch in batches:
            rows = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encoded(batch.column("text").to_pylist(), path)):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
            rows.sort(key=lambda r: -r[3])
            rows = [(*r, *bins.put(r[3], new)) for r in rows]
            yield pa.RecordBatch.from_pandas(pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "bin", "place"]).astype({"piece": "int32"}), schema=SCHEMA, preserve_index=False)

    return run


SCHEMA = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("bin", pa.int64()), ("place", pa.int64())])


def _pool(capacity: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["fill", "bin"], ascending=[False, True], kind="stable")
        bins, out = BestFit(capacity), []
        for bin_, fill in zip(frame["bin"].tolist(), frame["fill"].tolist()):
            out.append((bin_, fill, *bins.put(fill, lambda: bin_)))
        return pd.DataFrame(out, columns=["bin", "fill", "into", "shift"])

    return run


def best_fit(docs: DataFrame, path: str, capacity: int = 2048, separator: int = 0) -> DataFrame:
    """Pack the ids of every text, each followed by ``separator``, into sequences of at most ``capacity`` ids.

    Returns one row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Only a longer
    document is cut, into pieces of the capacity and a rest. Each partition packs its pieces best-fit, longest first
    within a batch. Bins that are nearly full are final; the others are items of the next round, dealt by a hash to
    pools of a bounded number of bins, until a round saves less than one bin in a hundred or one pool held all.

    NULL and empty texts are the separator alone. Repeated rows are packed each; a NULL doc_id stays NULL. An empty
    table gives no row. Other columns are ignored. The tokenizer is one of lower-case words, whose own split does not
    reach across blanks: texts in Latin-1 are split into its pieces here, other texts at blanks.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    pieces = materialise(docs.mapInArrow(frugal(_local(path, capacity, separator)), PIECES), "pieces")
    bins = pieces.groupBy("bin").agg(F.sum("length").alias("fill"))
    room = F.lit(capacity) - F.col("fill") > int(NEARLY_FULL * capacity)
    placed = materialise(bins.select("bin", F.col("bin").alias("sequence_id"), F.lit(0).cast("long").alias("shift"), "fill"), "bins")
    whole = placed.where(~room)
    open_ = placed.where(room)
    count, turn = open_.count(), 0
    while count:
        turn += 1
        pools = -(-count // POOL)
        items = open_.groupBy(F.col("sequence_id").alias("bin"), "fill").count().drop("count")
        dealt = items.withColumn("pool", F.pmod(F.xxhash64("bin", F.lit(turn)), F.lit(pools)))
        moved = dealt.groupBy("pool").applyInPandas(_pool(capacity), "bin long, fill long, into long, shift long")
        moved = materialise(moved, "moved")
        sums = moved.groupBy("into").agg(F.sum("fill").alias("fill"))
        steps = moved.select(F.col("bin").alias("sequence_id"), "into", F.col("shift").alias("more")).join(sums, "into")
        open_ = open_.drop("fill").join(steps, "sequence_id")
        open_ = materialise(open_.select("bin", F.col("into").alias("sequence_id"), (F.col("shift") + F.col("more")).alias("shift"), "fill"), "bins")
        left = sums.count()
        if pools == 1 or left > 0.99 * moved.count():
            whole = whole.union(open_)
            break
        whole = whole.union(open_.where(~room))
        open_ = open_.where(room)
        count = open_.select("sequence_id").distinct().count()
    out = pieces.join(whole.drop("fill"), "bin")
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", (F.col("place") + F.col("shift")).alias("offset"))
