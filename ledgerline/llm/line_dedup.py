"""Line de-duplication by pairwise alignment: patience diff between overlapping documents."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ledgerline.llm.common import frugal, materialise

#: Words of a line that alone brings two documents together, and of an aligned block that is deleted.
ANCHOR_WORDS, BLOCK_WORDS = 3, 25


def _lines(batches):
    for batch in batches:
        hashes, sizes = [], []
        for text in batch.column("text").to_pylist():
            words = [line.split() for line in text.split(b"\n")]
            hashes.append(np.fromiter((xxhash.xxh3_64_intdigest(b" ".join(w)) if w else 0 for w in words), np.uint64, len(words)).tobytes())
            sizes.append(np.fromiter(map(len, words), np.int32, len(words)).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("own"), pa.array(hashes, pa.binary()), pa.array(sizes, pa.binary())], names=["doc_id", "own", "lines", "words"])


def runs(lines: np.ndarray, words: np.ndarray, least: int) -> list[int]:
    """Hashes of the shortest runs of two or more non-blank lines that reach ``least`` words, from each line on and up to each line.

    Every line of a block of ``least`` words lies in such a run within the block: in the one that starts at the line
    or, if the rest of the block is too short for that, in the one that ends with the block.
    """
    lines, words = lines[words > 0], words[words > 0]
    total = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
    n = np.arange(len(total))
    end = np.searchsorted(total, total + least)
    start = np.searchsorted(total, total - least, side="right") - 1
    forward, backward = end < len(total), start >= 0
    spans = {*zip(n[forward].tolist(), end[forward].tolist()), *zip(start[backward].tolist(), n[backward].tolist())}
    raw = lines.tobytes()
    return [xxhash.xxh3_64_intdigest(raw[8 * a : 8 * b]) for a, b in spans if b - a > 1]


def _anchors(least: int):
    """(line, doc_id) for the distinct lines and runs of lines of a document that are long enough to stand for an overlap."""

    def run(batches):
        for batch in batches:
            held, docs = [], []
            for doc, lines, words in zip(batch.column("doc_id").to_pylist(), batch.column("lines").to_pylist(), batch.column("words").to_pylist()):
                lines, words = np.frombuffer(lines, np.uint64), np.frombuffer(words, np.int32)
                # A line that is a block by itself is a key whatever its number of words.
                found = np.unique(np.concatenate([lines[words >= min(ANCHOR_WORDS, max(least, 1))], np.array(runs(lines, words, least), np.uint64)]))
                held.append(found)
                docs.append(np.full(len(found), doc, np.int64))
            lines, ids = (np.concatenate(x) if x else np.zeros(0) for x in (held, docs))
            for i in range(0, len(lines), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(lines[i : i + 100_000].view(np.int64)), pa.array(ids[i : i + 100_000])], names=["line", "doc_id"])

    return run


def rising(values: list[int]) -> list[int]:
    """Indices of a longest rising subsequence."""
    tops, at, back = [], [], [0] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        if k == len(tops):
            tops.append(v)
            at.append(i)
        else:
            tops[k], at[k] = v, i
        back[i] = at[k - 1] if k else -1
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned positions of two sequences: equal ends first, then lines that stand once in either, then between them.

    Where no line stands once in both, the k-th of one is set beside the k-th of the other.
    """
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, i_end, j, j_end = todo.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            out.append((i_end, j_end))
        if i == i_end or j == j_end:
            continue
        left, right = Counter(a[i:i_end]), Counter(b[j:j_end])
        common = left.keys() & right.keys()
        if not common:
            continue
        if once := {x for x in common if left[x] == 1 and right[x] == 1}:
            at = {x: k for k, x in enumerate(a[i:i_end], i) if x in once}
            pairs = [(at[x], k) for k, x in enumerate(b[j:j_end], j) if x in once]
        else:
            seen: Counter = Counter()
            at = {}
            for k, x in enumerate(a[i:i_end], i):
                if x in common:
                    at[x, seen[x]] = k
                    seen[x] += 1
            seen.clear()
            pairs = []
            for k, x in enumerate(b[j:j_end], j):
                if x in common:
                    if (x, seen[x]) in at:
                        pairs.append((at[x, seen[x]], k))
                    seen[x] += 1
        chain = [pairs[k] for k in rising([p[0] for p in pairs])]
        for p, q in chain:
            todo.append((i, p, j, q))
            out.append((p, q))
            i, j = p + 1, q + 1
        todo.append((i, i_end, j, j_end))
    return sorted(out)


def common_lines(a: list[int], b: list[int], words: list[int], least: int) -> list[int]:
    """Positions in ``b`` of blocks, of at least ``least`` words, that an alignment with ``a`` has in common.

    Aligned again without them until no block is left, so that moved and repeated blocks are found too. Blank lines
    (0) neither make nor break a block.
    """
    at = [i for i, x in enumerate(a) if x]
    left = [a[i] for i in at]
    rest, cut = [j for j, x in enumerate(b) if x], []
    while rest:
        found: list[int] = []
        run: list[int] = []
        last = None
        for i, j in [*patience(left, [b[j] for j in rest]), (None, None)]:
            if last is not None and i is not None and (i, j) == (last[0] + 1, last[1] + 1):
                run.append(j)
            else:
                if sum(words[rest[k]] for k in run) >= least:
                    found += run
                run = [j] if j is not None else []
            last = (i, j) if i is not None else None
        if not found:
            break
        cut += [rest[j] for j in found]
        gone = set(found)
        rest = [x for j, x in enumerate(rest) if j not in gone]
    return sorted(cut)


def _align(least: int):
    def run(batches):
        for batch in batches:
            cuts = []
            for a, b, w in zip(*(batch.column(c).to_pylist() for c in ("first_lines", "lines", "words"))):
                cut = common_lines(np.frombuffer(a, np.uint64).tolist(), np.frombuffer(b, np.uint64).tolist(), np.frombuffer(w, np.int32).tolist(), least)
                cuts.append(np.array(cut, np.int32).tobytes())
            out = pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("own"), pa.array(cuts, pa.binary())], names=["doc_id", "own", "cut"])
            yield out.filter(pa.array([len(c) > 0 for c in cuts], pa.bool_()))

    return run


def _delete(names: list[str]):
    def run(batches):
        for batch in batches:
            texts, lines, gone, words = [], [], [], []
            for text, cuts in zip(batch.column(names.index("text")).to_pylist(), batch.column(len(names)).to_pylist()):
                parts = (text or "").split("\n")
                cut = sorted(set(np.frombuffer(b"".join(cuts), np.int32).tolist())) if cuts else []
                lines.append(len(parts) if text is not None else 0)
                gone.append(len(cut))
                words.append(sum(len(parts[i].encode().split()) for i in cut))
                if cut:
                    drop = set(cut)
                    text = "\n".join(p for i, p in enumerate(parts) if i not in drop)
                texts.append(text)
            arrays = [pa.array(texts, pa.string()) if c == "text" else batch.column(i) for i, c in enumerate(names)]
            counts = [pa.array(x, pa.int64()) for x in (lines, gone, words)]
            yield pa.RecordBatch.from_arrays([*arrays, *counts], names=[f"c{i}" for i in range(len(names) + 3)])

    return run


def dedup_lines(docs: DataFrame, least: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` (doc_id, text; others are carried) with n_lines, lines_cut, words_cut and the text left.

    Two documents overlap if they share a line of at least ANCHOR_WORDS words, or a shortest run of non-blank lines
    that reaches ``least`` words, from a line on or up to it. Each shared line or run pairs every document that holds
    it with the first one (smallest doc_id), so that a frequent one makes no more pairs than rows and needs no rarity
    limit; and each line of a block that an earlier document holds lies in a run whose first holder is aligned. Each
    pair is aligned by patience diff on line hashes, blanks within a line made equal; blocks of at least ``least``
    words that the alignment has in common are deleted from the later document.

    A document is never compared with itself, nor are rows of one doc_id with one another. NULL texts stay NULL and
    empty ones empty; a text that is cut whole becomes empty. Rows without a doc_id stay as they are. Repeated rows
    are cut alike, an empty table gives none.
    """
    key = F.xxhash64("text").alias("own")
    rows = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"), key)
    rows = materialise(rows.mapInArrow(frugal(_lines), "doc_id long, own long, lines binary, words binary"), "lines")
    anchors = rows.select("doc_id", "lines", "words").mapInArrow(frugal(_anchors(least)), "line long, doc_id long")
    firsts = anchors.groupBy("line").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("line", "first")
    # Written, so that the join deals both sides itself and can split a frequent line.
    firsts = materialise(firsts, "firsts")
    pairs = anchors.join(firsts, "line").where("doc_id > first").select("first", "doc_id").distinct()
    first = rows.select(F.col("doc_id").alias("first"), F.col("lines").alias("first_lines"))
    met = pairs.join(rows, "doc_id").join(first, "first").select("doc_id", "own", "lines", "words", "first_lines")
    cuts = met.mapInArrow(frugal(_align(least)), "doc_id long, own long, cut binary").groupBy("doc_id", "own").agg(F.collect_list("cut").alias("cuts"))
    cuts = materialise(cuts, "cuts")
    carried = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    doc, text = (f"c{docs.columns.index(c)}" for c in ("doc_id", "text"))
    carried = carried.withColumn("own", F.xxhash64(text)).withColumn("doc_id", F.col(doc).cast("long"))
    # One plan at every size: the cuts grow with the documents, so they are never broadcast.
    joined = carried.join(cuts.hint("merge"), ["doc_id", "own"], "left").select(*[f"c{i}" for i in range(len(docs.columns))], "cuts")
    fields = [StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema.fields)]
    counts = [StructField(f"c{len(fields) + i}", LongType()) for i in range(3)]
    return joined.mapInArrow(frugal(_delete(docs.columns)), StructType(fields + counts)).toDF(*docs.columns, "n_lines", "lines_cut", "words_cut")
