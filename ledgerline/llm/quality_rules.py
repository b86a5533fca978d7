"""Quality rules by distribution divergence, in DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import materialise

#: Character classes, each counted in what the classes before it have left of the text.
CLASSES = {
    "small": r"[\p{Ll}\p{Lo}\p{Lm}\p{M}]+",
    "blank": r"[\s\x{85}\p{Z}]+",
    "capital": r"[\p{Lu}\p{Lt}]+",
    "stop": r"""[.,;:!?'"()\-]+""",
    "digit": r"\p{N}+",
    "symbol": r"[#*$%&|<>]+",
}
#: Common words have at most so many letters; so many of a language are compared.
COMMON_LETTERS, COMMON = 5, 24
#: Farthest Jensen-Shannon distances (0 to 1) that are kept, and what a text needs to be judged by them. The distance
#: of n words drawn from the reference itself is about sqrt(COMMON / (8 ln 2 n)); FAR_WORDS comes on top of that.
FAR_CHARS, FAR_WORDS = 0.30, 0.15
LEAST_CHARS, LEAST_WORDS = 200, 80
#: Windows that are looked up in a list of repeated ones; with more of them, positions are sorted instead.
LOOKED_UP = 64


def _lag(column: str, i: Column, by: int) -> Column:
    return F.get(F.col(column), i + by)


def measures(rows: DataFrame) -> DataFrame:
    """``rows`` (text, not NULL) with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words.

    Windows of three words are compared by their 64-bit hash.
    """
    # Split at one plain character, which takes no regular expression.
    plain = F.col("text")
    for blank in "\t\n\u000b\f\r":
        plain = F.replace(plain, F.lit(blank), F.lit(" "))
    rows = rows.withColumn("words", F.array_remove(F.split(plain, " "), ""))
    rows = rows.withColumn("n_words", F.size("words").cast("long"))
    rows = rows.withColumn("word_chars", F.length(F.array_join("words", "")).cast("long"))
    bare = F.col("text")
    for symbol in "#*$%&|<>":
        bare = F.replace(bare, F.lit(symbol), F.lit(""))
    # Symbols are one byte each.
    rows = rows.withColumn("n_symbols", (F.octet_length("text") - F.octet_length(bare)).cast("long"))
    rows = rows.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: F.length(F.trim(x, F.lit(" \t\n\u000b\f\r"))) > 0))
    rows = rows.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")).drop("lines")
    hashed = F.transform("words", lambda w, i: F.xxhash64(w, _lag("words", i, 1), _lag("words", i, 2)))
    rows = rows.withColumn("windows", F.when(F.col("n_words") >= 3, F.slice(hashed, F.lit(1), F.greatest(F.lit(0), F.size("words") - 2))).otherwise(F.array().cast("array<bigint>")))
    rows = rows.withColumn("ordered", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.sort_array("windows")))
    rows = rows.withColumn("twice", F.array_distinct(F.filter("ordered", lambda x, i: _lag("ordered", i, -1) == x)))
    many = F.size("twice") > LOOKED_UP
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("placed", F.when(many, placed))
    beside = lambda x, i, by: F.coalesce(_lag("placed", i, by)["h"] == x["h"], F.lit(False))
    repeated = F.filter("placed", lambda x, i: beside(x, i, -1) | beside(x, i, 1))
    sorted_ = F.sort_array(F.transform(repeated, lambda x: x["i"]))
    listed = F.filter(F.transform("windows", lambda h, i: F.when(F.array_contains(F.col("twice"), h), i)), lambda p: p.isNotNull())
    rows = rows.withColumn("at", F.when(F.col("twice").isNull(), F.array().cast("array<int>")).when(many, sorted_).otherwise(listed))
    covered = F.transform("at", lambda p, i: F.least(F.lit(3), F.coalesce(_lag("at", i, 1), p + 3) - p).cast("long"))
    rows = rows.withColumn("n_repeat_words", F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x))
    return rows.drop("words", "windows", "ordered", "twice", "placed", "at")


def class_counts(rows: DataFrame) -> tuple[DataFrame, list[str]]:
    """``rows`` with a count of characters for each class, the rest last."""
    left, rest = "text", []
    for name, pattern in CLASSES.items():
        rows = rows.withColumn(f"less_{name}", F.regexp_replace(left, pattern, ""))
        rows = rows.withColumn(f"n_{name}", (F.length(left) - F.length(f"less_{name}")).cast("double"))
        rest, left = [*rest, f"less_{name}"], f"less_{name}"
    rows = rows.withColumn("n_other", F.length(left).cast("double")).drop(*rest)
    return rows, [f"n_{name}" for name in CLASSES] + ["n_other"]


def spaced(text: str) -> Column:
    """Letters in lower case, everything else as two blanks, so that each word has blanks of its own."""
    return F.concat(F.lit(" "), F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}]+", "  "), F.lit(" "))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of counts, by logarithms to base 2; NULL if one has no count."""
    sums = [F.aggregate(x, F.lit(0.0), lambda a, v: a + v) for x in (p, q)]
    pairs = F.zip_with(p, q, lambda x, y: F.struct((x / sums[0]).alias("p"), (y / sums[1]).alias("q")))
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    both = F.aggregate(pairs, F.lit(0.0), lambda a, v: a + part(v["p"], (v["p"] + v["q"]) / 2) + part(v["q"], (v["p"] + v["q"]) / 2))
    return F.when((sums[0] > 0) & (sums[1] > 0), F.sqrt(F.greatest(F.lit(0.0), both / 2)))


def references(rows: DataFrame) -> DataFrame:
    """For each lang of ``rows`` (text, lang), NULL included: class counts, common words and their counts.

    Over all texts; the words are the most frequent ones of at most COMMON_LETTERS letters, the last count is that
    of all other words.
    """
    counted, names = class_counts(rows)
    classes = counted.groupBy("lang").agg(*[F.sum(c).alias(c) for c in names])
    classes = classes.select("lang", F.array(*names).alias("ref_classes"))
    words = rows.select("lang", F.explode(F.split(F.trim(spaced("text")), " +")).alias("word"))
    words = words.select("lang", F.when(F.length("word") <= COMMON_LETTERS, F.col("word")).otherwise(F.lit("")).alias("word"))
    # Written, as both the total and the common words are read from it.
    words = materialise(words.groupBy("lang", "word").count(), "words")
    total = words.groupBy("lang").agg(F.sum("count").alias("total"))
    first = Window.partitionBy("lang").orderBy(F.desc("count"), "word")
    common = words.where("word <> ''").withColumn("place", F.row_number().over(first)).where(F.col("place") <= COMMON)
    common = common.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "word", "count"))).alias("common"))
    same = classes["lang"].eqNullSafe(common["lang"])
    out = classes.join(common, same, "left").select(classes["lang"], "ref_classes", "common")
    out = out.join(total, out["lang"].eqNullSafe(total["lang"]), "left").select(out["lang"].alias("ref_lang"), "ref_classes", "common", "total")
    used = F.aggregate(F.col("common.count"), F.lit(0).cast("long"), lambda a, x: a + x)
    counts = F.concat(F.transform(F.col("common.count"), lambda x: x.cast("double")), F.array((F.col("total") - used).cast("double")))
    return out.select("ref_lang", "ref_classes", F.col("common.word").alias("ref_words"), counts.alias("ref_counts"))


def judge(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text, lang): measures, distances, base_failed and kept.

    Each text's histograms of character classes and of the common words of its language are compared with those of
    all texts of the language (texts without a lang with one another). A text is kept if it does not fail the base
    rule (fewer than 50 words, or more than half of them in repeated windows of three) and no distance that it is
    long enough for exceeds its limit. NULL texts count as empty, and fail. Repeated rows get equal results, an empty
    table gives none; other columns are ignored. Windows are sorted or looked up by size, with the same result.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), "lang")
    refs = references(rows.select("text", "lang"))
    rows = measures(rows)
    rows, names = class_counts(rows)
    rows = rows.withColumn("spaced", spaced("text")).drop("text")
    # One row for each language, so the hint is safe for any table whose lang is a language.
    rows = rows.join(F.broadcast(refs), F.col("lang").eqNullSafe(F.col("ref_lang")), "left")
    rows = rows.withColumn("classes", F.array(*names)).drop(*names)
    trimmed = F.trim("spaced")
    # Bytes are counted: what is cut out has as many bytes each time.
    gaps = F.octet_length(trimmed) - F.octet_length(F.replace(trimmed, F.lit("  "), F.lit(" ")))
    rows = rows.withColumn("letters_words", F.when(F.octet_length(trimmed) > 0, gaps + 1).otherwise(0))
    count = lambda w: (F.octet_length("spaced") - F.octet_length(F.replace(F.col("spaced"), F.concat(F.lit(" "), w, F.lit(" ")), F.lit("")))) / (F.octet_length(w) + 2)
    rows = rows.withColumn("found", F.transform("ref_words", lambda w: count(w)))
    others = F.greatest(F.lit(0.0), F.col("letters_words") - F.aggregate("found", F.lit(0.0), lambda a, x: a + x))
    rows = rows.withColumn("found", F.concat("found", F.array(others.cast("double")))).drop("spaced")
    rows = rows.withColumn("char_distance", distance(F.col("classes"), F.col("ref_classes")))
    rows = rows.withColumn("word_distance", distance(F.col("found"), F.col("ref_counts")))
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    chars = F.aggregate("classes", F.lit(0.0), lambda a, x: a + x)
    far = (chars >= LEAST_CHARS) & (F.coalesce("char_distance", F.lit(0.0)) > FAR_CHARS)
    far = far | ((F.col("letters_words") >= LEAST_WORDS) & (F.coalesce("word_distance", F.lit(0.0)) > FAR_WORDS + F.sqrt(COMMON / (8 * math.log(2) * F.col("letters_words")))))
    rows = rows.withColumn("base_failed", base)
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ~far).alias("kept"), "char_distance", "word_distance")
