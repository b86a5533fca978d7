"""SQL for the queries that SQL can state, over whole tables."""

from __future__ import annotations

from ledgerline.llm import quality_rules as rules

_REACH = """reach AS (SELECT node AS a, node AS b FROM nodes UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
component AS (SELECT a AS node, MIN(b) AS component_id FROM reach GROUP BY a)"""

NEAR_VECTORS = f"""
WITH RECURSIVE nodes AS (SELECT vec_id AS node FROM embeddings),
sound AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT p.vec_id AS a, q.vec_id AS b FROM sound p JOIN sound q ON p.label = q.label AND p.vec_id <> q.vec_id AND len(p.v) = len(q.v)
  WHERE list_cosine_similarity(p.v, q.v) >= 0.93),
{_REACH}
SELECT node AS vec_id, (SELECT COUNT(*) FROM links WHERE a = node) AS n_links, component_id, node = component_id AS kept FROM component"""

_LOWER = "translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_TEXTS = rf"""
WITH RECURSIVE nodes AS (SELECT doc_id AS node FROM documents),
split AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
shingle AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS s FROM split, UNNEST(range(1, greatest(len(w) - 3, 1) + 1)) AS t(i) WHERE len(w) > 0),
size AS (SELECT doc_id, COUNT(*) AS n FROM shingle GROUP BY 1),
common AS (SELECT p.doc_id AS a, q.doc_id AS b, COUNT(*) AS n FROM shingle p JOIN shingle q ON p.s = q.s AND p.doc_id <> q.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common c JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b WHERE 100 * c.n >= 80 * (p.n + q.n - c.n)),
{_REACH}
SELECT node AS doc_id, COALESCE(n, 0) AS n_shingles, component_id, node = component_id AS kept FROM component LEFT JOIN size ON doc_id = node"""


def _classes() -> tuple[str, list[str]]:
    """Steps that peel one class of characters after the other off the text, and the counts' names."""
    steps, left = [], "t"
    for name, pattern in rules.CLASSES.items():
        pattern = pattern.replace("'", "''").replace(r"\s\x{85}", r"\s\x{0B}\x{85}")
        steps.append((name, left, pattern))
        left = f"less_{name}"
    out, source = "", "doc"
    for name, before, pattern in steps:
        out += f", peel_{name} AS (SELECT *, regexp_replace({before}, '{pattern}', '', 'g') AS less_{name} FROM {source})"
        source = f"peel_{name}"
    counts = [f"CAST(length({before}) - length(less_{name}) AS DOUBLE)" for name, before, _ in steps] + [f"CAST(length({left}) AS DOUBLE)"]
    return out + f", classed AS (SELECT doc_id, lang, rid, t, [{', '.join(counts)}] AS classes FROM {source})", counts


def _distance(p: str, q: str) -> str:
    """Jensen-Shannon distance of two lists of counts."""
    x, y = f"({p}[i] / list_sum({p}))", f"({q}[i] / list_sum({q}))"
    part = lambda a: f"CASE WHEN {a} > 0 THEN {a} * log2({a} / (({x} + {y}) / 2)) ELSE 0 END"
    return f"sqrt(greatest(0, list_sum(list_transform(range(1, len({p}) + 1), lambda i: {part(x)} + {part(y)})) / 2))"


def quality() -> str:
    peel, counts = _classes()
    totals = ", ".join(f"SUM(classes[{i + 1}])" for i in range(len(counts)))
    return rf"""
WITH doc AS (SELECT doc_id, lang, row_number() OVER () AS rid, COALESCE(text, '') AS t FROM documents){peel},
split AS (SELECT rid, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM doc),
win AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM split, UNNEST(range(1, len(w) - 1)) AS t(i) WHERE len(w) >= 3),
twice AS (SELECT rid, i FROM win QUALIFY COUNT(*) OVER (PARTITION BY rid, s) > 1),
covered AS (SELECT rid, COUNT(DISTINCT i + k) AS n FROM twice, UNNEST([0, 1, 2]) AS t(k) GROUP BY rid),
plain AS (SELECT rid, lang, regexp_extract_all(lower(t), '[\p{{L}}\p{{M}}]+') AS letters FROM doc),
word AS (SELECT rid, lang, UNNEST(letters) AS word FROM plain),
counted AS (SELECT lang, word, COUNT(*) AS n FROM word GROUP BY ALL),
chosen AS (SELECT lang, word, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS place FROM counted WHERE length(word) <= {rules.COMMON_LETTERS}
  QUALIFY place <= {rules.COMMON}),
ref_words AS (SELECT c.lang, list(word ORDER BY place) AS ws, list(n ORDER BY place) AS ns, any_value(total) AS total FROM chosen c
  JOIN (SELECT lang, SUM(n) AS total FROM counted GROUP BY lang) s ON s.lang IS NOT DISTINCT FROM c.lang GROUP BY c.lang),
ref AS (SELECT lang, ws, list_transform(ns || [total - list_sum(ns)], lambda x: CAST(x AS DOUBLE)) AS q FROM ref_words),
own AS (SELECT p.rid, len(letters) AS letters, q, list_transform(list_transform(ws, lambda x: len(list_filter(letters, lambda y: y = x)))
    || [len(letters) - len(list_filter(letters, lambda y: list_contains(ws, y)))], lambda x: CAST(x AS DOUBLE)) AS p FROM plain p LEFT JOIN ref r ON r.lang IS NOT DISTINCT FROM p.lang),
class_ref AS (SELECT lang, [{totals}] AS q FROM classed GROUP BY lang),
char AS (SELECT c.rid, list_sum(classes) AS n, CASE WHEN list_sum(classes) > 0 THEN {_distance('classes', 'q')} END AS d FROM classed c JOIN class_ref r ON r.lang IS NOT DISTINCT FROM c.lang),
measured AS (SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(doc.t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, COALESCE(covered.n, 0) AS n_repeat_words,
  char.n >= {rules.LEAST_CHARS} AND COALESCE(char.d, 0) > {rules.FAR_CHARS} AS far_chars,
  letters >= {rules.LEAST_WORDS} AND COALESCE({_distance('own.p', 'own.q')}, 0) > {rules.FAR_WORDS} + sqrt({rules.COMMON} / (8 * ln(2) * letters)) AS far_words
  FROM doc JOIN split USING (rid) JOIN own USING (rid) JOIN char USING (rid) LEFT JOIN covered USING (rid)),
base AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT far_chars AND NOT far_words AS kept FROM base"""


#: crc32 of a text ``x`` of ASCII characters.
_CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(x) + 1), lambda i: CAST(ascii(x[i]) AS BIGINT))),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda r, k: xor(r >> 1, 3988292384 * (r & 1)))), 4294967295)"""

PERIODIC_RUNS = rf"""
WITH text AS (SELECT row_number() OVER () AS rid, doc_id, COALESCE(CAST(doc_id AS VARCHAR), '') AS x, regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS v FROM documents),
hashed AS (SELECT rid, doc_id, v, len(v) AS n, {_CRC} AS h FROM text),
tail AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n ELSE n END AS a, h // 10 % 8 AS k FROM hashed),
turned AS (SELECT rid, doc_id, n, list_transform(range(n), lambda i: v[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + k)) END]) AS w FROM tail),
word AS (SELECT rid, n, UNNEST(w) AS x, UNNEST(range(n)) AS i FROM turned),
same AS (SELECT p.rid, p.i, q.i - p.i AS period FROM word p JOIN word q ON p.rid = q.rid AND p.x = q.x AND p.i < q.i AND 4 * (q.i - p.i) <= p.n),
stretch AS (SELECT rid, period, MIN(i) AS start, COUNT(*) + period AS length FROM (SELECT *, i - row_number() OVER (PARTITION BY rid, period ORDER BY i) AS g FROM same) GROUP BY rid, period, g),
run AS (SELECT rid, start, length, MIN(period) AS period FROM stretch WHERE length >= greatest(6, 4 * period) GROUP BY rid, start, length),
listed AS (SELECT rid, COUNT(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM run GROUP BY rid),
best AS (SELECT * FROM run r WHERE NOT EXISTS (SELECT 1 FROM run o WHERE o.rid = r.rid AND (o.length * r.period > r.length * o.period
  OR o.length * r.period = r.length * o.period AND (o.start < r.start OR o.start = r.start AND o.period < r.period)))),
dropped AS (SELECT DISTINCT rid, i FROM run, UNNEST(range(start + period, start + length)) AS t(i)),
collapsed AS (SELECT rid, string_agg(x, ' ' ORDER BY i) AS c FROM word ANTI JOIN dropped USING (rid, i) GROUP BY rid)
SELECT doc_id, COALESCE(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli, sha256(COALESCE(lines, '')) AS runs_sha256, sha256(COALESCE(c, '')) AS collapsed_sha256
FROM turned LEFT JOIN listed USING (rid) LEFT JOIN best USING (rid) LEFT JOIN collapsed USING (rid)"""


HARD_NEGATIVES = """
WITH sound AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
met AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM sound a JOIN sound b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
positive AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM met WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN met USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score QUALIFY rank <= 5"""
