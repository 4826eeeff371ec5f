"""DuckDB SQL of those operators that it can express, over the table documents.

The others need zstandard, XXH64, a tokenizer, a trained model, or look around
in patterns, which DuckDB lacks; tests hold them against brute force.
"""

from __future__ import annotations

import string

from tessera.llm import quality

EXACT_DEDUP = f"""SELECT doc_id, MAX(doc_id) OVER g AS keep_id, COUNT(*) OVER g AS group_size,
  doc_id = MAX(doc_id) OVER g AND ROW_NUMBER() OVER (PARTITION BY text_sha256, doc_id) = 1 AS kept, text_sha256 FROM (
  SELECT doc_id, sha256(translate(COALESCE(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')) AS text_sha256 FROM documents)
  WINDOW g AS (PARTITION BY text_sha256)"""

_MEASURES = r"""t AS (SELECT ROW_NUMBER() OVER () AS rid, doc_id, lang, source, COALESCE(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM t),
grams AS (SELECT rid, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM w)),
twice AS (SELECT rid, i FROM (SELECT rid, i, COUNT(*) OVER (PARTITION BY rid, g) AS c FROM grams) WHERE c > 1),
repeated AS (SELECT rid, SUM(least(8, COALESCE(nxt - i, 8))) AS n FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM twice) GROUP BY 1),
m AS (SELECT rid, doc_id, lang, source, len(w) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  len(l) - len(list_distinct(l)) AS n_dup_lines, CAST(COALESCE(repeated.n, 0) AS BIGINT) AS n_repeat_words, len(l) AS n_lines FROM w LEFT JOIN repeated USING (rid)),
v AS (SELECT m.*, rule, CASE rule WHEN 'symbol_permille' THEN n_symbols * 1000 // greatest(word_chars, 1) WHEN 'dup_line_permille' THEN n_dup_lines * 1000 // greatest(n_lines, 1)
  WHEN 'repeat_permille' THEN n_repeat_words * 1000 // greatest(n_words, 1) ELSE word_chars * 100 // greatest(n_words, 1) END AS x
  FROM m CROSS JOIN (VALUES ('symbol_permille'), ('dup_line_permille'), ('repeat_permille'), ('word_length_x100')) r(rule)),
b AS (SELECT *, (x >> greatest(length(bin(x)) - 6, 0)) << greatest(length(bin(x)) - 6, 0) AS bin FROM v)"""


def _quartiles(keys: str) -> str:
    return f"""SELECT {keys}rule, MAX(documents) AS documents, MIN(CASE WHEN upto * 100 >= documents * 25 THEN bin END) AS q25, MIN(CASE WHEN upto * 100 >= documents * 75 THEN bin END) AS q75 FROM (
    SELECT {keys}rule, bin, SUM(n) OVER (PARTITION BY {keys}rule ORDER BY bin) AS upto, SUM(n) OVER (PARTITION BY {keys}rule) AS documents FROM (
      SELECT {keys}rule, bin, COUNT(*) AS n FROM b GROUP BY ALL)) GROUP BY ALL"""


def _blended(q: str) -> str:
    return f"(CAST(o.documents AS DOUBLE) * o.{q} + {quality.PRIOR} * g.{q} + {quality.PRIOR} * a.{q}) / (o.documents + {2 * quality.PRIOR})"


_SLACK = " ".join(f"WHEN '{r}' THEN {s}" for r, s in quality.RULES.items())
ADAPTIVE_QUALITY = f"""WITH {_MEASURES}, own AS ({_quartiles("lang, source, ")}), of_lang AS ({_quartiles("lang, ")}), of_all AS ({_quartiles("")}),
failed AS (SELECT b.rid, string_agg(b.rule, ',' ORDER BY list_position(['symbol_permille', 'dup_line_permille', 'repeat_permille', 'word_length_x100'], b.rule)) AS rules FROM b
  JOIN own o ON o.rule = b.rule AND o.lang IS NOT DISTINCT FROM b.lang AND o.source IS NOT DISTINCT FROM b.source
  JOIN of_lang g ON g.rule = b.rule AND g.lang IS NOT DISTINCT FROM b.lang JOIN of_all a ON a.rule = b.rule
  WHERE b.x > {1 + quality.FENCE} * ({_blended("q75")}) - {quality.FENCE} * ({_blended("q25")}) + CASE b.rule {_SLACK} END GROUP BY 1)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND rules IS NULL AS kept, COALESCE(rules, '') AS failed_rules FROM m LEFT JOIN failed USING (rid)"""

PARETO_MIX = r"""WITH d AS (SELECT doc_id, source, len(list_filter(regexp_split_to_array(COALESCE(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS size, md5(COALESCE(text, '')) AS h FROM documents),
s AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size, COUNT(*) AS documents FROM d GROUP BY 1),
s1 AS (SELECT *, CAST([1, 2, 3][1 + (ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS weight, CAST(source_size AS DOUBLE) * 3 AS most, CAST(SUM(source_size) OVER () AS DOUBLE) AS total FROM s),
s2 AS (SELECT *, (total - COALESCE(SUM(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / SUM(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate FROM s1),
s3 AS (SELECT *, least(most, COALESCE((SELECT arg_min(rate, most / weight) FROM s2 WHERE most / weight >= rate) * weight, most)) AS target FROM s2),
s4 AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS times FROM s3),
s5 AS (SELECT *, least(CAST(floor(times) AS BIGINT), 3) AS whole, greatest(0, target - least(CAST(floor(times) AS BIGINT), 3) * source_size) AS rest FROM s4),
r AS (SELECT * FROM s5 WHERE rest > 0 AND whole < 3),
b1 AS (SELECT d.source, (d.size >> greatest(length(bin(d.size)) - 6, 0)) << greatest(length(bin(d.size)) - 6, 0) AS len, SUM(d.size) AS words FROM d GROUP BY 1, 2),
b2 AS (SELECT b1.*, rest, 1 / sqrt(greatest(1::DOUBLE, CAST(len * documents AS DOUBLE) / source_size)) AS w FROM b1 JOIN r ON r.source IS NOT DISTINCT FROM b1.source),
b3 AS (SELECT *, (rest - COALESCE(SUM(words) OVER (PARTITION BY source ORDER BY len ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / NULLIF(SUM(words * w) OVER (PARTITION BY source ORDER BY len ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS c FROM b2),
b4 AS (SELECT *, MIN(CASE WHEN c * w <= 1 THEN len END) OVER (PARTITION BY source) AS from_len FROM b3),
b5 AS (SELECT *, CASE WHEN len >= from_len THEN MAX(CASE WHEN len = from_len THEN c END) OVER (PARTITION BY source) * w ELSE 1 END AS p FROM b4),
j AS (SELECT d.*, r.rest, b5.p, (CAST(CAST('0x' || substr(md5(COALESCE(CAST(doc_id AS VARCHAR), '') || ':' || h || ':7'), 1, 13) AS BIGINT) AS DOUBLE) + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM d JOIN r ON r.source IS NOT DISTINCT FROM d.source JOIN b5 ON b5.source IS NOT DISTINCT FROM d.source AND b5.len = (d.size >> greatest(length(bin(d.size)) - 6, 0)) << greatest(length(bin(d.size)) - 6, 0)),
k AS (SELECT *, SUM(size) OVER (PARTITION BY source ORDER BY CASE WHEN p >= 1 THEN 0 ELSE (u / (1 - u)) / (p / (1 - p)) END, doc_id, h, size ROWS UNBOUNDED PRECEDING) AS upto FROM j),
c AS (SELECT doc_id, source, size, h, CASE WHEN 2 * upto - size <= 2 * rest AND rest - upto + size > 0 THEN 1 ELSE 0 END AS drawn FROM k),
e AS (SELECT d.doc_id, d.size, s5.source_size, s5.target, d.source, CAST(whole AS BIGINT) AS whole, 0 AS drawn FROM d JOIN s5 ON s5.source IS NOT DISTINCT FROM d.source WHERE NOT (rest > 0 AND whole < 3)
  UNION ALL SELECT c.doc_id, c.size, s5.source_size, s5.target, c.source, CAST(whole AS BIGINT), drawn FROM c JOIN s5 ON s5.source IS NOT DISTINCT FROM c.source)
SELECT doc_id, size, source_size, target, CAST((whole + drawn) * size AS BIGINT) AS taken, source, whole + drawn AS copies FROM e"""

_VECTORS = """v AS MATERIALIZED (SELECT ROW_NUMBER() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
x AS MATERIALIZED (SELECT rid, unnest(v) AS x, unnest(range(64)) AS i FROM v),
c0 AS MATERIALIZED (SELECT k, unnest(v) AS x, unnest(range(64)) AS i FROM (
  SELECT ROW_NUMBER() OVER (ORDER BY sha256('2:' || COALESCE(CAST(vec_id AS VARCHAR), '')), v) - 1 AS k, v FROM v QUALIFY k < 40))"""


def _round(r: int) -> str:
    """Round r: vectors assigned to the centroids c<r>, and the centroids moved."""
    return f"""a{r} AS MATERIALIZED (SELECT rid, k, d FROM (SELECT rid, k, SUM((x.x - c.x) * (x.x - c.x)) AS d FROM x JOIN c{r} c USING (i) GROUP BY rid, k) QUALIFY ROW_NUMBER() OVER (PARTITION BY rid ORDER BY d, k) = 1),
c{r + 1} AS MATERIALIZED (SELECT c.k, c.i, CAST(COALESCE((s - ((s % n) + n) % n) // n, c.x) AS BIGINT) AS x FROM c{r} c LEFT JOIN (
  SELECT a.k, x.i, SUM(x.x) AS s, COUNT(*) AS n FROM a{r} a JOIN x USING (rid) GROUP BY a.k, x.i) USING (k, i))"""


HAMERLY_CLUSTERS = f"""WITH {_VECTORS}, {", ".join(_round(r) for r in range(6))},
s AS (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c5 GROUP BY k)
SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(SUM(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(SUM(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a5 JOIN v USING (rid) JOIN s USING (k)"""

_LOWER = f"translate(%s, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
_WORDS = f"regexp_extract_all({_LOWER % "COALESCE(text, '')"}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"
DECONTAMINATION = f"""WITH i AS (SELECT COALESCE(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
w AS MATERIALIZED (SELECT DISTINCT item, least(10, len(w)) AS m, array_to_string(w[pos:pos + 9], ' ') AS g FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS pos FROM i WHERE len(w) > 0)),
d AS MATERIALIZED (SELECT ROW_NUMBER() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
g AS (SELECT rid, m, pos, array_to_string(w[pos:pos + m - 1], ' ') AS g FROM (SELECT rid, w, m, unnest(range(1, len(w) - m + 2)) AS pos FROM d JOIN (SELECT DISTINCT m FROM w) ON len(w) >= m)),
h AS MATERIALIZED (SELECT rid, pos, m, item FROM g JOIN w USING (m, g)),
p AS (SELECT rid, COUNT(*) AS n_hit FROM (SELECT DISTINCT rid, unnest(range(pos, pos + m)) AS word FROM h) GROUP BY rid),
f AS (SELECT rid, COUNT(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM h) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items, sha256(COALESCE(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN p USING (rid) LEFT JOIN f USING (rid)"""


def _leaf(text: str) -> str:
    """The digest of a row's columns; text: what stands for its text."""
    fields = (f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END" for c in ("doc_id", "source", "lang", "n_chars", text))
    return f"sha256({' || '.join(fields)})"


def _tree(name: str, leaves: str) -> str:
    """All nodes over leaves (grp, idx, digest, n), level by level."""
    return f"""{name}(grp, level, idx, digest, n) AS (SELECT grp, 0, idx, digest, n FROM {leaves}
  UNION ALL SELECT grp, level + 1, idx // 8, sha256(string_agg(digest, '' ORDER BY idx)), (n + 7) // 8 FROM {name} WHERE n > 1 GROUP BY grp, level, idx // 8, n)"""


def _steps(leaf: str, tree: str, above: int) -> str:
    """What stands left and right of each leaf's ancestor in its run, by level."""
    side = lambda op: f"COALESCE(string_agg(CASE WHEN s.idx {op} r.idx >> (3 * s.level) THEN s.digest END, '' ORDER BY s.idx), '')"
    return f"""SELECT r.rid, s.level + {above} AS level, {side("<")} AS lft, {side(">")} AS rgt FROM {leaf} r JOIN {tree} s ON s.grp = r.grp AND s.n > 1 AND s.idx // 8 = r.idx >> (3 * s.level + 3) GROUP BY r.rid, s.level"""


#: CRC-32 bit by bit, over the bits of a decimal number from the lowest of each digit on.
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: list_transform(range(8), lambda b: (CAST(ascii(c) AS BIGINT) >> b) & 1)))),
  lambda c, b: xor(c >> 1, (xor(c, b) & 1) * 3988292384)))"""
MERKLE_MANIFEST = f"""WITH RECURSIVE d AS MATERIALIZED (SELECT *, ROW_NUMBER() OVER () AS rid, ROW_NUMBER() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, digest) - 1 AS idx, COUNT(*) OVER (PARTITION BY grp) AS n FROM (
  SELECT doc_id, COALESCE('=' || lang, '') AS grp, {_leaf("text")} AS digest, CASE WHEN doc_id IS NOT NULL AND {_CRC} % 3 = 0 THEN {_leaf(_LOWER % "text")} END AS changed FROM documents)),
{_tree("t", "d")},
u AS MATERIALIZED (SELECT '' AS grp, grp AS own, digest, ROW_NUMBER() OVER (ORDER BY grp) - 1 AS idx, COUNT(*) OVER () AS n FROM t WHERE n = 1),
{_tree("tu", "u")},
du AS (SELECT d.rid, '' AS grp, u.idx FROM d JOIN u ON u.own = d.grp),
s AS MATERIALIZED (SELECT *, ROW_NUMBER() OVER (PARTITION BY rid ORDER BY level) AS k FROM ({_steps("d", "t", 0)} UNION ALL {_steps("du", "tu", 100)})),
f(rid, k, digest) AS (SELECT rid, 0, COALESCE(changed, digest) FROM d UNION ALL SELECT f.rid, f.k + 1, sha256(lft || digest || rgt) FROM f JOIN s ON s.rid = f.rid AND s.k = f.k + 1),
p AS (SELECT rid, sha256(string_agg(lft || rgt, '' ORDER BY k)) AS proof FROM s GROUP BY rid),
o AS (SELECT rid, arg_max(digest, k) AS folded_root FROM f GROUP BY rid)
SELECT d.doc_id, d.digest AS leaf, u.digest AS subroot, (SELECT digest FROM tu WHERE n = 1) AS root, COALESCE(p.proof, sha256('')) AS proof_sha256, o.folded_root, o.folded_root = (SELECT digest FROM tu WHERE n = 1) AS verified
FROM d JOIN u ON u.own = d.grp LEFT JOIN p ON p.rid = d.rid JOIN o ON o.rid = d.rid"""

ORACLES = {
    "op6_adaptive_quality": ADAPTIVE_QUALITY,
    "op7_pareto_mix": PARETO_MIX,
    "op9_digest_index_dedup": EXACT_DEDUP,
    "op11_hamerly_clusters": HAMERLY_CLUSTERS,
    "op12_suffix_array_decontamination": DECONTAMINATION,
    "op13_merkle_manifest": MERKLE_MANIFEST,
}
