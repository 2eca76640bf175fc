"""DuckDB SQL for the queries of this folder that SQL can express.

The others have none: op2 needs a tokenizer, op5 spans of patterns and corpus statistics over them, op6 automata,
op7 XXH64; the pipeline contains all of these. Tests compare them with brute force on small tables.
"""

from __future__ import annotations

LLM_ORACLES: dict[str, str] = {}

_WORD = r"[^\x20\x09-\x0D]+"
_DOCS = f"""d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t,
  regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents)"""

LLM_ORACLES["op1_perspective_rotation"] = r"""
WITH c AS (SELECT DISTINCT conv_id, role, regexp_replace(coalesce(role, 'unknown'), '[\s<|>~]', '_', 'g') AS clean FROM conversations),
s AS (SELECT conv_id AS c, role AS speaks, clean || CASE WHEN n = 1 THEN '' ELSE '~' || n END AS speaker FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, clean ORDER BY role NULLS LAST) AS n FROM c)),
r AS (SELECT conv_id, turn, role, coalesce(text, '') AS body, speaker AS name FROM conversations JOIN s ON conv_id IS NOT DISTINCT FROM s.c AND role IS NOT DISTINCT FROM speaks),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS LAST, body) - 1 AS place FROM r),
x AS (SELECT conv_id, speaker, place // 64 AS part, place, name = speaker AS mine,
    CASE WHEN name = speaker THEN '<|assistant|>' ELSE '<|user name=' || name || '|>' END || chr(10) AS header, body || '<|end|>' AS said
  FROM p JOIN s ON p.conv_id IS NOT DISTINCT FROM s.c),
l AS (SELECT *, coalesce(sum(length(header) + length(said) + 1) OVER (PARTITION BY conv_id, speaker, part ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(header) AS start FROM x)
SELECT conv_id, speaker, part, count(*) AS n_turns, count(*) FILTER (mine) AS n_own_turns, string_agg(header || said || chr(10), '' ORDER BY place) AS text,
  coalesce(string_agg(CAST(CAST(start AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(start + length(said) AS BIGINT) AS VARCHAR), ',' ORDER BY place) FILTER (mine), '') AS masks
FROM l GROUP BY conv_id, speaker, part"""

LLM_ORACLES["op3_stratified_shards"] = """
WITH tab AS (SELECT list_transform(range(256), lambda c: list_reduce([c, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crcs),
d AS (SELECT doc_id, source, coalesce(text, '') AS t, md5('23|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')) AS digest FROM documents),
b AS (SELECT doc_id, source, digest, octet_length(encode(t)) + 8 AS size,
  xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda h: CAST('0x' || h AS BIGINT))), lambda c, v: xor(crcs[(xor(c, v) & 255) + 1], c >> 8)), 4294967295) AS crc FROM d, tab),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY digest, doc_id NULLS FIRST) - 1 AS rank, count(*) OVER (PARTITION BY source) AS n FROM b),
p AS (SELECT *, row_number() OVER (ORDER BY (rank + CAST('0x' || substr(md5(coalesce('23|=' || source, '23|-')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE) / n, source NULLS FIRST, digest, doc_id NULLS FIRST) - 1 AS place, count(*) OVER () AS total FROM r)
SELECT doc_id, CAST(size AS BIGINT) AS size, crc AS text_crc32, 'rows' AS law, CAST(place * 24 // total AS INT) AS shard,
  CAST(place - (place * 24 // total * total + 23) // 24 AS BIGINT) AS slot, CAST(NULL AS INT) AS grown_shard FROM p"""

LLM_ORACLES["op4_water_filling_mix"] = f"""
WITH {_DOCS}, u AS (SELECT doc_id, source, len(w) AS size, md5('17|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || t) AS digest FROM d),
s AS (SELECT source, CAST(sum(size) AS DOUBLE) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM u GROUP BY source),
c AS (SELECT *, 2.0 * source_size AS cap, [3.0, 1.0, 2.0][place % 3 + 1] AS weight FROM s),
o AS (SELECT *, coalesce(sum(cap) OVER k, 0) AS full_, sum(weight) OVER () - coalesce(sum(weight) OVER k, 0) AS free, sum(source_size) OVER () * 1.5 AS budget
  FROM c WHERE cap > 0 WINDOW k AS (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT arg_min((budget - full_) / free, (cap / weight, place)) AS level FROM o WHERE (budget - full_) / free * weight <= cap),
a AS (SELECT source, source_size, CASE WHEN cap > 0 THEN least(cap, (SELECT level FROM l) * weight) ELSE 0 END AS target FROM c),
m AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS copies, target - CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END * source_size AS rest FROM a),
g AS (SELECT source, digest, sum(size) AS size FROM u GROUP BY ALL),
f AS (SELECT g.*, rest, sum(size) OVER (PARTITION BY g.source ORDER BY digest) AS reach FROM g JOIN m ON g.source IS NOT DISTINCT FROM m.source WHERE rest > 0),
e AS (SELECT source, max(digest) FILTER (reach <= rest) AS cutoff, any_value(rest) - coalesce(max(reach) FILTER (reach <= rest), 0) AS gap FROM f GROUP BY source),
z AS (SELECT f.source, arg_min(digest, (abs(size - gap), digest)) AS filler FROM f JOIN e ON f.source IS NOT DISTINCT FROM e.source WHERE reach > rest AND abs(size - gap) < gap GROUP BY f.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(m.source_size AS BIGINT) AS source_size, m.target AS target,
  CAST(size * (copies + CASE WHEN coalesce(digest <= cutoff, false) OR coalesce(digest = filler, false) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM u JOIN m ON u.source IS NOT DISTINCT FROM m.source LEFT JOIN e ON u.source IS NOT DISTINCT FROM e.source LEFT JOIN z ON u.source IS NOT DISTINCT FROM z.source"""

LLM_ORACLES["op8_super_kmers"] = f"""
WITH {_DOCS}, x AS (SELECT rid, i, array_to_string(w[i:i + 34], ' ') AS g FROM d, unnest(range(1, len(w) - 33)) AS k(i)),
y AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY g) AS n FROM x) WHERE n > 1),
z AS (SELECT DISTINCT rid, unnest(range(i, i + 35)) AS p FROM y),
v AS (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
k AS (SELECT v.rid, string_agg(word, ' ' ORDER BY v.p) AS kept, count(*) AS n FROM v ANTI JOIN z ON v.rid = z.rid AND v.p = z.p GROUP BY v.rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k ON d.rid = k.rid"""

LLM_ORACLES["op9_rule_cascade"] = rf"""
WITH {_DOCS}, x AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM d, unnest(range(1, len(w) - 1)) AS k(i)),
y AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM x) WHERE n > 1),
z AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM y) GROUP BY rid),
m AS (SELECT d.rid, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines, len(string_split(t, chr(10))) AS n_lines, coalesce(z.n, 0) AS n_repeat_words FROM d LEFT JOIN z ON d.rid = z.rid),
n AS (SELECT *, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > 3 * n_words OR word_chars < 2 * n_words OR word_chars > 30 * n_words OR 2 * n_dup_lines > n_lines) AS kept FROM n"""

LLM_ORACLES["op10_threshold_top_k"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
u AS (SELECT DISTINCT vec_id, e FROM v WHERE vec_id % 50 = 0), q AS (SELECT *, row_number() OVER () AS a FROM u),
p AS (SELECT a, q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= 5"""

_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
_WHOLE = "list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT))"


def _clusters_sql(k: int = 40, rounds: int = 5, dim: int = 64, seed: int = 2) -> str:
    """The rounds one after the other: a(i) assigns to the centroids c(i), which are the means of a(i - 1)."""
    square = "CAST(list_sum(list_transform(list_zip(v.e, c.e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT)"
    steps = [
        f"v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, {_WHOLE} AS e FROM embeddings WHERE len(embedding) = {dim} AND {_FINITE})",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h NULLS LAST, e) - 1 AS cluster, e FROM (SELECT sha256('{seed}:' || CAST(vec_id AS VARCHAR)) AS h, e FROM v ORDER BY h NULLS LAST, e LIMIT {k}))",
    ]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT rid, min((d, cluster)) AS near FROM (SELECT rid, cluster, {square} AS d FROM v, c{i} AS c) GROUP BY rid)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.e, c.e) AS e FROM c{i} AS c LEFT JOIN (
  SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY p) AS e FROM (
    SELECT near[2] AS cluster, p, CAST(sum(v.e[p]) AS BIGINT) AS s, count(*) AS n FROM a{i} JOIN v ON a{i}.rid = v.rid, unnest(range(1, {dim + 1})) AS k(p) GROUP BY near[2], p) GROUP BY cluster) AS m ON c.cluster = m.cluster)""")
    steps.append(f"t AS (SELECT near[2] AS cluster, CAST(sum(near[1]) AS BIGINT) AS inertia FROM a{rounds} GROUP BY 1)")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, CAST(t.cluster AS INT) AS cluster, near[1] AS distance, t.inertia AS cluster_inertia, CAST((SELECT sum(inertia) FROM t) AS BIGINT) AS inertia,
  sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM v JOIN a{rounds} AS a ON v.rid = a.rid JOIN t ON t.cluster = near[2] JOIN c{rounds} AS c ON c.cluster = near[2]"""


LLM_ORACLES["op11_centroid_expressions"] = _clusters_sql()

LLM_ORACLES["op13_slot_negatives"] = f"""
WITH v AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, {_WHOLE} AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND {_FINITE}),
q AS (SELECT DISTINCT * FROM v WHERE vec_id % 50 = 0),
n AS (SELECT *, row_number() OVER () AS a FROM q),
s AS MATERIALIZED (SELECT a, n.vec_id AS anchor_id, r.vec_id, n.label = r.label AS same, CAST(list_sum(list_transform(list_zip(n.e, r.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM n JOIN v AS r ON n.vec_id <> r.vec_id AND len(n.e) = len(r.e)),
p AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) AS place FROM s WHERE same QUALIFY place <= 5),
m AS (SELECT p.anchor_id, p.vec_id AS positive_id, p.place, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.a, p.place ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON p.a = s.a AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score FROM m WHERE rank <= 3"""
