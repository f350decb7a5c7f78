"""DuckDB SQL of the corpus operators that SQL can express."""

from __future__ import annotations

#: Fixed value: the polynomial of CRC-32 (reversed bits).
_POLYNOMIAL = 3988292384


def _remainders() -> str:
    """The 256 remainders of one byte, from the polynomial, as a SQL list."""
    out = []
    for r in range(256):
        for _ in range(8):
            r = r >> 1 ^ (_POLYNOMIAL if r & 1 else 0)
        out.append(str(r))
    return f"[{', '.join(out)}]::BIGINT[]"


def crc32(hexes: str) -> str:
    """Unsigned CRC-32 of the bytes that the SQL expression gives in hexadecimal."""
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({hexes}), 2), "
            f"lambda i: ('0x' || substr({hexes}, i, 2))::BIGINT)), "
            f"lambda c, b: xor(c >> 8, ({_remainders()})[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)")


CONVERSATION_TRIE = f"""
WITH own AS (
  SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}}
                       ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
shared AS (SELECT o.*, {crc32("hex(encode(conv_id::VARCHAR))")} % 6 AS h FROM own o),
rebuilt AS (
  SELECT s.conv_id, list_concat(coalesce(b.turns[1:s.h], []), s.turns[s.h + 1:]) AS turns
  FROM shared s LEFT JOIN own b ON b.conv_id = s.conv_id - s.conv_id % 100),
prefixes AS (
  SELECT conv_id, d, turns[1:d] AS node, turns[1:d - 1] AS parent, len(turns) = d AS ends,
         CASE WHEN d > 0 THEN length(turns[d].t) ELSE 0 END AS chars
  FROM rebuilt, unnest(range(0, len(turns) + 1)) AS u(d)),
nodes AS (
  SELECT d AS depth, node, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * any_value(chars) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM prefixes GROUP BY d, node),
children AS (SELECT depth - 1 AS depth, parent AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1, 2),
full_nodes AS (SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c USING (depth, node)),
subtree AS (
  SELECT a AS depth, node[1:a] AS node, sum((n_children = 0)::BIGINT) AS n_leaves, sum(saved) AS saved_tokens
  FROM full_nodes, unnest(range(0, depth + 1)) AS u(a) GROUP BY 1, 2)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children::BIGINT AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN subtree s USING (depth, node)
LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.node = n.parent
"""

_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")
_RUNS = """list_concat(words, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]),
                     list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]))"""
IMPORTANCE = f"""
WITH worded AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents),
feature AS (SELECT r, unnest({_RUNS}) AS f FROM worded),
goal AS (SELECT unnest({_RUNS}) AS f FROM (SELECT {_WORDS} AS words FROM benchmark)),
bucket AS (SELECT f, {crc32("hex(encode(f))")} % 10000 AS b FROM (SELECT f FROM feature UNION SELECT f FROM goal)),
s AS (SELECT b, count(*) AS n FROM feature JOIN bucket USING (f) GROUP BY b),
t AS (SELECT b, count(*) AS n FROM goal JOIN bucket USING (f) GROUP BY b),
gain AS (
  SELECT b, floor(1000.0::DOUBLE * ln((coalesce(t.n, 0)::DOUBLE + 1) * ((SELECT coalesce(sum(n), 0) FROM s)::DOUBLE + 10000)
                  / ((coalesce(s.n, 0)::DOUBLE + 1) * ((SELECT coalesce(sum(n), 0) FROM t)::DOUBLE + 10000))))::BIGINT AS g
  FROM s FULL JOIN t USING (b)),
weight AS (SELECT r, count(*) AS n_features, sum(g)::BIGINT AS weight
           FROM feature JOIN bucket USING (f) JOIN gain USING (b) GROUP BY r),
scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(words) >= 20 AS able,
         coalesce(weight, 0) + floor(-1000.0::DOUBLE * ln(-ln((('0x' || substr(sha256('42:' || doc_id), 1, 8))::BIGINT::DOUBLE + 0.5)
                                                             / 4294967296.0::DOUBLE)))::BIGINT AS score
  FROM worded LEFT JOIN weight USING (r)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) AS place FROM scored)
SELECT doc_id, n_features, weight, score,
       CASE WHEN able AND place <= (SELECT 5 * count(*) // 100 FROM scored WHERE able) THEN place END AS rank
FROM ranked
"""

#: White space here is blank, tab, line feed, vertical tab, form feed, carriage return.
JACCARD = r"""
WITH RECURSIVE worded AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS words FROM documents),
runs AS (
  SELECT r, doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
         ELSE list_sort(list_distinct(list_transform(range(1, len(words) - 1),
              lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]))) END AS shingles FROM worded),
point AS (SELECT shingles, min(r) AS p FROM runs WHERE len(shingles) > 0 GROUP BY shingles),
element AS (SELECT p, len(shingles) AS n, unnest(shingles) AS e FROM point),
link AS (
  SELECT a.p AS x, b.p AS y FROM element a JOIN element b ON a.e = b.e AND a.p <> b.p
  WHERE 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.p, b.p HAVING 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))),
reach AS (SELECT p AS x, p AS y FROM point UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x),
root AS (SELECT x AS p, min(y) AS root FROM reach GROUP BY x),
placed AS (SELECT r.r, r.doc_id, len(r.shingles) AS n, o.root FROM runs r LEFT JOIN point USING (shingles) LEFT JOIN root o USING (p)),
least_id AS (SELECT root, min(doc_id) AS component_id FROM placed WHERE root IS NOT NULL GROUP BY root)
SELECT doc_id, n AS n_shingles, CASE WHEN root IS NULL THEN doc_id ELSE component_id END AS component_id
FROM placed LEFT JOIN least_id USING (root)
"""

TOP_K = """
WITH good AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(x::DOUBLE * 1024) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pair AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM good q JOIN good c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pair)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""

#: The white space that words are split at.
_WHITE = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
BACKOFF = f"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^{_WHITE}]+') AS words FROM documents),
uni AS (SELECT w, count(*) AS c FROM (SELECT unnest(words) AS w FROM doc) GROUP BY w),
total AS (SELECT sum(c)::DOUBLE AS n FROM uni),
own AS (
  SELECT r, p.v AS v, p.w AS w, count(*) AS n
  FROM (SELECT r, unnest(list_transform(range(1, len(words)), lambda i: {{'v': words[i], 'w': words[i + 1]}})) AS p FROM doc) GROUP BY ALL),
bi AS (SELECT v, w, sum(n) AS c FROM own GROUP BY ALL),
part AS (
  SELECT r, sum(CASE WHEN bi.c > own.n THEN own.n * ln(bi.c / a.c) ELSE own.n * ln(0.4 * b.c / total.n) END) AS s,
         sum(CASE WHEN bi.c > own.n THEN 0 ELSE own.n END) AS back
  FROM own JOIN bi USING (v, w) JOIN uni a ON a.w = own.v JOIN uni b ON b.w = own.w, total GROUP BY r),
scored AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(back, 0) AS BIGINT) AS n_backoff,
         round(CASE WHEN len(words) = 0 THEN 0.0 ELSE ln(uni.c / total.n) + coalesce(s, 0) END, 6) AS log_score
  FROM doc LEFT JOIN part USING (r) LEFT JOIN uni ON uni.w = words[1], total)
SELECT *, CASE WHEN n_words > 0 THEN round(log_score / n_words, 6) END AS mean_log FROM scored
"""

ORACLES: dict[str, str] = {"op8_exact_top_k": TOP_K, "op9_lm_scores": BACKOFF, "op11_importance_resampling": IMPORTANCE,
                           "op12_conversation_trie": CONVERSATION_TRIE, "op13_jaccard_components": JACCARD}
