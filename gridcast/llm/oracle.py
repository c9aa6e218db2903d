"""SQL for the registered queries of the subpackage, in DuckDB's dialect."""

from __future__ import annotations

WORDS = r"list_filter(string_split_regex(coalesce({0}, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_NO_SPACES = "length(translate({0}, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), ''))"
_COUNT = "(length({0}) - length(translate({0}, '{1}', '')))"

MENU = (
    "'home', 'menu', 'search', 'login', 'log in', 'sign in', 'sign up', 'register', 'next', 'previous', 'next page', "
    "'previous page', 'back to top', 'read more', 'share', 'contact us', 'about us', 'site map', 'sitemap'"
)
STOCK = r"cookie policy|cookies on this|enable javascript|all rights reserved|terms of use|privacy policy|click here|subscribe to our|lorem ipsum"

OP4 = f"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS t, string_split(coalesce(text, ''), chr(10)) AS lines, {WORDS.format("text")} AS words,
         row_number() OVER () AS rid
  FROM documents
), line AS (
  SELECT rid, k, ln, {WORDS.format("ln")} AS w FROM (SELECT rid, unnest(lines) AS ln, unnest(range(len(lines))) AS k FROM split)
), judged AS (
  SELECT rid, k, ln, len(w) > 0 AS full_line,
    len(w) > 0 AND (
      {_COUNT.format("ln", "#*$%&|<>")} * 5 > len(w)
      OR ({_COUNT.format("ln", "!")} * 3 > len(w) AND len(w) >= 3)
      OR (ln = upper(ln) AND ln <> lower(ln) AND len(w) >= 5)
      OR ({_COUNT.format("ln", "|")} * 4 >= len(w) AND {_COUNT.format("ln", "|")} >= 2)
      OR (len(w) <= 3 AND lower(array_to_string(w, ' ')) IN ({MENU}))
      OR regexp_matches(lower(ln), '{STOCK}')
      OR (len(w) >= 8 AND len(list_distinct(w)) * 2 <= len(w))
    ) AS fails
  FROM line
), by_doc AS (
  SELECT rid,
    count(*) FILTER (full_line) - count(DISTINCT ln) FILTER (full_line) AS n_dup_lines,
    count(*) FILTER (fails) AS n_lines_removed,
    coalesce(sum({_NO_SPACES.format("ln")}) FILTER (fails), 0)::BIGINT AS lost_chars
  FROM judged GROUP BY rid
), windows AS (
  SELECT rid, p, words[p:p+2] AS win FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS p FROM split WHERE len(words) >= 3)
), repeated AS (
  SELECT rid, p FROM windows QUALIFY count(*) OVER (PARTITION BY rid, win) > 1
), covered AS (
  SELECT rid, count(DISTINCT p + o) AS n_repeat_words FROM repeated, (SELECT unnest([0, 1, 2]) AS o) GROUP BY rid
)
SELECT doc_id, len(words) AS n_words, {_NO_SPACES.format("t")} AS word_chars, {_COUNT.format("t", "#*$%&|<>")} AS n_symbols,
  n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
  (len(words) < 50 OR coalesce(n_repeat_words, 0) * 100 > len(words) * 50) AS base_failed,
  n_lines_removed, lost_chars,
  NOT (len(words) < 50 OR coalesce(n_repeat_words, 0) * 100 > len(words) * 50)
    AND lost_chars * 100 <= {_NO_SPACES.format("t")} * 30 AS kept
FROM split JOIN by_doc USING (rid) LEFT JOIN covered USING (rid)
"""

OP1 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
)
SELECT q.vec_id AS query_id, row_number() OVER (PARTITION BY q.vec_id, q.v ORDER BY list_dot_product(q.v, c.v) DESC, c.vec_id)::INT AS rank,
  c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
FROM (SELECT DISTINCT vec_id, v FROM v WHERE vec_id % 100 = 0) q JOIN v c ON q.vec_id <> c.vec_id
QUALIFY rank <= 10
"""

_TURN = "'<|' || coalesce({0}.role, '') || '|>' || chr(10) || coalesce({0}.text, '') || '<|end|>' || chr(10)"
OP6 = f"""
WITH side AS (
  SELECT floor(conv_id / 2)::BIGINT AS pair_id, conv_id % 2 = 0 AS chosen, turn, role, text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS k
  FROM conversations WHERE conv_id IS NOT NULL
), common AS (
  SELECT p.pair_id, coalesce(min(k) - 1, any_value(p.n)) AS n FROM (SELECT pair_id, max(k) AS n FROM side GROUP BY pair_id) p
  LEFT JOIN (
    SELECT coalesce(c.pair_id, r.pair_id) AS pair_id, coalesce(c.k, r.k) AS k
    FROM (FROM side WHERE chosen) c FULL JOIN (FROM side WHERE NOT chosen) r ON c.pair_id = r.pair_id AND c.k = r.k
    WHERE c.k IS NULL OR r.k IS NULL OR c.role IS DISTINCT FROM r.role OR c.text IS DISTINCT FROM r.text
  ) d ON d.pair_id = p.pair_id GROUP BY p.pair_id
), placed AS (
  SELECT s.*, n, {_TURN.format("s")} AS body,
    sum(length({_TURN.format("s")})) OVER (PARTITION BY s.pair_id, chosen, k > n ORDER BY k) AS upto
  FROM side s JOIN common USING (pair_id)
), made AS (
  SELECT pair_id, n::INT AS n_common,
    coalesce(string_agg(body, '' ORDER BY k) FILTER (chosen AND k <= n), '') AS prompt,
    CASE WHEN bool_or(chosen) THEN coalesce(string_agg(body, '' ORDER BY k) FILTER (chosen AND k > n), '') END AS chosen,
    CASE WHEN bool_or(NOT chosen) THEN coalesce(string_agg(body, '' ORDER BY k) FILTER (NOT chosen AND k > n), '') END AS rejected,
    CASE WHEN bool_or(chosen) THEN coalesce(string_agg((upto - length(coalesce(text, '')) - 8)::BIGINT || '-' || upto::BIGINT, ',' ORDER BY k) FILTER (chosen AND k > n AND role = 'assistant'), '') END AS chosen_spans,
    CASE WHEN bool_or(NOT chosen) THEN coalesce(string_agg((upto - length(coalesce(text, '')) - 8)::BIGINT || '-' || upto::BIGINT, ',' ORDER BY k) FILTER (NOT chosen AND k > n AND role = 'assistant'), '') END AS rejected_spans
  FROM placed GROUP BY pair_id, n
)
SELECT *, coalesce(chosen_spans <> '' AND rejected_spans <> '' AND chosen <> rejected, false) AS usable FROM made
"""

OP8 = f"""
WITH sized AS (
  SELECT doc_id, source, len({WORDS.format("text")}) AS size,
    md5(coalesce(doc_id::VARCHAR, 'null') || ':' || coalesce(text, '')) AS h,
    row_number() OVER (PARTITION BY source, doc_id, coalesce(text, '')) AS n
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS weight
  FROM sized GROUP BY source
), filling AS (
  SELECT *, source_size * 3 AS cap,
    sum(source_size) OVER () - coalesce(sum(source_size * 3) OVER (ORDER BY source_size * 3 / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS r,
    sum(weight) OVER (ORDER BY source_size * 3 / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w,
    row_number() OVER (ORDER BY source_size * 3 / weight, source NULLS LAST) AS n
  FROM sources
), edge AS (
  SELECT arg_min(r, n) AS r, arg_min(w, n) AS w, coalesce(min(n), 1e18) AS n FROM filling WHERE cap * w > weight * r
), target AS (
  SELECT f.source, f.source_size,
    CASE WHEN f.n < e.n THEN f.cap::DOUBLE ELSE (f.weight * e.r)::DOUBLE / e.w::DOUBLE END AS target
  FROM filling f, edge e
), budget AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS copies FROM target
), running AS (
  SELECT source, h, words, alike, sum(words) OVER (PARTITION BY source ORDER BY h) AS cum
  FROM (SELECT source, h, sum(size) AS words, count(*) AS alike FROM sized GROUP BY source, h)
), threshold AS (
  SELECT b.source, min(h) AS h,
    arg_min(ceil((target - copies * source_size - (cum - words)) / (words / alike) - 0.5), h) AS take
  FROM running r JOIN budget b ON r.source IS NOT DISTINCT FROM b.source
  WHERE cum > target - copies * source_size GROUP BY b.source
)
SELECT doc_id, size, source_size, target,
  (size * (copies + CASE WHEN s.h < t.h OR (s.h = t.h AND s.n <= take) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sized s JOIN budget b ON s.source IS NOT DISTINCT FROM b.source
LEFT JOIN threshold t ON s.source IS NOT DISTINCT FROM t.source
"""

# The SQL for the n-gram join compares every pair of sets that share an n-gram.
OP9 = f"""
WITH RECURSIVE split AS (
  SELECT row_number() OVER () AS rid, doc_id, {WORDS.format("text")} AS w FROM documents
), gram AS (
  SELECT DISTINCT rid, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS g
  FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM split WHERE len(w) > 0)
), size AS (
  SELECT rid, count(*) AS n FROM gram GROUP BY rid
), pair AS (
  SELECT a, b FROM (SELECT x.rid AS a, y.rid AS b, count(*) AS c FROM gram x JOIN gram y ON x.g = y.g AND x.rid <> y.rid GROUP BY ALL)
  JOIN size s ON s.rid = a JOIN size t ON t.rid = b WHERE c * 1000 >= 800 * (s.n + t.n - c)
), reach AS (
  SELECT rid AS a, rid AS b FROM size UNION SELECT reach.a, pair.b FROM reach JOIN pair ON reach.b = pair.a
), class AS (
  SELECT a AS rid, min(doc_id) AS class_id FROM reach JOIN split ON split.rid = b GROUP BY a
), same AS (
  SELECT rid, min(doc_id) OVER (PARTITION BY gs) AS copy_id
  FROM (SELECT rid, list(g ORDER BY g) AS gs FROM gram GROUP BY rid) JOIN split USING (rid)
), links AS (
  SELECT a AS rid, count(*) AS n FROM pair GROUP BY a
)
SELECT doc_id, CASE WHEN len(w) > 0 THEN class_id ELSE doc_id END AS class_id, CASE WHEN len(w) > 0 THEN copy_id ELSE doc_id END AS copy_id,
  coalesce(n, 0) AS n_links
FROM split LEFT JOIN class USING (rid) LEFT JOIN same USING (rid) LEFT JOIN links USING (rid)
"""

OP12 = f"""
WITH doc AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, {WORDS.format("text")} AS w FROM documents
), failed AS (
  SELECT doc_id, part,
    (len(w) < 100)::INT + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT
    + 16 * (coalesce(doc_id, 9223372036854775807) > min(coalesce(doc_id, 9223372036854775807)) OVER (PARTITION BY t))::INT AS mask
  FROM doc
), known AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS bad FROM labels GROUP BY doc_id
), cell AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad
  FROM failed LEFT JOIN known USING (doc_id) GROUP BY part, mask
), letter AS (
  SELECT f, (1 << (ascii(f) - 65)) AS bit FROM (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f)
), perm AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letter a, letter b, letter c, letter d, letter e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), stage AS (
  SELECT filter_order, step::INT AS step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::BIGINT AS before
  FROM perm, (SELECT unnest(range(1, 6)) AS step)
)
SELECT part, filter_order, step,
  sum(CASE WHEN mask & (bit | before) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
  sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN n ELSE 0 END)::BIGINT AS removed,
  sum(CASE WHEN mask & bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
  sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
  sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
  sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN bad ELSE 0 END)::BIGINT AS toxic_lost,
  sum(CASE WHEN mask & bit <> 0 THEN n * 120 // bit_count(mask) ELSE 0 END)::BIGINT AS shapley
FROM cell, stage GROUP BY part, filter_order, step
"""

OP13 = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
    sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), drawn AS (
  SELECT doc_id, t, u, len(u) AS n,
    ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS k1, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS k2,
    ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM cut
), piece AS (
  SELECT doc_id, t, n, array_to_string(u[1:least(k1, k2)], '') AS p, array_to_string(u[least(k1, k2) + 1:greatest(k1, k2)], '') AS m,
    array_to_string(u[greatest(k1, k2) + 1:], '') AS s,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
         WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE t END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM piece
"""

ORACLE: dict[str, str] = {
    "op1_exact_search": OP1,
    "op4_quality_rules": OP4,
    "op6_chat_format": OP6,
    "op8_mixing": OP8,
    "op9_ngram_join": OP9,
    "op12_filter_audit": OP12,
    "op13_fill_middle": OP13,
}
