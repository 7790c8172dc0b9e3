"""DuckDB equivalents of the operators that SQL can express."""

from __future__ import annotations

from lodgelake.llm.licenses import COVERAGE, GRAM, SLOP, TEMPLATES

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL: dict[str, str] = {}

SQL["op2_decontaminate"] = rf"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents
), item AS (
  SELECT item_id, {_WORDS} AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, list_slice(w, s, s + 12) AS g
  FROM item, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS t(s) WHERE len(w) > 0
), size AS (SELECT DISTINCT len(g) AS n FROM win),
hit AS (
  SELECT DISTINCT d.r, d.s, d.n, win.item_id
  FROM (SELECT r, n, s, list_slice(w, s, s + n - 1) AS g
        FROM doc, size, unnest(range(1, len(w) - n + 2)) AS t(s)) d JOIN win USING (g)
), word AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hit) GROUP BY r
), listed AS (
  SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM hit WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN word USING (r) LEFT JOIN listed USING (r)
"""

_TEMPLATES = ", ".join(f"({k}, '{t.label}', '{t.text}', {t.base})" for k, t in enumerate(TEMPLATES))

SQL["op3_licenses"] = rf"""
WITH template AS (
  SELECT template, label, base, {_WORDS} AS w FROM (VALUES {_TEMPLATES}) AS v(template, label, text, base)
), place AS (
  SELECT template, label, base, spot, list_slice(w, spot + 1, spot + least({GRAM}, len(w))) AS g,
         greatest(len(w) - {GRAM} + 1, 1) AS n_grams
  FROM template, unnest(range(greatest(len(w) - {GRAM} + 1, 1))) AS t(spot)
), doc AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents
), word AS (
  SELECT r, pos, list(w) OVER (PARTITION BY r ORDER BY pos ROWS BETWEEN CURRENT ROW AND {GRAM - 1} FOLLOWING) AS g
  FROM (SELECT r, unnest(w) AS w, generate_subscripts(w, 1) - 1 AS pos FROM doc)
), gram AS (
  SELECT r, pos, list_slice(g, 1, n) AS g FROM word, (SELECT DISTINCT len(g) AS n FROM place) AS size
  WHERE len(g) >= n AND g[1] IN (SELECT g[1] FROM place)
), vote AS (
  SELECT r, template, label, base, n_grams, pos - spot AS diagonal, pos, spot FROM gram JOIN place USING (g)
), step AS (
  SELECT *, diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) AS gap
  FROM (SELECT DISTINCT r, template, n_grams, diagonal FROM vote)
), diagonals AS (
  SELECT r, template, diagonal, sum(CASE WHEN gap <= CASE WHEN n_grams = 1 THEN 0 ELSE {SLOP} END THEN 0 ELSE 1 END)
    OVER (PARTITION BY r, template ORDER BY diagonal) AS span
  FROM step
), good AS (
  SELECT r, label, base, min(pos) AS start, count(DISTINCT spot) / n_grams AS coverage
  FROM vote JOIN diagonals USING (r, template, diagonal)
  GROUP BY r, template, label, base, n_grams, span HAVING count(DISTINCT spot) / n_grams >= {COVERAGE}
)
SELECT doc_id, len(w)::BIGINT AS n_words, count(*) FILTER (WHERE base) AS n_base,
       (min(start) FILTER (WHERE base))::BIGINT AS first_word, (max(start) FILTER (WHERE base))::BIGINT AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels,
       coalesce(max(coverage), 0.0)::DOUBLE AS score
FROM doc LEFT JOIN good USING (r) GROUP BY r, doc_id, len(w)
"""

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

SQL["op4_warc"] = r"""
WITH page AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, upper(sha1(coalesce(html, ''))) AS h,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS newest
  FROM pages
)
SELECT page_id, payload_bytes,
       list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(h, 5 * (k // 4) + 1, 5))::INTEGER >> (15 - 5 * (k % 4))) & 31) + 1, 1)
         FOR k IN range(32)], 'string_agg', '') AS payload_digest,
       CASE WHEN newest IS NULL OR page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN newest IS NULL OR page_id = newest THEN NULL ELSE newest END AS refers_to
FROM page
"""


def _url_tree(z: float = 2.58, prior: float = 5.0, purity: float = 0.6, bins: int = 100) -> str:
    return rf"""
WITH RECURSIVE url AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), part AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), {_LOWER}), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM url
), judged AS (
  SELECT *, CASE
      WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM part
), ruled AS (
  SELECT *, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' END AS ruled,
         list_slice(parts, 2, len(parts)) AS template
  FROM (SELECT *, string_split(regexp_replace(path, '[0-9]+', '*', 'g'), '/') AS parts FROM judged)
), counts AS (
  SELECT host, template, count(*)::BIGINT AS n, count(*) FILTER (coalesce(ruled = 'block', regexp_matches(
         host || path, '(?i)(^|[^a-z])(ads|adult|bets|casino|pills|porn|spam|viagra|xxx)([^a-z]|$)')))::BIGINT AS bad
  FROM ruled GROUP BY host, template
), tree AS (  -- a row of a node that is cut goes on, a segment shorter, into its branch
  SELECT host, template, n, bad, host AS node, template AS rest, 0 AS level FROM counts
  UNION ALL
  SELECT host, template, n, bad, node || '/' || branch, rest[2:], level + 1 FROM (
    SELECT *, sum(cut) OVER (PARTITION BY node ORDER BY bin) AS branch FROM (
      SELECT *, CASE WHEN bin <> before AND abs(bin_bad::DOUBLE / bin_n::DOUBLE - last_bad::DOUBLE / last_n::DOUBLE)
               > {z}::DOUBLE * sqrt(pool * (1 - pool) * (1 / bin_n::DOUBLE + 1 / last_n::DOUBLE)) THEN 1 ELSE 0 END AS cut
      FROM (SELECT *, (bin_bad + last_bad + 1)::DOUBLE / (bin_n + last_n + 2)::DOUBLE AS pool FROM (
        SELECT *, lag(bin) OVER o AS before, lag(bin_n) OVER o AS last_n, lag(bin_bad) OVER o AS last_bad FROM (
          SELECT *, sum(n) OVER (PARTITION BY node, bin)::BIGINT AS bin_n, sum(bad) OVER (PARTITION BY node, bin)::BIGINT AS bin_bad
          FROM (SELECT *, ({bins} * sum(bad) OVER s)::BIGINT // (sum(n) OVER s)::BIGINT AS bin FROM (
            SELECT *, sum(bad) OVER k AS all_bad, sum(n) OVER k AS all_n, min(rest) OVER k <> max(rest) OVER k AS several
            FROM tree WINDOW k AS (PARTITION BY node))
            WHERE several AND all_bad > 0 AND all_bad < all_n
            WINDOW s AS (PARTITION BY node, rest[1])))
        WINDOW o AS (PARTITION BY node ORDER BY bin)))))
), total AS (SELECT sum(bad)::DOUBLE / sum(n)::DOUBLE AS share FROM counts),
ends AS (SELECT host, template, n, bad, arg_max(node, level) AS node FROM tree GROUP BY host, template, n, bad),
leaf AS (
  SELECT node, (sum(bad)::DOUBLE + {prior}::DOUBLE * share) / (sum(n)::DOUBLE + {prior}::DOUBLE) AS purity
  FROM ends, total GROUP BY node, share
)
SELECT page_id, host, path, rule,
       coalesce(ruled, CASE WHEN purity >= {purity}::DOUBLE THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled JOIN ends USING (host, template) JOIN leaf USING (node)
"""


SQL["op6_url_tree"] = _url_tree()

SQL["op10_mixing"] = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, *, coalesce(CAST(doc_id AS VARCHAR), 'text:' || coalesce(text, '')) AS who,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS words
  FROM documents
), per AS (
  SELECT source, sum(words)::BIGINT AS n_words,
         (CASE WHEN sum(words) > 0 THEN sqrt(sum(words)::DOUBLE) ELSE 0 END)::DECIMAL(28,6) AS weight
  FROM doc GROUP BY source
), rate AS (
  SELECT source, CASE WHEN weight > 0 THEN
    (SELECT sum(n_words) FROM per)::DOUBLE * weight::DOUBLE
      / ((SELECT sum(weight) FROM per)::DOUBLE * n_words::DOUBLE) ELSE 0 END AS rate
  FROM per
), steps AS (
  SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS upto
  FROM (SELECT source, k, exp(-rate + k * ln(rate) - lgamma(k + 1)) AS p
        FROM rate, unnest(range(0, ceil(rate + 10 * sqrt(rate) + 20)::BIGINT + 1)) AS t(k) WHERE rate > 0)
), drawn AS (
  SELECT r, source, ('0x' || substr(md5('mix-1:draw:' || who), 1, 13))::BIGINT / 4503599627370496.0 AS u FROM doc
), copies AS (
  SELECT r, count(*)::INTEGER AS copies FROM drawn JOIN steps
    ON drawn.source IS NOT DISTINCT FROM steps.source AND upto <= u GROUP BY r
)
SELECT doc_id, text, lang, source, n_chars, copies, copy_no::INTEGER AS copy_no,
       substr(md5('mix-1:order:' || who || ':' || CAST(copy_no AS VARCHAR)), 1, 16) AS mix_key
FROM doc JOIN copies USING (r), unnest(range(1, copies + 1)) AS t(copy_no)
"""

SQL["op11_hard_negatives"] = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.r, a.vec_id AS anchor_id, b.r AS o, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_dot_product(a.e, b.e) AS BIGINT) AS s
  FROM v AS a, v AS b WHERE a.vec_id % 50 = 0 AND a.r <> b.r
), positive AS (
  SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY r ORDER BY s DESC, id) <= 5
)
SELECT p.anchor_id, p.id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.r, p.o ORDER BY n.s DESC, n.id) AS INTEGER) AS rank,
       n.id AS negative_id, p.s AS positive_score, n.s AS negative_score
FROM positive AS p JOIN scored AS n ON n.r = p.r AND NOT n.same AND 50 * p.s <= 100 * n.s AND 100 * n.s <= 95 * p.s
QUALIFY row_number() OVER (PARTITION BY p.r, p.o ORDER BY n.s DESC, n.id) <= 3
"""

_PARTS = r"""string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')"""

SQL["op12_collocations"] = rf"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(p, '[^\x20\x09]+') AS w
  FROM documents, unnest({_PARTS}) AS t(p)
), f AS (
  SELECT lang, k, list_slice(w, s, s + k - 1) AS g, count(*) AS n
  FROM piece, unnest([1, 2, 3]) AS t(k), unnest(range(1, len(w) - k + 2)) AS u(s)
  GROUP BY ALL
), phrase AS (SELECT lang, k, g, n AS a FROM f WHERE k > 1 AND n >= 10),
cut AS (
  SELECT p.*, c, l.n AS l, r.n AS r,
         CAST(1000000::HUGEINT * p.a * p.a // (l.n::HUGEINT * r.n) AS BIGINT) AS score
  FROM phrase AS p, unnest(range(1, k)) AS t(c)
  JOIN f AS l ON l.lang = p.lang AND l.g = list_slice(p.g, 1, c)
  JOIN f AS r ON r.lang = p.lang AND r.g = list_slice(p.g, c + 1, p.k)
), worst AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, c) = 1
), inside AS (
  SELECT lang, list_slice(g, s, s + 1) AS g, max(a) AS most
  FROM phrase, unnest([1, 2]) AS t(s) WHERE k = 3 GROUP BY ALL
), kept AS (
  SELECT w.*, array_to_string(w.g, ' ') AS phrase FROM worst AS w LEFT JOIN inside AS i ON i.lang = w.lang AND i.g = w.g
  WHERE i.most IS NULL OR 100 * i.most < 50 * w.a
), total AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN total USING (lang)
QUALIFY rank <= 2000
"""
