"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

from dugout.llm.license_scan import BASE, GAP, K, SHARE, SPLIT, STATEMENTS, reach
from dugout.llm.line_dedup import BLOCK_TAG, HIDDEN_PART, HOST, LEAST_PAGES, RATIO, TAG
from dugout.llm.mixing import MAX_EPOCHS, WEIGHTS, WORD
from dugout.llm.prefix_trie import FAMILY, PREFIXES


def _q(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


MIXING = f"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), {_q(WORD)})) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, {list(map(float, WEIGHTS))}[
           CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % {len(WEIGHTS)} + 1 AS BIGINT)]::DOUBLE AS w
  FROM d GROUP BY source),
c AS (SELECT *, source_size::DOUBLE * {MAX_EPOCHS} AS cap FROM s),
left_over AS (
  SELECT *, cap / w AS place,
         sum(source_size::DOUBLE) OVER () - coalesce(sum(cap) OVER o, 0) AS rest,
         sum(w) OVER () - coalesce(sum(w) OVER o, 0) AS rest_w
  FROM c
  WINDOW o AS (ORDER BY cap / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
water AS (
  SELECT rest AS level_rest, rest_w AS level_w, place AS level_place FROM left_over
  WHERE cap * rest_w >= w * rest ORDER BY place, source ASC NULLS LAST LIMIT 1),
t AS (
  SELECT source, source_size,
         CASE WHEN level_place IS NULL OR place < level_place THEN cap ELSE w * level_rest / level_w END AS target
  FROM left_over LEFT JOIN water ON true),
p AS (
  SELECT d.doc_id, d.size, d.source, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id ASC NULLS LAST, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, source,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE
         (budget // source_size) * size + least(greatest(budget % source_size - before, 0), size) END AS BIGINT) AS taken
FROM p
"""

LINE_DEDUP = f"""
WITH p AS (
  SELECT page_id, nullif(lower(regexp_extract(url, {_q(HOST)}, 1)), '') AS host,
         regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), {_q(HIDDEN_PART)}, ' ', 'g'),
           '[\\n\\r]+', ' ', 'g'), {_q(BLOCK_TAG)}, chr(10), 'g'), {_q(TAG)}, '', 'g') AS body,
         row_number() OVER () AS row_no
  FROM pages),
l AS (
  SELECT row_no, page_id, host, nth, trim(regexp_replace(raw, '[ \\t\\x0B\\f\\r]+', ' ', 'g')) AS line
  FROM (SELECT row_no, page_id, host, unnest(string_split(body, chr(10))) AS raw, generate_subscripts(string_split(body, chr(10)), 1) AS nth FROM p)),
k AS (SELECT * FROM l WHERE line <> ''),
hosts AS (SELECT host, count(*) AS host_pages FROM p GROUP BY host),
marked AS (
  SELECT k.host, k.line FROM k JOIN hosts ON k.host IS NOT DISTINCT FROM hosts.host
  GROUP BY k.host, k.line, host_pages
  HAVING count(DISTINCT row_no) >= {LEAST_PAGES} AND count(DISTINCT row_no)::DOUBLE / host_pages > {RATIO}),
judged AS (
  SELECT k.*, marked.line IS NOT NULL AS gone FROM k LEFT JOIN marked ON k.host IS NOT DISTINCT FROM marked.host AND k.line = marked.line)
SELECT p.page_id, p.host, hosts.host_pages, CAST(count(judged.line) AS INTEGER) AS n_lines,
       CAST(count(judged.line) FILTER (gone) AS INTEGER) AS n_dropped,
       coalesce(string_agg(judged.line, chr(10) ORDER BY nth) FILTER (NOT gone), '') AS text
FROM p JOIN hosts ON p.host IS NOT DISTINCT FROM hosts.host LEFT JOIN judged USING (row_no)
GROUP BY p.row_no, p.page_id, p.host, hosts.host_pages
"""

TEMPLATES = ", ".join(
    f"({i}, {_q(label)}, {base}, {phrase.split()})" for i, (phrase, label, base) in enumerate(
        [(p, x, "true") for p, x in BASE.items()] + [(p, x, "false") for p, x in STATEMENTS.items()]))

FARTHEST = max(reach(len(p.split()) - K + 1) for p in STATEMENTS)

LICENSE_SCAN = f"""
WITH t AS (SELECT * FROM (VALUES {TEMPLATES}) v(template, label, is_base, words)),
size AS (SELECT template, label, is_base, len(words) - {K - 1} AS grams FROM t),
tg AS (SELECT template, unnest(range(0, len(words) - {K - 1})) AS nth, words FROM t),
d AS (
  SELECT row_number() OVER () AS row_no, doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_q(SPLIT)}),
                     lambda x: x <> '') AS words
  FROM documents),
g AS (SELECT row_no, unnest(words) AS a, generate_subscripts(words, 1) - 1 AS pos FROM d),
gg AS (SELECT row_no, pos, a, lead(a) OVER (PARTITION BY row_no ORDER BY pos) AS b FROM g),
hits AS (SELECT row_no, template, nth, pos, pos - nth AS diagonal FROM gg JOIN tg ON gg.a = tg.words[nth + 1] AND gg.b = tg.words[nth + 2]),
votes AS (
  SELECT row_no, template, diagonal, count(DISTINCT pos) AS votes, min(pos) AS lo, max(pos) AS hi, list(DISTINCT nth) AS nths
  FROM hits GROUP BY ALL),
v AS (SELECT * FROM votes JOIN size USING (template)),
near AS (
  SELECT *, list({{'d': diagonal, 'nths': nths}}) OVER (PARTITION BY row_no, template ORDER BY diagonal RANGE BETWEEN CURRENT ROW AND {FARTHEST} FOLLOWING) AS near,
         CAST(ceil(round((1 - {SHARE}) * grams, 9)) AS BIGINT) * {GAP} AS reach
  FROM v WHERE NOT is_base AND votes < grams),
merged AS (
  SELECT row_no, label, is_base, diagonal,
         len(list_distinct(flatten(list_transform(list_filter(near, lambda x: x.d <= diagonal + reach), lambda x: x.nths)))) / grams::DOUBLE AS score FROM near),
spans AS (
  SELECT row_no, label, is_base, diagonal AS first_word, 1.0::DOUBLE AS score FROM v WHERE votes = grams
  UNION ALL
  SELECT row_no, label, is_base, diagonal, score FROM merged WHERE score >= {SHARE})
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, count(*) FILTER (is_base)::BIGINT AS n_base,
       min(first_word) FILTER (is_base)::BIGINT AS first_word, max(first_word) FILTER (is_base)::BIGINT AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (is_base), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, coalesce(max(score), 0.0)::DOUBLE AS score
FROM d LEFT JOIN spans USING (row_no) GROUP BY d.row_no, d.doc_id, d.words
"""

CRC32 = """xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT),
  lambda a, b: list_reduce([xor(a, b)] || range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)), 4294967295)"""

PREFIX_TRIE = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn ASC NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS nth
  FROM conversations WHERE conv_id IS NOT NULL),
s AS (SELECT conv_id, conv_id - conv_id % {FAMILY} AS base, {CRC32} % {PREFIXES} AS h, n FROM (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id)),
c AS (SELECT s.*, least(s.h, coalesce(b.n, 0)) AS k FROM s LEFT JOIN s b ON b.conv_id = s.base),
r AS (
  SELECT conv_id, k + nth - h AS depth, role, text FROM c JOIN t USING (conv_id) WHERE nth > h
  UNION ALL
  SELECT c.conv_id, nth, role, text FROM c JOIN t ON t.conv_id = c.base WHERE nth <= k),
p AS (
  SELECT conv_id, depth, len(text) AS chars, string_agg(md5(role) || md5(text), '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM r
  UNION ALL
  SELECT conv_id, 0, 0, '' FROM c),
e AS (SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM p),
n AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(chars) AS chars,
         string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends) AS ids
  FROM e GROUP BY path, depth),
k AS (SELECT left(path, 64 * (depth - 1)) AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
w AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (path)),
sub AS (
  SELECT left(path, 64 * d) AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * chars) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM w) GROUP BY 1)
SELECT w.conv_id, w.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, w.n_convs::BIGINT AS n_convs, w.n_children::BIGINT AS n_children,
       n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(w.ids, '')) AS ends_sha256
FROM w JOIN sub USING (path) LEFT JOIN n up ON w.depth > 0 AND up.path = left(w.path, 64 * (w.depth - 1))
"""

ORACLE: dict[str, str] = {"op6_line_dedup": LINE_DEDUP, "op7_mixing": MIXING, "op9_license_scan": LICENSE_SCAN,
                          "op12_prefix_trie": PREFIX_TRIE}
