"""The contracts in DuckDB SQL, written apart from the Spark code."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3 = f"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), item AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item, w[i:i + least(10, len(w)) - 1] AS win, least(10, len(w)) AS n
  FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM item WHERE len(w) > 0)
), lens AS (SELECT DISTINCT n FROM win),
place AS (
  SELECT doc_id, i, n, w[i:i + n - 1] AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, lens)
), hit AS (SELECT DISTINCT doc_id, i, place.n, item FROM place JOIN win ON place.win = win.win AND place.n = win.n),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

# What a turn quotes are the turns before it; equal words belong to the earliest turn.
OP4 = f"""
WITH RECURSIVE turn AS (
  SELECT conv_id, turn, trim({_LOWER.format("regexp_replace(min(coalesce(text, '')), '[ \\x09-\\x0D]+', ' ', 'g')")}, ' ') AS said
  FROM conversations GROUP BY conv_id, turn
), first AS (
  SELECT said, arg_min(conv_id, (conv_id, turn)) AS c, arg_min(turn, (conv_id, turn)) AS t FROM turn WHERE said <> '' GROUP BY said
), quote AS (
  SELECT x.conv_id, x.turn, l.level, f.c, f.t FROM turn x, (VALUES (1), (2)) AS l(level)
  JOIN turn y ON y.conv_id = x.conv_id AND y.turn = x.turn - level JOIN first f ON f.said = y.said
), parent AS (
  SELECT conv_id, turn, arg_min(c, level) AS pc, arg_min(t, level) AS pt FROM quote GROUP BY conv_id, turn
), thread AS (
  SELECT conv_id, turn, conv_id AS rc, turn AS rt, 0 AS depth FROM turn WHERE (conv_id, turn) NOT IN (SELECT (conv_id, turn) FROM parent)
  UNION ALL SELECT p.conv_id, p.turn, rc, rt, depth + 1 FROM thread JOIN parent p ON p.pc = thread.conv_id AND p.pt = thread.turn
)
SELECT conv_id, turn, rc AS root_conv_id, rt AS root_turn, pc AS parent_conv_id, pt AS parent_turn, depth, sha256(said) AS own_sha256
FROM turn JOIN thread USING (conv_id, turn) LEFT JOIN parent USING (conv_id, turn)
"""

OP7 = f"""
WITH doc AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
line AS (
  SELECT doc_id, i, l[i] AS line, {_LOWER.format("regexp_replace(l[i], '^[ \\x09-\\x0D]+|[ \\x09-\\x0D]+$', '', 'g')")} AS key
  FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM doc)
), first AS (SELECT key, min(doc_id) AS keeper FROM line WHERE length(key) >= 10 GROUP BY key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (keeper <> doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (keeper IS NULL OR keeper = doc_id), '')) AS kept_sha256
FROM line LEFT JOIN first USING (key) GROUP BY doc_id
"""

# The block list: hosts with an unwanted word in a label.
OP8 = f"""
WITH part AS (
  SELECT page_id, {_LOWER.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")} AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages
), listed AS (
  SELECT DISTINCT host AS entry FROM part
  WHERE len(list_intersect(regexp_split_to_array(host, '[.-]'), ['adult', 'ads', 'bets', 'casino', 'pills', 'spam'])) > 0
), named AS (
  SELECT DISTINCT host FROM (SELECT host, unnest(string_split(host, '.')) AS label, unnest(range(1, len(string_split(host, '.')) + 1)) AS i FROM part)
  JOIN listed ON array_to_string(string_split(host, '.')[i:], '.') = entry
), ruled AS (
  SELECT *, ('.' || host) LIKE '%.com' AS com, ('.' || host) LIKE '%.example.com' AS example, ('.' || host) LIKE '%.www.example.com' AS www,
         ('.' || host) LIKE '%.net' AS net FROM part
), picked AS (
  SELECT page_id, host, path, CASE WHEN www AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN example AND starts_with(path, '/en/') THEN 'example.com/en/' WHEN net AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN net AND starts_with(path, '/fr/') THEN 'net/fr/' WHEN com AND starts_with(path, '/') THEN 'com/' END AS rule FROM ruled
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN host IN (SELECT host FROM named) THEN 'block' ELSE 'allow' END AS verdict
FROM picked
"""

OP9 = """
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g') AS bare FROM documents
)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY bare) AS group_size,
       doc_id = first_value(doc_id) OVER best AS kept, sha256(bare) AS text_sha256
FROM t WINDOW best AS (PARTITION BY bare ORDER BY n DESC, doc_id)
"""

OP10 = f"""
WITH RECURSIVE doc AS (
  SELECT doc_id, list_filter(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM doc WHERE len(w) > 0)
), size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
link AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id <> y.doc_id
  JOIN size sx ON sx.doc_id = x.doc_id JOIN size sy ON sy.doc_id = y.doc_id
  WHERE 100 * least(sx.n, sy.n) >= 80 * greatest(sx.n, sy.n)
  GROUP BY x.doc_id, y.doc_id, sx.n, sy.n HAVING 100 * count(*) >= 80 * (sx.n + sy.n - count(*))
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.other
)
SELECT doc_id, coalesce(max(n), 0) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reach LEFT JOIN size USING (doc_id) GROUP BY doc_id
"""

# Terms are runs of digits, ASCII letters and everything beyond ASCII.
_TERMS = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
OP12 = f"""
WITH doc AS (
  SELECT doc_id, {_TERMS.format(_LOWER.format("coalesce(text, '')"))} AS t FROM documents
), size AS (SELECT doc_id, CAST(len(t) AS BIGINT) AS n FROM doc WHERE len(t) > 0),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM size),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM doc) GROUP BY doc_id, term),
asked AS (
  SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS.format(_LOWER.format("coalesce(text, '')"))}) AS term FROM benchmark)
), weight AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tf, whole WHERE term IN (SELECT term FROM asked) GROUP BY term, docs
), score AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * docs) // words))))) AS BIGINT) AS score
  FROM asked JOIN weight USING (term) JOIN tf USING (term) JOIN size USING (doc_id), whole GROUP BY item_id, doc_id
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM score WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 10
"""

TWINS = {
    "op4_quotation_linking": OP4,
    "op3_benchmark_decontamination": OP3,
    "op7_line_dedup": OP7,
    "op8_url_filter": OP8,
    "op9_exact_dedup": OP9,
    "op10_minhash_near_dedup": OP10,
    "op12_ranked_search": OP12,
}
