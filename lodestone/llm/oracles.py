"""SQL of its own, written by hand for the checking database, for the operators that SQL can express on whole tables.

Operators 3, 4, 6, 7, 8 and 10 have none: hashes of the engine, fitted models, byte
pairs and windows of bytes are held against brute force in the tests instead.
"""

from __future__ import annotations

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Lines as sets of words; rare words first; a pair of similar sets shares a word among the first n - ceil(0.8 n) + 1 of both.
LINE_DEDUP = """
WITH l AS (
 SELECT doc_id, unnest(string_split(text, chr(10))) AS value, generate_subscripts(string_split(text, chr(10)), 1) AS line
 FROM documents WHERE text IS NOT NULL),
s AS (SELECT doc_id, line, value, list_sort(list_distinct(list_filter(string_split(value, ' '), lambda x: x <> ''))) AS words FROM l),
first AS (SELECT words, len(words) AS n, min((doc_id, line)) AS place, row_number() OVER () AS c FROM s WHERE len(words) > 0 GROUP BY words),
w AS (SELECT c, n, unnest(words) AS word FROM first),
rare AS (SELECT word, count(*) AS many FROM w GROUP BY word),
ranked AS (SELECT c, n, word, row_number() OVER (PARTITION BY c ORDER BY many, word) AS pos FROM w JOIN rare USING (word)),
prefix AS (SELECT c, n, word FROM ranked WHERE pos <= n - ceil(80 * n / 100.0) + 1),
pairs AS (SELECT DISTINCT x.c AS a, y.c AS b FROM prefix x JOIN prefix y ON x.word = y.word AND x.c < y.c AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)),
near AS (
 SELECT CASE WHEN x.place > y.place THEN a ELSE b END AS c
 FROM pairs JOIN first x ON x.c = a JOIN first y ON y.c = b
 WHERE 100 * len(list_intersect(x.words, y.words)) >= 80 * (x.n + y.n - len(list_intersect(x.words, y.words)))),
kept AS (
 SELECT s.doc_id, s.line, s.value, coalesce((s.doc_id, s.line) <> first.place OR first.c IN (SELECT c FROM near), false) AS gone
 FROM s LEFT JOIN first ON s.words = first.words)
SELECT d.doc_id, count(k.line) AS n_lines, count(*) FILTER (WHERE k.gone) AS n_removed,
 sha256(coalesce(string_agg(k.value, chr(10) ORDER BY k.line) FILTER (WHERE NOT k.gone), '')) AS kept_sha256
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id GROUP BY d.doc_id
"""

NGRAM_JOIN = f"""
WITH RECURSIVE w AS (SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
sets AS (
 SELECT DISTINCT doc_id, array_to_string(w[s : s + 3], ' ') AS g
 FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS s FROM w WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sets x JOIN sets y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, b FROM reach r JOIN ways ON r.other = a)
SELECT r.doc_id, coalesce(max(size.n), 0) AS n_shingles, min(other) AS component_id FROM reach r LEFT JOIN size ON size.doc_id = r.doc_id GROUP BY r.doc_id
"""

_WORDS = f"coalesce(regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), [])"
DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
 SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[s : s + least(10, len(w)) - 1], ' ') AS g
 FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
places AS (SELECT doc_id, k, s, array_to_string(w[s : s + k - 1], ' ') AS g FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, (SELECT DISTINCT k FROM windows))),
found AS (SELECT DISTINCT doc_id, p.k, s, item_id FROM places p JOIN windows v ON p.g = v.g AND p.k = v.k),
hit AS (SELECT doc_id, count(DISTINCT word) AS n FROM (SELECT doc_id, unnest(range(s, s + k)) AS word FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS named FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items, sha256(coalesce(named, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
"""

_MARKS = "^((?:[ \\t]{0,3}>)+) ?"
_ANNOUNCES = "^\\s*(?:On\\b.{0,200}\\bwrote|Am\\b.{0,200}\\bschrieb.{0,80}|Le\\b.{0,200}\\ba écrit|El\\b.{0,200}\\bescribió)\\s?:\\s*$"
_LEVEL = f"len(regexp_replace(regexp_extract(value, '{_MARKS}', 1), '[^>]', '', 'g'))"
QUOTATION_LINKING = f"""
WITH RECURSIVE m AS (
 SELECT conv_id, turn, role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS FIRST, coalesce(text, '')) - 1 AS seq
 FROM conversations),
cut AS (SELECT conv_id, seq, unnest(string_split_regex(text, '\\r?\\n')) AS value, generate_subscripts(string_split_regex(text, '\\r?\\n'), 1) AS line FROM m),
lines AS (SELECT *, {_LEVEL} AS level, trim(regexp_replace(lower(regexp_replace(value, '{_MARKS}', '')), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) AS said FROM cut),
begun AS (
 SELECT *, CASE WHEN lag(level, 1, -1) OVER o <> level OR lag(said, 1, '') OVER o = '' THEN 1 ELSE 0 END AS new
 FROM lines WINDOW o AS (PARTITION BY conv_id, seq ORDER BY line)),
runs AS (SELECT *, sum(new) OVER (PARTITION BY conv_id, seq ORDER BY line) AS run FROM begun),
passages AS (
 SELECT conv_id, seq, level, min(line) AS line, 0 AS part, string_agg(said, ' ' ORDER BY line) AS said FROM runs WHERE said <> '' GROUP BY conv_id, seq, level, run
 UNION ALL SELECT conv_id, seq, level, line, 1, said FROM runs WHERE said <> ''),
quotes AS (
 SELECT q.conv_id, q.seq, q.level, q.line, q.part, max(o.seq) AS original
 FROM passages q LEFT JOIN passages o ON q.conv_id IS NOT DISTINCT FROM o.conv_id AND q.said = o.said AND o.level = 0 AND o.seq < q.seq
 WHERE q.level > 0 GROUP BY ALL),
linked AS (
 SELECT conv_id, seq, count(*) FILTER (WHERE part = 0) AS n_quotes, count(*) FILTER (WHERE part = 0 AND original IS NOT NULL) AS n_linked,
  arg_min(original, (level, line, part)) FILTER (WHERE original IS NOT NULL) AS quoted
 FROM quotes GROUP BY conv_id, seq),
own AS (
 SELECT conv_id, seq, string_agg(value, chr(10) ORDER BY line) FILTER (WHERE level = 0 AND NOT (regexp_matches(value, '{_ANNOUNCES}') AND following > 0)) AS own, max(level) AS most
 FROM (SELECT *, lead(level, 1, 0) OVER (PARTITION BY conv_id, seq ORDER BY line) AS following FROM lines) GROUP BY conv_id, seq),
t AS (
 SELECT m.*, coalesce(n_quotes, 0) AS n_quotes, coalesce(n_linked, 0) AS n_linked, CASE WHEN m.seq > 0 THEN coalesce(quoted, m.seq - 1) END AS parent,
  CASE WHEN most > 0 THEN regexp_replace(coalesce(own, ''), '^\\s+|\\s+$', '', 'g') ELSE text END AS plain
 FROM m JOIN own ON m.conv_id IS NOT DISTINCT FROM own.conv_id AND m.seq = own.seq
 LEFT JOIN linked ON m.conv_id IS NOT DISTINCT FROM linked.conv_id AND m.seq = linked.seq),
deep AS (
 SELECT conv_id, seq, 0 AS depth FROM t WHERE seq = 0
 UNION ALL SELECT t.conv_id, t.seq, deep.depth + 1 FROM deep JOIN t ON t.conv_id IS NOT DISTINCT FROM deep.conv_id AND t.parent = deep.seq)
SELECT t.conv_id, row_number() OVER (PARTITION BY t.conv_id ORDER BY depth, t.seq) AS position, t.turn, t.role, t.plain AS text, p.turn AS parent_turn, CAST(depth AS BIGINT) AS depth, t.n_quotes, t.n_linked
FROM t JOIN deep ON t.conv_id IS NOT DISTINCT FROM deep.conv_id AND t.seq = deep.seq
LEFT JOIN t p ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND p.seq = t.parent
"""

ORACLE: dict[str, str] = {
    "op1_line_dedup": LINE_DEDUP,
    "op2_ngram_join": NGRAM_JOIN,
    "op5_decontamination": DECONTAMINATION,
    "op9_quotation_linking": QUOTATION_LINKING,
}
