"""DuckDB SQL for the training-data queries that SQL can express."""

# Words of a size: runs of anything but blanks.
OP1 = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1 AS rank
  FROM sized GROUP BY source),
ranked AS (
  SELECT *, ([5.0, 2.0, 1.0])[(rank % 3 + 1)::INT]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS most FROM sources),
total AS (SELECT sum(source_size)::BIGINT AS all_size FROM sources),
water(step, level, nfull, done) AS (
  SELECT 0, 0.0::DOUBLE, -1::BIGINT, false
  UNION ALL
  SELECT w.step + 1,
         CASE WHEN s.nfull = w.nfull OR s.open = 0 THEN w.level ELSE (1.5::DOUBLE * t.all_size - s.used) / s.open END,
         s.nfull, s.nfull = w.nfull OR s.open = 0
  FROM water w, total t, LATERAL (
    SELECT sum(CASE WHEN most <= w.level * weight THEN most ELSE 0.0 END)::DOUBLE AS used,
           sum(CASE WHEN most <= w.level * weight THEN 0.0 ELSE weight END)::DOUBLE AS open,
           sum(CASE WHEN most <= w.level * weight THEN 1 ELSE 0 END)::BIGINT AS nfull FROM ranked) s
  WHERE NOT w.done),
goals AS (
  SELECT source, rank, source_size, least(most, (SELECT level FROM water ORDER BY step DESC LIMIT 1) * weight) AS target FROM ranked),
queue AS (
  SELECT s.doc_id, s.size, g.rank, g.target, e.epoch,
         md5(concat_ws(':', '17', e.epoch::VARCHAR, coalesce(s.doc_id::VARCHAR, ''))) AS draw
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
  JOIN (VALUES (0), (1)) e(epoch) ON e.epoch = 0 OR g.target > g.source_size),
timed AS (
  SELECT *, CASE WHEN target > 0 THEN sum(size) OVER (PARTITION BY rank ORDER BY epoch, draw, doc_id, size ROWS UNBOUNDED PRECEDING)::DOUBLE / target
                 ELSE 0.0 END AS finish FROM queue),
spent AS (
  SELECT *, sum(size) OVER (ORDER BY finish, rank, epoch, draw, doc_id, size ROWS UNBOUNDED PRECEDING) AS spent FROM timed),
copies AS (
  SELECT doc_id, count(*)::BIGINT AS copies FROM spent
  WHERE spent <= round((SELECT sum(target) FROM goals), 3) GROUP BY doc_id)
SELECT s.doc_id, s.size, g.source_size, g.target, coalesce(c.copies, 0)::BIGINT * s.size AS taken, s.source,
       coalesce(c.copies, 0)::BIGINT AS copies
FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source LEFT JOIN copies c ON s.doc_id = c.doc_id
"""

OP9 = r"""
WITH docs AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
items AS (
  SELECT item_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, list_slice(w, i, i + least(10, len(w)) - 1) AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM windows),
doc_windows AS (
  SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lengths WHERE len(w) >= n)),
hits AS (SELECT d.doc_id, d.i, d.n, w.item_id FROM doc_windows d JOIN windows w ON d.n = w.n AND d.win = w.win),
hit_words AS (SELECT doc_id, count(DISTINCT p)::BIGINT AS n_hit FROM (
  SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*)::BIGINT AS n_items, string_agg(id, ',' ORDER BY encode(id)) AS ids FROM (
  SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(i.n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit_words h ON d.doc_id = h.doc_id LEFT JOIN hit_items i ON d.doc_id = i.doc_id
"""

OP4 = r"""
WITH lines AS (
  SELECT doc_id, source, p AS pos, l AS raw, trim(l, ' ' || chr(9) || chr(13)) AS line
  FROM (SELECT doc_id, source, unnest(range(len(string_split(text, chr(10))))) AS p, unnest(string_split(text, chr(10))) AS l
        FROM documents WHERE text IS NOT NULL)),
wide AS (
  SELECT line, min((doc_id, pos)) AS first FROM lines WHERE line <> '' GROUP BY line
  HAVING count(DISTINCT coalesce('s' || source, '')) >= 3),
marked AS (
  SELECT l.*, w.line IS NOT NULL AND (l.doc_id, l.pos) <> w.first AS gone FROM lines l LEFT JOIN wide w ON l.line = w.line),
texts AS (
  SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_removed,
         coalesce(string_agg(pos::VARCHAR, ',' ORDER BY pos) FILTER (gone), '') AS removed_lines,
         coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS kept
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(t.n_lines, 0)::BIGINT AS n_lines, coalesce(t.n_removed, 0)::BIGINT AS n_removed,
       coalesce(t.removed_lines, '') AS removed_lines, length(t.kept)::BIGINT AS kept_chars, sha256(t.kept) AS kept_sha256
FROM documents d LEFT JOIN texts t ON d.doc_id = t.doc_id
"""

OP5 = r"""
WITH turns AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
placed AS (
  SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, encode(role), encode(text)) - 1) AS place FROM turns),
pieces AS (SELECT *, (place // 256)::BIGINT AS piece FROM placed),
carried AS (
  SELECT p.conv_id, p.piece, 'system' AS role, arg_max(s.text, s.place) AS text, p.piece * 256 - 0.5 AS place
  FROM (SELECT DISTINCT conv_id, piece FROM pieces) p JOIN pieces s
    ON p.conv_id IS NOT DISTINCT FROM s.conv_id AND s.role = 'system' AND s.place < p.piece * 256
  GROUP BY p.conv_id, p.piece),
shown AS (
  SELECT conv_id, piece, role, text, place::DOUBLE AS place FROM pieces
  UNION ALL SELECT conv_id, piece, role, text, place FROM carried),
views AS (
  SELECT p.*, v.role AS participant FROM shown p
  JOIN (SELECT DISTINCT conv_id, role FROM pieces WHERE role <> 'system') v ON p.conv_id IS NOT DISTINCT FROM v.conv_id),
parts AS (
  SELECT *, CASE WHEN role = participant THEN '<|assistant|>' || chr(10) WHEN role = 'system' THEN '<|system|>' || chr(10)
                 ELSE '<|user name=' || replace(role, '<|', '< |') || '|>' || chr(10) END AS head,
         replace(text, '<|', '< |') || '<|end|>' AS body FROM views),
sized AS (
  SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, piece, participant ORDER BY place
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT + length(head) AS start FROM parts)
SELECT conv_id, piece, participant, count(*) FILTER (place = floor(place))::BIGINT AS n_turns, count(*) FILTER (role = participant)::BIGINT AS n_own,
       sum(length(head) + length(body) + 1)::BIGINT AS n_chars, sha256(string_agg(head || body || chr(10), '' ORDER BY place)) AS rendered_sha256,
       string_agg(start::VARCHAR || ':' || (start + length(body))::VARCHAR, ',' ORDER BY place) FILTER (role = participant) AS masks
FROM sized GROUP BY conv_id, piece, participant
"""

OP13 = r"""
WITH docs AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
words AS (SELECT lang, source, r, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS c FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
vocabulary AS (SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang),
found AS (SELECT w.lang, w.source, w.term, count(*) AS c FROM words w JOIN kept k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL),
groups AS (
  SELECT g.lang, g.source, coalesce(sum(f.c), 0) AS n FROM (SELECT DISTINCT lang, source FROM docs) g
  LEFT JOIN found f ON g.lang = f.lang AND g.source = f.source GROUP BY ALL),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(f.c, 0) AS c,
         (1 + (1000000000::HUGEINT * (coalesce(f.c, 0) + 1)) // (g.n + v.v))::HUGEINT AS p,
         (1 + (1000000000::HUGEINT * (k.c + 1)) // (v.n + v.v))::HUGEINT AS q
  FROM groups g JOIN kept k ON g.lang = k.lang JOIN vocabulary v ON g.lang = v.lang
  LEFT JOIN found f ON g.lang = f.lang AND g.source = f.source AND k.term = f.term),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
results AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM shares WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INTEGER AS rank FROM results)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""

ORACLE_SQL = {"op13_divergence": OP13, "op5_perspectives": OP5, "op4_line_dedup": OP4, "op1_source_mix": OP1, "op9_decontaminate": OP9}
