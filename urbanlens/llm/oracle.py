"""DuckDB SQL over the raw tables for the queries that SQL can express."""

from urbanlens.llm.common import LOWER, UPPER

_SPACES = " || ".join(f"chr({n})" for n in (32, 9, 10, 11, 12, 13))

OP3 = f"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM docs),
keyed AS (
  SELECT doc_id, pos, line, translate(rtrim(ltrim(line, {_SPACES}), {_SPACES}), '{UPPER}', '{LOWER}') AS k FROM lines),
repeated AS (
  SELECT k, min(doc_id) AS keeper FROM keyed WHERE length(k) >= 10
  GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT y.doc_id, y.pos, y.line, (r.k IS NOT NULL AND y.doc_id <> r.keeper) AS lost
  FROM keyed y LEFT JOIN repeated r ON y.k = r.k)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN lost THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP6 = f"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{_WORDS}') AS w
  FROM benchmark WHERE text IS NOT NULL),
sized AS (SELECT item_id, w, least(len(w), 13) AS n FROM item_words WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[s : s + n - 1], ' ') AS gram
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM sized)),
lengths AS (SELECT DISTINCT n FROM windows),
doc_words AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{_WORDS}'), []) AS w
  FROM documents),
doc_grams AS (
  SELECT doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
        FROM doc_words, lengths WHERE len(w) >= n)),
found AS (
  SELECT g.doc_id, g.n, g.s, i.item_id FROM doc_grams g JOIN windows i ON g.n = i.n AND g.gram = i.gram),
hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit,
  coalesce(i.n_items, 0) AS n_items, sha256(coalesce(i.names, '')) AS items_sha256,
  coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM doc_words d LEFT JOIN hits h ON d.doc_id = h.doc_id LEFT JOIN items i ON d.doc_id = i.doc_id
"""

ORACLE_SQL: dict[str, str] = {"op3_line_dedup": OP3, "op6_decontamination": OP6}

OP5 = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+'), []) AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[s : s + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, least(len(w), 4) AS n, unnest(range(1, len(w) - least(len(w), 4) + 2)) AS s
        FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * c >= 85 * (x.n + y.n - c)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT ways.b, reach.r FROM reach JOIN ways ON reach.doc_id = ways.a)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, m.component_id
FROM documents d LEFT JOIN sizes s ON d.doc_id = s.doc_id
JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) m ON d.doc_id = m.doc_id
"""

ORACLE_SQL["op5_jaccard"] = OP5

OP7 = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, n, r, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(n, r))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum(length('<|im_start|>') + length('<|im_end|>') + 2
    + length(replace(replace(replace(role, '&', '&amp;'), '<|', '&lt;|'), chr(10), '&#10;'))
    + length(replace(replace(text, '&', '&amp;'), '<|', '&lt;|'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

OP8 = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, coalesce(html, '') AS html FROM pages),
last AS (SELECT html, max(page_id) AS keeper FROM p WHERE n >= 1000 GROUP BY html)
SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes, sha1(p.html) AS payload_digest,
  CASE WHEN l.keeper <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN l.keeper <> p.page_id THEN l.keeper END AS refers_to
FROM p LEFT JOIN last l ON p.n >= 1000 AND p.html = l.html
"""

OP10 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
usable AS (
  SELECT vec_id, label, e FROM v
  WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM usable a JOIN usable b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach(vec_id, r) AS (
  SELECT vec_id, vec_id FROM v
  UNION
  SELECT links.b, reach.r FROM reach JOIN links ON reach.vec_id = links.a)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, m.component_id, v.vec_id = m.component_id AS kept
FROM v LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) n ON v.vec_id = n.a
JOIN (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id) m ON v.vec_id = m.vec_id
"""

ORACLE_SQL |= {"op7_chat": OP7, "op8_warc": OP8, "op10_embeddings": OP10}


def _draw(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 12))::BIGINT"


OP1 = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, coalesce('=' || source, '-') AS key,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS n_tokens FROM documents),
counts AS (
  SELECT key, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM docs GROUP BY key HAVING sum(n_tokens) > 0),
total AS (SELECT CAST(sum(tokens) AS BIGINT) AS t, list(tokens / (SELECT sum(tokens) FROM counts)::DOUBLE) AS shares FROM counts),
bisect(step, low, high) AS (
  SELECT 0, 0.0::DOUBLE, 2.0::DOUBLE
  UNION ALL
  SELECT step + 1, CASE WHEN flat THEN mid ELSE low END, CASE WHEN flat THEN high ELSE mid END
  FROM (
    SELECT step, low, high, mid,
      ln(list_sum(m)) - list_sum(list_transform(m, lambda x: x * ln(x))) / list_sum(m) >= 0.97 * ln(len(m)) AS flat
    FROM (SELECT step, low, high, (low + high) / 2 AS mid,
            list_transform(shares, lambda s: pow(s, (low + high) / 2)) AS m
          FROM bisect, total WHERE step < 54))),
chosen AS (SELECT least(low, 1.0) AS t FROM bisect WHERE step = 54),
mass AS (SELECT key, tokens, pow(tokens / total.t::DOUBLE, chosen.t) AS m, total.t AS total FROM counts, total, chosen),
quotas AS (
  SELECT key, tokens, CAST(floor(round(m / (SELECT sum(m) FROM mass), 9) * total) AS BIGINT) AS quota,
    least(CAST(ceil(tokens / 50000.0) AS BIGINT), 10000) AS blocks FROM mass),
sources AS (SELECT key, blocks, quota // tokens AS whole, quota % tokens AS rest FROM quotas),
dealt AS (
  SELECT d.*, {_draw("concat_ws('|', 'block', d.key, coalesce(d.doc_id::VARCHAR, '-'))")} % s.blocks AS block,
    s.whole, s.rest FROM docs d JOIN sources s ON d.key = s.key),
sizes AS (SELECT key, block, whole, rest, sum(n_tokens) AS size FROM dealt GROUP BY ALL),
epochs AS (SELECT *, unnest(range(0, whole + 1)) AS epoch FROM sizes),
placed AS (SELECT *, {_draw("concat_ws('|', 'order', epoch::VARCHAR, key, block::VARCHAR)")} AS place FROM epochs),
plan AS (
  SELECT key, block, epoch, row_number() OVER o AS block_rank,
    CASE WHEN epoch = whole THEN rest - (sum(size) OVER o - size) END AS left_
  FROM placed WINDOW o AS (PARTITION BY key, epoch ORDER BY place, block ROWS UNBOUNDED PRECEDING)),
drawn AS (
  SELECT d.doc_id, d.source, d.key, d.block, d.n_tokens, p.epoch, p.block_rank, p.left_,
    {_draw("concat_ws('|', 'doc', p.epoch::VARCHAR, d.key, coalesce(d.doc_id::VARCHAR, '-'))")} AS draw
  FROM dealt d JOIN plan p ON d.key = p.key AND d.block = p.block WHERE p.left_ IS NULL OR p.left_ > 0),
taken AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY key, block, epoch ORDER BY draw, doc_id, n_tokens
    ROWS UNBOUNDED PRECEDING) - n_tokens AS taken FROM drawn)
SELECT doc_id, source, CAST(n_tokens AS BIGINT) AS n_tokens, epoch, block_rank, draw
FROM taken WHERE left_ IS NULL OR taken < left_
"""

ORACLE_SQL["op1_mixing"] = OP1

OP11 = f"""
WITH docs AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
kept AS (
  SELECT lang, term FROM (SELECT lang, unnest(list_distinct(w)) AS term FROM docs)
  GROUP BY lang, term HAVING count(*) >= 10),
occurring AS (
  SELECT t.lang, t.source, t.term, count(*) AS n
  FROM (SELECT lang, source, unnest(w) AS term FROM docs) t JOIN kept k ON t.lang = k.lang AND t.term = k.term
  GROUP BY t.lang, t.source, t.term),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (
  SELECT g.lang, g.source, coalesce(s.v, 0) AS v, coalesce(o.n, 0) AS n_all
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN sizes s ON g.lang = s.lang
  LEFT JOIN (SELECT lang, source, sum(n) AS n FROM occurring GROUP BY lang, source) o
    ON g.lang = o.lang AND g.source = o.source),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS n,
    CAST(1 + (1000000000 * (CAST(coalesce(o.n, 0) AS HUGEINT) + 2)) // (g.n_all + 2 * g.v) AS HUGEINT) AS p
  FROM groups g JOIN kept k ON g.lang = k.lang
  LEFT JOIN occurring o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term),
in_lang AS (
  SELECT lang, term, CAST(1 + (1000000000 * (CAST(sum(n) AS HUGEINT) + 2))
    // (sum(sum(n)) OVER (PARTITION BY lang) + 2 * count(*) OVER (PARTITION BY lang)) AS HUGEINT) AS q
  FROM occurring GROUP BY lang, term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source),
terms AS (
  SELECT s.lang, s.source, s.term AS item, ((s.p - i.q) * (s.p - i.q)) // (s.p + i.q) AS value
  FROM shares s JOIN in_lang i ON s.lang = i.lang AND s.term = i.term WHERE s.n > 0 AND s.p > i.q),
found AS (
  SELECT 'pair' AS part, g.lang, g.source, h.source AS item, coalesce(p.value, 0) AS value
  FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN pairs p ON p.lang = g.lang AND p.source = g.source AND p.item = h.source
  UNION ALL SELECT 'term', lang, source, item, value FROM terms),
ranked AS (
  SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
    CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM found)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

OP12 = f"""
WITH RECURSIVE crc_table(i, c, step) AS (
  SELECT CAST(range AS BIGINT), CAST(range AS BIGINT), 0 FROM range(256)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1 FROM crc_table WHERE step < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM crc_table WHERE step = 8),
docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{_WORDS}') AS w FROM documents),
items AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{_WORDS}') AS w FROM benchmark),
words AS (SELECT unnest(w) AS word FROM docs UNION SELECT unnest(w) FROM items),
hashed AS (
  SELECT word, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(
      string_split(regexp_replace(hex(encode(word)), '(..)', '\\1 ', 'g').rtrim(), ' '),
      lambda x: CAST(('0x' || x) AS BIGINT))),
    lambda a, b: xor(a >> 8, crc.t[CAST(xor(a & 255, b) AS INTEGER) + 1])), 4294967295) % 10000 AS bucket
  FROM words, crc),
doc_words AS (SELECT d.doc_id, h.bucket FROM (SELECT doc_id, unnest(w) AS word FROM docs) d JOIN hashed h ON d.word = h.word),
item_words AS (SELECT h.bucket FROM (SELECT unnest(w) AS word FROM items) d JOIN hashed h ON d.word = h.word),
gains AS (
  SELECT b.bucket, CAST(floor(1000 * ln(((CAST(coalesce(t.n, 0) AS DOUBLE) + 1) * (CAST(a.s AS DOUBLE) + 10000))
    / ((CAST(coalesce(s.n, 0) AS DOUBLE) + 1) * (CAST(a.t AS DOUBLE) + 10000)))) AS BIGINT) AS gain
  FROM (SELECT range AS bucket FROM range(10000)) b
  LEFT JOIN (SELECT bucket, count(*) AS n FROM doc_words GROUP BY bucket) s ON s.bucket = b.bucket
  LEFT JOIN (SELECT bucket, count(*) AS n FROM item_words GROUP BY bucket) t ON t.bucket = b.bucket,
  (SELECT (SELECT count(*) FROM doc_words) AS s, (SELECT count(*) FROM item_words) AS t) a),
weights AS (
  SELECT w.doc_id, CAST(sum(g.gain) AS BIGINT) AS weight FROM doc_words w JOIN gains g ON w.bucket = g.bucket GROUP BY w.doc_id),
scored AS (
  SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_features, coalesce(w.weight, 0) AS weight,
    coalesce(w.weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(('0x' || substr(sha256('2024:' || CAST(d.doc_id AS VARCHAR)), 1, 8)) AS BIGINT)
      + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM docs d LEFT JOIN weights w ON d.doc_id = w.doc_id),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, 10 * count(*) OVER () // 100 AS draws
  FROM scored WHERE n_features >= 20)
SELECT s.doc_id, s.n_features, s.weight, s.score, CASE WHEN r.r <= r.draws THEN r.r END AS rank
FROM scored s LEFT JOIN ranked r ON s.doc_id = r.doc_id
"""

OP13 = """
WITH docs AS (SELECT doc_id, encode(coalesce(text, '')) AS b, hex(encode(coalesce(text, ''))) AS x FROM documents),
windows AS (
  SELECT doc_id, p, md5_number(b[CAST(p + 1 AS BIGINT) : CAST(p + 200 AS BIGINT)]) AS m
  FROM (SELECT doc_id, b, unnest(range(0, octet_length(b) - 199)) AS p FROM docs)),
found AS (
  SELECT w.doc_id, w.p FROM windows w JOIN (SELECT m FROM windows GROUP BY m HAVING count(*) > 1) r ON w.m = r.m),
edges AS (
  SELECT doc_id, p, coalesce(p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) > 200, true) AS opens FROM found),
numbered AS (
  SELECT doc_id, p, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS s FROM edges),
spans AS (SELECT doc_id, s, min(p) AS lo, max(p) + 200 AS hi FROM numbered GROUP BY doc_id, s),
bounds AS (
  SELECT doc_id, count(*) AS n, sum(hi - lo) AS removed,
    list_concat([0], list(hi ORDER BY lo)) AS begins, list(lo ORDER BY lo) AS ends FROM spans GROUP BY doc_id)
SELECT d.doc_id, CAST(length(d.x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(b.removed, 0) AS BIGINT) AS n_removed,
  coalesce(b.n, 0) AS n_spans,
  sha256(unhex(CASE WHEN b.doc_id IS NULL THEN d.x ELSE array_to_string(list_transform(
    list_zip(b.begins, list_append(b.ends, length(d.x) // 2)),
    lambda z: substr(d.x, CAST(2 * z[1] + 1 AS BIGINT), CAST(2 * (z[2] - z[1]) AS BIGINT))), '') END)) AS kept_sha256
FROM docs d LEFT JOIN bounds b ON d.doc_id = b.doc_id
"""

ORACLE_SQL |= {"op11_divergence": OP11, "op12_resampling": OP12, "op13_suffix_dedup": OP13}
