"""SQL twins of the queries that SQL can express over whole tables."""

#: the 256 remainders of CRC-32, and the checksum of a text by them
CRC_TABLE = """
crc_table AS (
  SELECT list(c ORDER BY b) AS crcs FROM (
    SELECT b, list_reduce(list_prepend(b::BIGINT, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(b)))"""


def crc(text: str) -> str:
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)), lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295)"""


def words(text: str) -> str:
    """A-Z in lower case; runs of digits, letters and characters beyond ASCII."""
    return rf"""regexp_extract_all(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


DECONTAMINATE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM win),
places AS (
  SELECT r, size, i, array_to_string(w[i:i + size - 1], ' ') AS g
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
found AS (SELECT r, size, i, item_id FROM places JOIN win USING (size, g)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS p FROM (SELECT DISTINCT r, i, size FROM found)) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM found) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""

CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(role) + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + length('<|im_start|>' || '<|im_end|>') + 2) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

WARC = r"""
WITH r AS (
  SELECT page_id,
         CAST(floor(page_id / 256.0) AS BIGINT) AS archive,
         'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10)
         || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
         || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record
  FROM pages),
o AS (
  SELECT *, CAST(strlen(record) AS BIGINT) AS length, sha256(record) AS sha256,
         CAST(coalesce(sum(strlen(record)) OVER (PARTITION BY archive ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
  FROM r),
p AS (
  SELECT *, CASE WHEN page_id % 193 = 7 THEN NULL
                 WHEN page_id % 97 = 13 THEN sha256(substring(record, 1, length(record) - 5) || '#' || chr(13) || chr(10) || chr(13) || chr(10))
                 ELSE sha256 END AS replica_sha256
  FROM o)
SELECT archive, "offset", page_id AS record_id, length, CASE WHEN replica_sha256 IS NULL THEN 'missing' ELSE 'corrupt' END AS status, sha256, replica_sha256
FROM p WHERE replica_sha256 IS DISTINCT FROM sha256
"""

EMBEDDINGS = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) > 0 AND list_count(embedding) = len(embedding) AND isfinite(list_sum(CAST(embedding AS DOUBLE[]))) AND list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM least LEFT JOIN n USING (vec_id)
"""

RESAMPLE = f"""
WITH {CRC_TABLE},
d AS (SELECT row_number() OVER () AS r, doc_id, {words("text")} AS w FROM documents),
b AS (SELECT {words("text")} AS w FROM benchmark),
fd AS (SELECT r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS g FROM d),
fb AS (SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS g FROM b),
bucket AS (SELECT g, {crc("g")} % 10000 AS k FROM (SELECT g FROM fd UNION SELECT g FROM fb), crc_table),
s AS (SELECT k, count(*) AS s FROM fd JOIN bucket USING (g) GROUP BY k),
t AS (SELECT k, count(*) AS t FROM fb JOIN bucket USING (g) GROUP BY k),
gain AS (
  SELECT k, floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * ((SELECT count(*) FROM fd)::DOUBLE + 10000) / ((coalesce(s, 0)::DOUBLE + 1) * ((SELECT count(*) FROM fb)::DOUBLE + 10000))))::BIGINT AS gain
  FROM range(10000) x(k) LEFT JOIN s USING (k) LEFT JOIN t USING (k)),
weighed AS (SELECT r, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM fd JOIN bucket USING (g) JOIN gain USING (k) GROUP BY r),
scored AS (
  SELECT doc_id, len(w) >= 20 AS long_enough, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN weighed USING (r)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY long_enough ORDER BY score DESC, doc_id) AS place FROM scored)
SELECT doc_id, n_features, weight, score,
       CASE WHEN long_enough AND place <= 25 * (SELECT count(*) FROM scored WHERE long_enough) // 100 THEN place END AS rank
FROM ranked
"""

SEARCH = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words("text")} AS w FROM documents),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY r, term),
total AS (SELECT count(*) AS n, coalesce(sum(len(w)), 0)::BIGINT AS l FROM d WHERE len(w) > 0),
q AS (SELECT item_id, term, count(*) AS qtf FROM (SELECT item_id, unnest(w) AS term FROM (SELECT DISTINCT item_id, {words("text")} AS w, text FROM benchmark)) GROUP BY item_id, term),
w AS (SELECT term, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS weight FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total),
impact AS (
  SELECT r, term, weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(d.w) * n) // l))) AS impact
  FROM tf JOIN (SELECT DISTINCT term FROM q) USING (term) JOIN w USING (term) JOIN d USING (r), total),
scored AS (SELECT item_id, r, sum(qtf * impact)::BIGINT AS score FROM q JOIN impact USING (term) GROUP BY item_id, r),
ranked AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored JOIN d USING (r) WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""

SHARDS = f"""
WITH {CRC_TABLE},
d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
numbers AS (
  SELECT doc_id, (strlen(text) + 8)::BIGINT AS size, {crc("text")} AS text_crc32,
         list_transform(range(0, 25), lambda i: ln((('0x' || substr(sha256(doc_id || ':' || (i // 4)), 16 * (i % 4) + 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496)) AS bids
  FROM d, crc_table),
dealt AS (SELECT *, (list_position(bids[1:24], list_max(bids[1:24])) - 1)::INTEGER AS shard, (list_position(bids, list_max(bids)) - 1)::INTEGER AS grown_shard FROM numbers)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id, size, text_crc32) - 1 AS slot, grown_shard FROM dealt
"""
