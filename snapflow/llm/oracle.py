"""DuckDB SQL for the queries of this subpackage that SQL can express."""

# Base32 of a SHA-1: 32 groups of 5 of its 160 bits.
ARC_TO_WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html,
         CAST(unhex(sha1(coalesce(html, ''))) AS BIT)::VARCHAR AS bits
  FROM pages
), q AS (
  SELECT page_id, octet_length(encode(html)) AS payload_bytes,
         list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + 16 * substr(bits, CAST(i * 5 + 1 AS INT), 1)::INT + 8 * substr(bits, CAST(i * 5 + 2 AS INT), 1)::INT
             + 4 * substr(bits, CAST(i * 5 + 3 AS INT), 1)::INT + 2 * substr(bits, CAST(i * 5 + 4 AS INT), 1)::INT
             + substr(bits, CAST(i * 5 + 5 AS INT), 1)::INT, 1)), 'string_agg', '') AS payload_digest
  FROM p
), r AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS kept FROM q
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> kept THEN kept END AS refers_to
FROM r
"""

# The share per unit of weight is found in closed form: sources ordered by
# cap / weight fill up one after the other.
SYSTEMATIC_MIX = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight,
         2.0::DOUBLE * source_size AS cap
  FROM s
), o AS (
  SELECT *, cap / weight AS level,
         coalesce(sum(cap) OVER (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled,
         coalesce(sum(weight) OVER (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent,
         sum(weight) OVER () AS weights, sum(source_size) OVER () AS words
  FROM w
), share AS (
  SELECT arg_min((1.5 * words - filled) / (weights - spent), level) AS share
  FROM o WHERE (1.5 * words - filled) / (weights - spent) <= level
), t AS (
  SELECT source, source_size, least(cap, coalesce(share, 1e300) * weight) AS target FROM w, share
), r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('17:' || coalesce(d.source, chr(0) || 'null')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS offs,
         row_number() OVER (PARTITION BY d.source ORDER BY d.size,
           md5(CASE WHEN d.doc_id IS NULL THEN '17' ELSE '17:' || d.doc_id END), d.doc_id NULLS FIRST) AS rank
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(floor(rank * rate + offs) - floor((rank - 1) * rate + offs) AS BIGINT) * size AS taken
FROM r
"""

# 24: the template's own characters in a turn; escaping adds one per control string.
PREFIX_TARGET_CHAT = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), n AS (
  SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id) AS turns,
         sum(24 + length(role) + length(text) + len(regexp_extract_all(text, '<\\*\|'))) OVER w AS formatted
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(formatted) FILTER (role = 'assistant' OR k = turns) AS BIGINT) AS formatted_chars
FROM n GROUP BY conv_id
"""

AUTOMATON_SUBSTRING_DEDUP = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), p AS (
  SELECT rid, unnest(range(1, len(ws) + 1)) AS pos, unnest(ws) AS word FROM d
), s AS (
  SELECT rid, unnest(range(1, len(ws) - 33)) AS pos, ws FROM d WHERE len(ws) >= 35
), w AS (
  SELECT rid, pos, array_to_string(ws[pos : pos + 34], ' ') AS said FROM s
), r AS (
  SELECT rid, pos, count(*) OVER (PARTITION BY said) > 1 AS again FROM w
), c AS (
  SELECT p.rid, p.pos, p.word,
         coalesce(bool_or(r.again) OVER (PARTITION BY p.rid ORDER BY p.pos ROWS BETWEEN 34 PRECEDING AND CURRENT ROW), false) AS gone
  FROM p LEFT JOIN r ON p.rid = r.rid AND p.pos = r.pos
), k AS (
  SELECT rid, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept FROM c GROUP BY rid
)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.rid = k.rid
"""

NORM_BUCKET_SEARCH = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents
), q AS (
  SELECT row_number() OVER () AS qid, item_id,
         list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS ts
  FROM (SELECT DISTINCT item_id, coalesce(text, '') AS text FROM benchmark) x
), s AS (
  SELECT count(*) FILTER (len(ts) > 0) AS docs, CAST(sum(len(ts)) AS BIGINT) AS terms FROM d
), t AS (
  SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(ts) AS term FROM d) u GROUP BY rid, term
), f AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM t GROUP BY term) c, s
), m AS (
  SELECT rid, doc_id, CAST(100 - 90 + (90 * len(ts) * docs) // terms AS BIGINT) AS m FROM d, s WHERE len(ts) > 0
), p AS (
  SELECT qid, item_id, rid, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM (SELECT qid, item_id, unnest(ts) AS term FROM q) a JOIN f USING (term) JOIN t USING (term) JOIN m USING (rid)
  GROUP BY qid, item_id, rid
), r AS (
  SELECT item_id, doc_id, score,
         CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id ASC NULLS LAST) AS INT) AS rank
  FROM p JOIN m USING (rid) WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""

MISRA_GRIES_COLLOCATIONS = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         regexp_extract_all(unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS ws
  FROM documents
), z AS (
  SELECT lang, sum(len(ws)) AS n FROM p GROUP BY lang
), g AS (
  SELECT lang, unnest(ws) AS phrase, 1 AS size FROM p
  UNION ALL SELECT lang, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])), 2 FROM p
  UNION ALL SELECT lang, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])), 3 FROM p
), f AS (
  SELECT lang, phrase, size, count(*) AS a, string_split(phrase, ' ') AS w FROM g GROUP BY lang, phrase, size HAVING count(*) >= 10
), k AS (
  SELECT lang, phrase, size, a, array_to_string(w[1:k], ' ') AS one, array_to_string(w[k + 1:size], ' ') AS two, k
  FROM (SELECT *, unnest(range(1, size)) AS k FROM f WHERE size > 1) c
), s AS (
  SELECT k.lang, k.phrase, k.size, k.a, x.a AS l, y.a AS r, k.k,
         CAST((1000000::HUGEINT * k.a * k.a) // (x.a::HUGEINT * y.a) AS BIGINT) AS score
  FROM k JOIN f x ON x.lang = k.lang AND x.phrase = k.one JOIN f y ON y.lang = k.lang AND y.phrase = k.two
), b AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), o AS (
  SELECT lang, sub, max(a) AS around FROM (
    SELECT lang, a, array_to_string(w[1:2], ' ') AS sub FROM f WHERE size = 3
    UNION ALL SELECT lang, a, array_to_string(w[2:3], ' ') FROM f WHERE size = 3
  ) t GROUP BY lang, sub
), r AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM b LEFT JOIN o ON o.lang = b.lang AND o.sub = b.phrase
  WHERE o.around IS NULL OR 100 * o.around < 50 * b.a
)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM r JOIN z USING (lang) WHERE rank <= 2000
"""

LLM_SQL = {
    "op3_arc_to_warc": ARC_TO_WARC,
    "op6_systematic_mix": SYSTEMATIC_MIX,
    "op9_prefix_target_chat": PREFIX_TARGET_CHAT,
    "op10_automaton_substring_dedup": AUTOMATON_SUBSTRING_DEDUP,
    "op12_norm_bucket_search": NORM_BUCKET_SEARCH,
    "op13_misra_gries_collocations": MISRA_GRIES_COLLOCATIONS,
}
