"""SQL for the registered queries of this package that SQL can express."""

_MIXING = """
WITH sized AS (
    SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '')) AS key,
           coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS class,
           CASE class WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
    FROM sized GROUP BY source
), levels AS (
    SELECT *, 3 * source_size AS ceiling,
           (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0))::DOUBLE
           / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
    FROM sources
    WINDOW before AS (ORDER BY 3 * source_size::DOUBLE / weight, source NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
    SELECT source, source_size, class,
           least(ceiling::DOUBLE,
                 coalesce(weight * max(level) FILTER (WHERE ceiling::DOUBLE / weight >= level) OVER (),
                          ceiling::DOUBLE)) AS target
    FROM levels
), placed AS (
    SELECT d.doc_id, d.size, t.class, t.source_size, t.target, round(t.target)::BIGINT AS quota,
           (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id NULLS FIRST, d.size
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size)::BIGINT AS start
    FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, taken, full_passes,
       CASE WHEN taken > 0 THEN least(1, CASE class
           WHEN 0 THEN CASE WHEN share < 0.625 THEN 1.5 - sqrt(2.25 - 2 * share)
                            ELSE 0.5 + (1 - sqrt(1 - 2 * (share - 0.625))) END
           WHEN 1 THEN share
           ELSE CASE WHEN share < 0.375 THEN sqrt(0.25::DOUBLE + 2 * share) - 0.5
                     ELSE 0.5 + (sqrt(1 + 2 * (share - 0.375)) - 1) END END) END::DOUBLE AS first_position
FROM (
    SELECT *, start::DOUBLE / greatest(quota, 1) AS share,
           full_passes * size + greatest(0, least(size, quota - full_passes * source_size - start))::BIGINT AS taken
    FROM (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE quota // source_size END::BIGINT AS full_passes FROM placed)
)
"""

# The checksum's table follows from its reversed polynomial.
_SHARDING = """
WITH steps AS (
    SELECT list_transform(range(256), lambda i: list_reduce(
        list_concat([i::BIGINT], range(8)),
        lambda c, step: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
), sized AS (
    SELECT doc_id, coalesce(strlen(text), 0) + 1 AS size,
           xor(4294967295, list_reduce(
               list_concat([4294967295::BIGINT],
                   list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                                  lambda b: ('0x' || b)::BIGINT)),
               lambda c, b: xor(c >> 8, crc[xor(c & 255, b) + 1]))) AS text_crc32
    FROM documents, steps
), placed AS (
    SELECT *, sum(size) OVER sorted - size AS first_byte, sum(size) OVER () AS all_bytes,
           row_number() OVER sorted - 1 AS row_no
    FROM sized
    WINDOW sorted AS (ORDER BY doc_id NULLS FIRST, size, text_crc32
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), cut AS (
    SELECT *, (first_byte * 16 // all_bytes)::INTEGER AS shard FROM placed
)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'bytes' AS law, shard,
       (row_no - min(row_no) OVER (PARTITION BY shard))::BIGINT AS slot,
       NULL::INTEGER AS grown_shard
FROM cut
"""

_TOPK = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS terms
    FROM embeddings
    WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), ranked AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.terms, c.terms)::BIGINT AS score,
           row_number() OVER (PARTITION BY q.vec_id
                              ORDER BY list_inner_product(q.terms, c.terms) DESC, c.vec_id)::INTEGER AS rank
    FROM whole q JOIN whole c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

_WARC = """
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
    FROM pages
), mains AS (
    SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS main FROM payloads
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> main THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> main THEN main END AS refers_to
FROM mains
"""

_HARD_NEGATIVES = """
WITH whole AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS terms
    FROM embeddings
    WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike,
           list_inner_product(a.terms, b.terms)::BIGINT AS score
    FROM whole a JOIN whole b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
    FROM scored WHERE alike
), ranked AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score,
           n.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank
    FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.alike
    WHERE p.place <= 5 AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
"""

_DECONTAMINATION = """
WITH tests AS (
    SELECT coalesce(item_id::VARCHAR, '') AS item,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
    FROM benchmark
), windows AS (
    SELECT DISTINCT item, least(len(words), 10) AS n,
           array_to_string(list_slice(words, pos, pos + least(len(words), 10) - 1), ' ') AS gram
    FROM (SELECT item, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS pos FROM tests WHERE len(words) > 0)
), texts AS (
    SELECT row_number() OVER () AS row_no, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
    FROM documents
), grams AS (
    SELECT row_no, n, pos, array_to_string(list_slice(words, pos, pos + n - 1), ' ') AS gram
    FROM (SELECT row_no, words, n, unnest(range(1, len(words) - n + 2)) AS pos
          FROM texts, (SELECT DISTINCT n FROM windows))
), found AS (
    SELECT row_no, pos, n, item FROM grams JOIN windows USING (n, gram)
), hits AS (
    SELECT row_no, count(DISTINCT word) AS n_hit
    FROM (SELECT row_no, unnest(range(pos, pos + n)) AS word FROM found) GROUP BY row_no
), whose AS (
    SELECT row_no, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT row_no, item FROM found) GROUP BY row_no
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN hits USING (row_no) LEFT JOIN whose USING (row_no)
"""

_DIVERGENCE = """
WITH texts AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
    FROM documents
), counts AS (
    SELECT lang, source, term, count(*) AS n, count(DISTINCT doc) AS docs
    FROM (SELECT doc, lang, source, unnest(terms) AS term FROM texts) GROUP BY ALL
), kept AS (
    SELECT lang, term, sum(n) AS lang_n FROM counts GROUP BY ALL HAVING sum(docs) >= 10
), langs AS (
    SELECT lang, count(*) AS v, sum(lang_n) AS total FROM kept GROUP BY lang
), sources AS (
    SELECT DISTINCT lang, source FROM texts
), totals AS (
    SELECT lang, source, sum(n) AS total FROM counts JOIN kept USING (lang, term) GROUP BY ALL
), shares AS (
    SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
           1 + 1000000000 * (coalesce(c.n, 0) + 2) // (coalesce(t.total, 0) + 2 * l.v) AS p,
           1 + 1000000000 * (k.lang_n + 2) // (l.total + 2 * l.v) AS q
    FROM sources s JOIN kept k USING (lang) JOIN langs l USING (lang)
         LEFT JOIN totals t ON t.lang = s.lang AND t.source = s.source
         LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
), summed AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(m.value, 0)::BIGINT AS value
    FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
         LEFT JOIN summed m ON m.lang = a.lang AND m.source = a.source AND m.item = b.source
), terms AS (
    SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
    FROM shares WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

ORACLE_SQL = {
    "op2_mixing": _MIXING,
    "op4_sharding": _SHARDING,
    "op6_warc": _WARC,
    "op8_topk": _TOPK,
    "op11_hard_negatives": _HARD_NEGATIVES,
    "op12_decontamination": _DECONTAMINATION,
    "op13_divergence": _DIVERGENCE,
}
