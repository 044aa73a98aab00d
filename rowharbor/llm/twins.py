"""SQL twins of the registered queries that SQL can express."""

from __future__ import annotations

ORACLES = {
    # The level of the targets is found at the source where the budget, dealt by weight above the
    # limits of all sources that fill up earlier, first runs out.
    "op5_mixing": r"""
WITH sized AS (
    SELECT doc_id, source, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place,
           CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
    FROM documents
), totals AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           row_number() OVER (ORDER BY source NULLS LAST) - 1 AS turn
    FROM sized GROUP BY source
), weighed AS (
    SELECT source, source_size, turn, 3.0::DOUBLE * source_size AS cap,
           CASE turn % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::DOUBLE AS weight
    FROM totals
), filled AS (
    SELECT *, sum(source_size) OVER ()
              - coalesce(sum(cap) OVER (ORDER BY cap / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS budget,
           sum(weight) OVER (ORDER BY cap / weight, turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
    FROM weighed
), level AS (
    SELECT CAST(arg_min(budget / open_weight, cap / weight) FILTER (weight * (budget / open_weight) <= cap) AS DOUBLE) AS level FROM filled
), targets AS (
    SELECT source, source_size, least(cap, coalesce(weight * level, cap)) AS target FROM weighed, level
), placed AS (
    SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place, doc_id, size
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM sized
)
SELECT doc_id, size, source_size, target, p.source,
       CAST(CASE WHEN source_size > 0 THEN
           floor(target / source_size) * size
           + greatest(0, least(size, floor(target) - floor(target / source_size) * source_size - before))
       ELSE 0 END AS BIGINT) AS taken
FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source
""",
    # CRC-32 by the table of its polynomial, byte by byte; the tree's nodes come from the shard
    # numbers: two regions, two racks in each, shards dealt over them in turn. As a node's draw is the
    # least of its shards', the shard of the least draw wins.
    "op7_sharding": r"""
WITH RECURSIVE cells(i, v, step) AS (
    SELECT range, range, 0 FROM range(256)
    UNION ALL SELECT i, xor(v >> 1, 3988292384 * (v & 1)), step + 1 FROM cells WHERE step < 8
), crc AS (
    SELECT list(v ORDER BY i) AS entries FROM cells WHERE step = 8
), docs AS (
    SELECT row_number() OVER () AS row, doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS key,
           encode(coalesce(text, '')) AS body
    FROM documents
), tree AS (
    SELECT range AS shard, 'region' || (range % 2) AS region,
           'region' || (range % 2) || '/rack' || (range // 2 % 2) AS rack
    FROM range(17)
), draws AS (
    SELECT row, shard, -ln((('0x' || substr(md5(key || '/' || rack || '/shard' || shard), 1, 13))::BIGINT
                            + 0.5::DOUBLE) / 4503599627370496) AS draw
    FROM docs, tree
), landed AS (
    SELECT row, arg_min(shard, draw) FILTER (shard < 16) AS shard, arg_min(shard, draw) AS grown_shard
    FROM draws GROUP BY row
), summed AS (
    SELECT row, doc_id, key, octet_length(body) + 1 AS size,
           xor(list_reduce(list_transform(regexp_extract_all(hex(body), '..'), lambda x: ('0x' || x)::BIGINT),
                           lambda c, x: xor(c >> 8, entries[(xor(c, x) & 255) + 1]), 4294967295::BIGINT),
               4294967295::BIGINT) AS text_crc32
    FROM docs, crc
)
SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY md5(key || '/' || text_crc32), doc_id, size, text_crc32) - 1 AS slot,
       CAST(grown_shard AS INTEGER) AS grown_shard
FROM summed JOIN landed USING (row)
""",
    "op9_repeated_lines": r"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id, string_split(regexp_replace(text, '([.!?]) ', '\1' || chr(10), 'g'), chr(10)) AS parts
    FROM documents
), cut AS (
    SELECT row, doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS place FROM docs
), placed AS (
    SELECT row, doc_id, place, length(part) AS size,
           coalesce(sum(length(part) + 1) OVER (PARTITION BY row ORDER BY place
                                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start,
           regexp_extract_all(lower(part), '\S+') AS words
    FROM cut
), units AS (
    SELECT *, row_number() OVER (PARTITION BY row ORDER BY place) AS unit FROM placed WHERE len(words) > 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY words ORDER BY doc_id, unit) AS turn,
           first_value(doc_id) OVER (PARTITION BY words ORDER BY doc_id, unit) AS first_doc_id
    FROM units
), gone AS (
    SELECT *, unit - row_number() OVER (PARTITION BY row ORDER BY unit) AS island FROM ranked WHERE turn > 1
), runs AS (
    SELECT *, sum(len(words)) OVER (PARTITION BY row, island) AS run,
           row_number() OVER (PARTITION BY row, island ORDER BY unit) AS nth FROM gone
), summed AS (
    SELECT row, count(*) AS n_units, CAST(sum(len(words)) AS BIGINT) AS n_words, CAST(max(run) AS BIGINT) AS longest_run,
           count(*) FILTER (nth = 1 AND run >= 20) AS n_passages,
           string_agg(start || ':' || (start + size), ',' ORDER BY start) AS spans,
           string_agg(first_doc_id::VARCHAR, ',' ORDER BY start) AS first_doc_ids
    FROM runs GROUP BY row
)
SELECT doc_id, coalesce(n_units, 0) AS n_units, coalesce(n_words, 0) AS n_words, coalesce(longest_run, 0) AS longest_run,
       coalesce(n_passages, 0) AS n_passages, coalesce(spans, '') AS spans, coalesce(first_doc_ids, '') AS first_doc_ids
FROM docs LEFT JOIN summed USING (row)
""",
}
