"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {
    "op1_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op11_vantage_points": """
        WITH valid AS (
            SELECT DISTINCT vec_id, embedding::DOUBLE[] AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), usual AS (
            SELECT len(v) AS size FROM valid GROUP BY len(v) ORDER BY count(*) DESC, len(v) LIMIT 1
        ), rows AS (
            SELECT vec_id, v FROM valid, usual WHERE len(v) = size
        ), near AS (
            SELECT q.vec_id AS query_id, q.v AS query, r.vec_id, list_distance(q.v, r.v) AS score,
                   row_number() OVER (PARTITION BY q.vec_id, q.v ORDER BY list_distance(q.v, r.v), r.vec_id) AS rank
            FROM rows q, rows r WHERE q.vec_id % 100 = 0 AND NOT (q.vec_id = r.vec_id AND q.v = r.v)
        )
        SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM near WHERE rank <= 10
    """,
    "op12_fill_in_middle": r"""
        WITH hashed AS (
            SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS digest,
                   regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units
            FROM documents
        ), numbered AS (
            SELECT doc_id, text, units, len(units)::BIGINT AS n,
                   ('0x' || substr(digest, 1, 8))::BIGINT % (len(units) + 1) AS one,
                   ('0x' || substr(digest, 9, 8))::BIGINT % (len(units) + 1) AS two,
                   text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                       OR ('0x' || substr(digest, 17, 8))::BIGINT % 100 >= 100 AS plain,
                   ('0x' || substr(digest, 25, 8))::BIGINT % 100 < 50 AS suffix_first
            FROM hashed
        ), parts AS (
            SELECT doc_id, text, n, CASE WHEN plain THEN 'plain' WHEN suffix_first THEN 'spm' ELSE 'psm' END AS form,
                   array_to_string(units[1:least(one, two)], '') AS prefix,
                   array_to_string(units[least(one, two) + 1:greatest(one, two)], '') AS middle,
                   array_to_string(units[greatest(one, two) + 1:], '') AS suffix
            FROM numbered
        ), made AS (
            SELECT *, CASE form WHEN 'plain' THEN text
                                WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                                ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END AS output
            FROM parts
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
               sha256(output) AS output_sha256,
               sha256(CASE form WHEN 'plain' THEN output
                   WHEN 'psm' THEN split_part(split_part(output, '<S>', 1), '<P>', 2) || split_part(output, '<M>', 2) || split_part(split_part(output, '<S>', 2), '<M>', 1)
                   ELSE split_part(split_part(output, '<P>', 2), '<M>', 1) || split_part(output, '<M>', 2) || split_part(split_part(output, '<P>', 1), '<S>', 2)
               END) AS restored_sha256
        FROM made
    """,
    "op13_importance_resampling": r"""
        WITH RECURSIVE steps AS (
            SELECT b AS byte, b::BIGINT AS crc, 0 AS step FROM range(256) t(b)
            UNION ALL
            SELECT byte, CASE WHEN crc % 2 = 1 THEN xor(crc // 2, 3988292384::BIGINT) ELSE crc // 2 END, step + 1 FROM steps WHERE step < 8
        ), crc_table AS (
            SELECT list(crc ORDER BY byte) AS entries FROM steps WHERE step = 8
        ), texts AS (
            SELECT 0 AS kind, row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents
            UNION ALL
            SELECT 1, row_number() OVER (), NULL, coalesce(text, '') FROM benchmark
        ), words AS (
            SELECT kind, row, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
            FROM texts
        ), hexed AS (
            SELECT DISTINCT word, hex(word) AS digits FROM words
        ), bucketed AS (
            SELECT word, xor(list_reduce(list_transform(range(1, len(digits), 2), lambda i: ('0x' || substr(digits, i, 2))::BIGINT),
                                         lambda crc, byte: xor(crc // 256, entries[xor(crc % 256, byte) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) % 10000 AS bucket
            FROM hexed, crc_table
        ), counts AS (
            SELECT bucket, count(*) FILTER (kind = 0) AS s, count(*) FILTER (kind = 1) AS t FROM words JOIN bucketed USING (word) GROUP BY bucket
        ), totals AS (
            SELECT coalesce(sum(s), 0)::DOUBLE AS all_s, coalesce(sum(t), 0)::DOUBLE AS all_t FROM counts
        ), gains AS (
            SELECT bucket, floor(1000 * ln((t + 1.0::DOUBLE) * (all_s + 10000) / ((s + 1.0::DOUBLE) * (all_t + 10000))))::BIGINT AS gain FROM counts, totals
        ), weights AS (
            SELECT row, count(*) AS n, sum(gain)::BIGINT AS weight FROM words JOIN bucketed USING (word) JOIN gains USING (bucket) WHERE kind = 0 GROUP BY row
        ), scored AS (
            SELECT doc_id, row, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
                   coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
            FROM texts LEFT JOIN weights USING (row) WHERE kind = 0
        ), ranked AS (
            SELECT row, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, row) AS place, count(*) OVER () AS able FROM scored WHERE n_features >= 20
        )
        SELECT doc_id, n_features, weight, score, CASE WHEN place <= able * 10 // 100 THEN place END AS rank
        FROM scored LEFT JOIN ranked USING (row)
    """,
}
