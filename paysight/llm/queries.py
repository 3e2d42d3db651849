"""Registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from paysight.llm.bpe import op5_byte_bpe
from paysight.llm.fill_middle import op13_fill_middle
from paysight.llm.group_join import op11_ngram_join
from paysight.llm.html_extract import op2_html_extract
from paysight.llm.language import op9_language
from paysight.llm.lemp import op12_ranked_search
from paysight.llm.maxscore import op3_top_k
from paysight.llm.merkle import op4_merkle
from paysight.llm.mixing import op10_mixing
from paysight.llm.quality import op8_quality
from paysight.llm.sharding import op7_sharding
from paysight.llm.simhash import op6_simhash
from paysight.llm.token_counts import op1_token_counts

LLM_QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_html_extract, op3_top_k, op4_merkle, op5_byte_bpe,
    op6_simhash, op7_sharding, op8_quality, op9_language, op10_mixing,
    op11_ngram_join, op12_ranked_search, op13_fill_middle)}

LLM_ORACLE = {
    "op3_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT a.vec_id AS query_id, b.vec_id,
                   CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id),
        r AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS "rank",
                   vec_id, score
            FROM s)
        SELECT query_id, "rank", vec_id, score FROM r WHERE "rank" <= 20""",
    "op10_mixing": r"""
        WITH d AS (
            SELECT doc_id, source,
                   CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
            FROM documents),
        s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
        w AS (
            SELECT source, source_size, source_size * 2.0::DOUBLE AS cap,
                   CAST([3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight
            FROM s),
        l AS (
            SELECT *, cap / weight AS full_at,
                   sum(source_size) OVER () * 1.5::DOUBLE AS total, sum(weight) OVER () AS weights,
                   coalesce(sum(cap) OVER before, 0.0::DOUBLE) AS used, coalesce(sum(weight) OVER before, 0.0::DOUBLE) AS gone
            FROM w WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        h AS (SELECT *, (total - used) / (weights - gone) AS level_here FROM l),
        t AS (
            SELECT source, source_size,
                   least(cap, coalesce(max(CASE WHEN level_here <= full_at THEN level_here END) OVER (), max(full_at) OVER ())
                              * weight) AS target
            FROM h),
        r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate FROM t)
        SELECT d.doc_id, d.size, r.source_size, r.target,
               CAST(d.size * (floor(r.rate) + CASE WHEN
                   CAST(('0x' || substr(md5('42:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 13)) AS BIGINT)
                   / 4503599627370496.0::DOUBLE < r.rate - floor(r.rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
        FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source""",
    "op12_ranked_search": r"""
        WITH d AS (
            SELECT doc_id, unnest(regexp_extract_all(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM documents),
        q AS (
            SELECT item_id, unnest(regexp_extract_all(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark),
        s AS (SELECT count(DISTINCT doc_id) AS big_n, count(*) AS big_l FROM d),
        m AS (SELECT doc_id, 75 + (25 * count(*) * big_n) // big_l AS m FROM d, s GROUP BY doc_id, big_n, big_l),
        tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY doc_id, term),
        w AS (SELECT term, CAST(floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, s GROUP BY term, big_n),
        qc AS (SELECT item_id, term, count(*) AS c FROM q GROUP BY item_id, term),
        r AS (
            SELECT item_id, doc_id, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
            FROM qc JOIN tf USING (term) JOIN w USING (term) JOIN m USING (doc_id)
            GROUP BY item_id, doc_id),
        k AS (
            SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS "rank", doc_id, score
            FROM r WHERE score > 0)
        SELECT item_id, "rank", doc_id, score FROM k WHERE "rank" <= 20""",
    "op13_fill_middle": """
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS t, CAST(length(coalesce(text, '')) AS BIGINT) AS n,
                   sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
            FROM documents),
        x AS (
            SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS a, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS b,
                   CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                             OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
                        WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
            FROM d),
        c AS (
            SELECT *, CASE WHEN form <> 'plain' THEN least(a, b) END AS p, CASE WHEN form <> 'plain' THEN greatest(a, b) - least(a, b) END AS m
            FROM x)
        SELECT doc_id, n, form, p AS prefix_chars, m AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t
                      WHEN 'psm' THEN '<P>' || substr(t, 1, p) || '<S>' || substr(t, p + m + 1) || '<M>' || substr(t, p + 1, m)
                      ELSE '<S>' || substr(t, p + m + 1) || '<P>' || substr(t, 1, p) || '<M>' || substr(t, p + 1, m) END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM c""",
}
