"""Registered queries of this subpackage, each over its whole table."""

import os

from moraflow.llm import (
    bpe, decontamination, line_dedup, merkle, metric_topk, pii, secrets, sharding, shingle_join, suffix_dedup, toxicity, vector_codes, window_dedup,
)
from moraflow.llm.texts import table

TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")
BYTE_BPE = f"{TOKENIZERS}/byte_bpe_50k.json"

QUERIES = {
    "op1_suffix_array_dedup": lambda spark, d: suffix_dedup.report(table(spark, d, "documents")),
    "op2_toxicity": lambda spark, d: toxicity.report(table(spark, d, "documents"), table(spark, d, "labels")),
    "op3_metric_topk": lambda spark, d: metric_topk.report(table(spark, d, "embeddings")),
    "op4_window_dedup": lambda spark, d: window_dedup.report(table(spark, d, "documents")),
    "op5_shingle_join": lambda spark, d: shingle_join.report(table(spark, d, "documents")),
    "op6_byte_bpe": lambda spark, d: bpe.encode_and_decode(table(spark, d, "documents"), BYTE_BPE),
    "op7_decontamination": lambda spark, d: decontamination.report(table(spark, d, "documents"), table(spark, d, "benchmark")),
    "op8_secret_linking": lambda spark, d: secrets.scan(table(spark, d, "documents")),
    "op9_pii_anchors": lambda spark, d: pii.find(table(spark, d, "documents")),
    "op10_line_dedup": lambda spark, d: line_dedup.report(table(spark, d, "documents")),
    "op11_feistel_shards": lambda spark, d: sharding.report(table(spark, d, "documents")),
    "op12_vector_codes": lambda spark, d: vector_codes.report(table(spark, d, "embeddings")),
    "op13_merkle_manifest": lambda spark, d: merkle.report(table(spark, d, "documents")),
}

SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"regexp_extract_all({}, '[^ \t\n\x0B\f\r]+')"

ORACLES = {
    "op3_metric_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        pairs AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x::DOUBLE[], c.x::DOUBLE[])::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
        SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
        FROM pairs QUALIFY rank <= 5""",
    "op4_window_dedup": f"""
        WITH docs AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
        windows AS (
            SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS k
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM docs WHERE len(w) >= 20)),
        firsts AS (SELECT k, min((doc_id, i)) AS f FROM windows GROUP BY k HAVING count(*) > 1),
        gone AS (
            SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p
            FROM (SELECT doc_id, i FROM windows JOIN firsts USING (k) WHERE (doc_id, i) > f)),
        lists AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM gone GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
            sha256(CASE WHEN n IS NULL THEN array_to_string(w, ' ')
                   ELSE coalesce(array_to_string(list_filter(w, lambda x, i: NOT list_contains(ps, i)), ' '), '') END) AS kept_sha256
        FROM docs LEFT JOIN lists USING (doc_id)""",
    "op5_shingle_join": f"""
        WITH RECURSIVE docs AS (SELECT doc_id, {WORDS.format(ASCII_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
        sets AS (
            SELECT doc_id, CASE WHEN len(w) >= 5 THEN
                list_distinct(list_transform(range(1, len(w) - 3), lambda i: hash(array_to_string(w[i:i + 4], ' '))))
                WHEN len(w) > 0 THEN [hash(array_to_string(w, ' '))] ELSE [] END AS s FROM docs),
        shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
        pairs AS (
            SELECT x.doc_id AS a, y.doc_id AS b FROM shingles x JOIN shingles y USING (g)
            WHERE x.doc_id <> y.doc_id AND 100 * least(x.n, y.n) >= 75 * greatest(x.n, y.n)
            GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
        reach AS (SELECT doc_id, doc_id AS r FROM sets UNION SELECT b, r FROM reach JOIN pairs ON reach.doc_id = a)
        SELECT sets.doc_id, len(any_value(s))::BIGINT AS n_shingles, min(r) AS component_id
        FROM sets JOIN reach USING (doc_id) GROUP BY sets.doc_id""",
    "op10_line_dedup": f"""
        WITH lines AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS p FROM documents),
        keys AS (SELECT *, {ASCII_LOWER.format(f"trim(line, {SPACES})")} AS k FROM lines),
        frequent AS (
            SELECT k, max(doc_id) AS keeper FROM keys WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5)
        SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (keeper IS NOT NULL AND keeper <> doc_id)::BIGINT AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (keeper IS NULL OR keeper = doc_id), '')) AS kept_sha256
        FROM keys LEFT JOIN frequent USING (k) GROUP BY doc_id""",
    "op12_vector_codes": """
        WITH v AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        parts AS (SELECT vec_id, label, p, x[p * (len(x) // 16) + 1 : (p + 1) * (len(x) // 16)] AS x FROM v, range(16) AS r(p)),
        b0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x FROM parts QUALIFY e < 64),
        a0 AS (
            SELECT vec_id, parts.p, any_value(label) AS label, any_value(parts.x) AS x,
                min((list_inner_product(parts.x, parts.x) - 2 * list_inner_product(parts.x, b.x) + list_inner_product(b.x, b.x))::BIGINT * 64 + e) AS de
            FROM parts JOIN b0 b USING (p) GROUP BY vec_id, parts.p),
        m0 AS (
            SELECT p, e, list(floor(s / n) ORDER BY i) AS x FROM (
                SELECT p, de % 64 AS e, i, sum(c) AS s, count(*) AS n
                FROM (SELECT p, de, unnest(x) AS c, generate_subscripts(x, 1) AS i FROM a0) GROUP BY ALL) GROUP BY p, e),
        b1 AS (SELECT p, e, coalesce(m0.x, b0.x) AS x FROM b0 LEFT JOIN m0 USING (p, e)),
        a1 AS (
            SELECT vec_id, parts.p, any_value(label) AS label, any_value(parts.x) AS x,
                min((list_inner_product(parts.x, parts.x) - 2 * list_inner_product(parts.x, b.x) + list_inner_product(b.x, b.x))::BIGINT * 64 + e) AS de
            FROM parts JOIN b1 b USING (p) GROUP BY vec_id, parts.p),
        m1 AS (
            SELECT p, e, list(floor(s / n) ORDER BY i) AS x FROM (
                SELECT p, de % 64 AS e, i, sum(c) AS s, count(*) AS n
                FROM (SELECT p, de, unnest(x) AS c, generate_subscripts(x, 1) AS i FROM a1) GROUP BY ALL) GROUP BY p, e),
        b2 AS (SELECT p, e, coalesce(m1.x, b1.x) AS x FROM b1 LEFT JOIN m1 USING (p, e)),
        a2 AS (
            SELECT vec_id, parts.p, any_value(label) AS label, any_value(parts.x) AS x,
                min((list_inner_product(parts.x, parts.x) - 2 * list_inner_product(parts.x, b.x) + list_inner_product(b.x, b.x))::BIGINT * 64 + e) AS de
            FROM parts JOIN b2 b USING (p) GROUP BY vec_id, parts.p),
        codes AS (
            SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', de % 64), '' ORDER BY p) AS code, sum(de // 64)::BIGINT AS error
            FROM a2 GROUP BY vec_id),
        book AS (SELECT sha256(string_agg(c::BIGINT::VARCHAR, ',' ORDER BY p, e, i)) AS h FROM (SELECT p, e, unnest(x) AS c, generate_subscripts(x, 1) AS i FROM b2))
        SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, h AS codebooks_sha256 FROM codes, book""",
}
