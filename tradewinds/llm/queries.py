"""One query per operator over its whole table, and the SQL that some are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewinds.llm import (
    chat, decontaminate, langid, licenses, merkle, negatives, neardup, packing, pieces, pii, quality, topk, toxicity,
)
from tradewinds.llm.frames import table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.digest(pii.find(docs, pii.fit(docs)))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, sf_dir, "documents")))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return licenses.scan(docs, licenses.fit(docs))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digest(chat.format_conversations(turns.unionByName(chat.control_conversation(spark))))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict_language(docs, langid.dictionaries(docs))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(pieces.encode(table(spark, sf_dir, "documents")))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return negatives.hard_negatives(vectors, F.col("vec_id") % 50 == 0)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    every_third = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    return merkle.audit(table(spark, sf_dir, "documents"), every_third, merkle.without_capitals(F.col("text")))


QUERIES = {
    "op1_pii": op1_pii,
    "op2_packing": op2_packing,
    "op3_quality": op3_quality,
    "op4_decontamination": op4_decontamination,
    "op5_licenses": op5_licenses,
    "op6_toxicity": op6_toxicity,
    "op7_chat": op7_chat,
    "op8_topk": op8_topk,
    "op9_langid": op9_langid,
    "op10_minhash": op10_minhash,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_negatives": op12_negatives,
    "op13_merkle": op13_merkle,
}

ORACLE_SQL = {
    "op7_chat": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL
            SELECT -7, turn, role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) t(turn, role)
        ), marked AS (
            SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) IS DISTINCT FROM role AS starts,
                length(replace(replace(replace(replace(text, '\', '\\'), '###', '\h'), '</turn>', '\t'), '<next/>', '\n')) AS body
            FROM turns
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            CAST(sum(body + CASE WHEN starts THEN length('### : ') + length(role) + length('</turn>') + 1
                ELSE length('<next/>') END) AS BIGINT) AS formatted_chars
        FROM marked GROUP BY conv_id
    """,
    "op8_topk": """
        WITH whole AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM whole q JOIN whole c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
    "op10_minhash": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
            FROM documents
        ), sets AS (
            SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END) AS shingle
            FROM words
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
        ), common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
            FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
        ), links AS (
            SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * k >= 75 * (x.n + y.n - k)
        ), reached AS (
            SELECT doc_id, doc_id AS other FROM documents
            UNION
            SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
        ), smallest AS (
            SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
        )
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
        FROM documents d JOIN smallest USING (doc_id) LEFT JOIN sizes USING (doc_id)
    """,
    "op12_negatives": """
        WITH whole AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
                CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM whole a JOIN whole c ON c.vec_id <> a.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 50 = 0
        ), positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT p.anchor_id, p.positive_id,
            CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
            n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
        FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
            AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
        QUALIFY rank <= 3
    """,
    "op13_merkle": """
        WITH RECURSIVE bits AS (
            SELECT i, i AS c, 0 AS step FROM range(256) t(i)
            UNION ALL
            SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, step + 1 FROM bits WHERE step < 8
        ), crc AS (
            SELECT list(c ORDER BY i) AS t FROM bits WHERE step = 8
        ), rows AS (
            SELECT doc_id, lang, text,
                coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
                    || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
                    || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
                xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT)),
                    lambda c, b: xor(c // 256, t[CAST(xor(c, b) & 255 AS BIGINT) + 1]), 4294967295), 4294967295) % 3 = 0 AS tampered
            FROM documents, crc
        ), leaves AS (
            SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS idx,
                count(*) OVER (PARTITION BY lang) AS n, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                CASE WHEN tampered THEN sha256(head || coalesce(strlen(text) || ':'
                    || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS other
            FROM rows
        ), nodes AS (
            SELECT lang, 0 AS level, idx, n, leaf AS h FROM leaves
            UNION ALL
            SELECT lang, level + 1, idx // 8, (max(n) + 7) // 8, sha256(string_agg(h, '' ORDER BY idx))
            FROM nodes WHERE n > 1 GROUP BY lang, level, idx // 8
        ), subroots AS (
            SELECT lang, h, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS idx, count(*) OVER () AS n
            FROM nodes WHERE n = 1
        ), upper_nodes AS (
            SELECT 0 AS level, idx, n, h FROM subroots
            UNION ALL
            SELECT level + 1, idx // 8, (max(n) + 7) // 8, sha256(string_agg(h, '' ORDER BY idx))
            FROM upper_nodes WHERE n > 1 GROUP BY level, idx // 8
        ), lower_sides AS (
            SELECT *, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
                coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
            FROM nodes WHERE n > 1 WINDOW w AS (PARTITION BY lang, level, idx // 8 ORDER BY idx)
        ), upper_sides AS (
            SELECT *, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
                coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
            FROM upper_nodes WHERE n > 1 WINDOW w AS (PARTITION BY level, idx // 8 ORDER BY idx)
        ), lower_path AS (
            SELECT doc_id, lang, leaf, 0 AS level, idx, coalesce(other, leaf) AS h, '' AS proof FROM leaves
            UNION ALL
            SELECT p.doc_id, p.lang, p.leaf, p.level + 1, p.idx // 8, sha256(s.before || p.h || s.after),
                p.proof || s.before || s.after
            FROM lower_path p JOIN lower_sides s ON s.lang IS NOT DISTINCT FROM p.lang AND s.level = p.level AND s.idx = p.idx
        ), upper_path AS (
            SELECT p.doc_id, p.leaf, t.h AS subroot, 0 AS level, t.idx, p.h, p.proof
            FROM lower_path p JOIN nodes d ON d.lang IS NOT DISTINCT FROM p.lang AND d.level = p.level AND d.n = 1
                JOIN subroots t ON t.lang IS NOT DISTINCT FROM p.lang
            UNION ALL
            SELECT p.doc_id, p.leaf, p.subroot, p.level + 1, p.idx // 8, sha256(s.before || p.h || s.after),
                p.proof || s.before || s.after
            FROM upper_path p JOIN upper_sides s ON s.level = p.level AND s.idx = p.idx
        )
        SELECT p.doc_id, p.leaf, p.subroot, r.h AS root, sha256(p.proof) AS proof_sha256, p.h AS folded_root, p.h = r.h AS verified
        FROM upper_path p JOIN upper_nodes r ON r.n = 1 AND r.level = p.level
    """,
}
