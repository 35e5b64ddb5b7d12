"""The registered queries of the package: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillwise.llm import (
    alignment, compression_bands, conversation_trie, decontamination, html_layout, link_graph, merge_dropout, prefix_counts,
    quality_classifier, secret_scan, superminhash, token_codes, toxicity,
)
from tillwise.llm.tables import table


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return toxicity.score_toxicity(documents, toxicity.fit_toxicity(documents, table(spark, folder, "labels")))


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op3_compression_bands(spark: SparkSession, folder: str) -> DataFrame:
    return compression_bands.judge_texts(table(spark, folder, "documents"))


def op4_merge_dropout(spark: SparkSession, folder: str) -> DataFrame:
    return merge_dropout.encode(table(spark, folder, "documents"))


def op5_html_layout(spark: SparkSession, folder: str) -> DataFrame:
    return html_layout.extract_text(table(spark, folder, "pages"))


def op6_superminhash(spark: SparkSession, folder: str) -> DataFrame:
    return superminhash.deduplicate(table(spark, folder, "documents"), size=3, percent=85)


def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.span_digests(secret_scan.find_secrets(table(spark, folder, "documents")))


def op8_token_codes(spark: SparkSession, folder: str) -> DataFrame:
    return token_codes.round_trip(table(spark, folder, "documents"))


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    pooled = quality_classifier.pool_documents(table(spark, folder, "documents"))
    return quality_classifier.score_quality(pooled, quality_classifier.fit_quality(pooled, table(spark, folder, "labels")))


def op10_link_graph(spark: SparkSession, folder: str) -> DataFrame:
    return link_graph.judge_urls(table(spark, folder, "pages"))


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align(table(spark, folder, "documents"))


def op12_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie.prefix_trie(table(spark, folder, "conversations"))


def op13_prefix_counts(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_counts.token_budget(prefix_counts.prefix_counts(table(spark, folder, "documents")))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_decontamination": op2_decontamination,
    "op3_compression_bands": op3_compression_bands,
    "op4_merge_dropout": op4_merge_dropout,
    "op5_html_layout": op5_html_layout,
    "op6_superminhash": op6_superminhash,
    "op7_secret_scan": op7_secret_scan,
    "op8_token_codes": op8_token_codes,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_link_graph": op10_link_graph,
    "op11_alignment": op11_alignment,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_prefix_counts": op13_prefix_counts,
}

#: All shingles of all documents joined with each other: fit for small tables.
_NEAR_DUPLICATES = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda k: array_to_string(w[k:k + 2], ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')]
        ELSE [] END) AS shingle
    FROM words
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id
), links AS (
    SELECT x, y FROM shared
    JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
    WHERE 100 * shared.n >= 85 * (p.n + q.n - shared.n)
), reached AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT reached.doc_id, links.y FROM reached JOIN links ON reached.other = links.x
), components AS (
    SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
)
SELECT documents.doc_id, coalesce(sizes.n, 0) AS n_shingles, component_id, documents.doc_id = component_id AS kept
FROM documents JOIN components USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

#: crc32 byte by byte, bit by bit; every node of every rebuilt conversation with all its ancestors.
_PREFIX_TRIE = r"""
WITH turns AS (
    SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
        coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
    SELECT c, xor(list_reduce(
        list_prepend(4294967295::UBIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
        lambda crc, byte: list_reduce(
            list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
            lambda x, bit: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))), 4294967295::UBIGINT)::BIGINT % 4 AS h
    FROM (SELECT DISTINCT c FROM turns)
), begun AS (
    SELECT ids.c, turns.pos, role, text FROM ids JOIN turns ON turns.c = ids.c - ids.c % 20 AND turns.pos <= h
), sizes AS (
    SELECT c, count(*) AS m FROM begun GROUP BY c
), rebuilt AS (
    SELECT * FROM begun
    UNION ALL
    SELECT c, coalesce(m, 0) + pos - h, role, text FROM ids JOIN turns USING (c) LEFT JOIN sizes USING (c) WHERE pos > h
), paths AS (
    SELECT c, 0 AS depth, '' AS name, 0 AS words FROM ids
    UNION ALL
    SELECT c, pos, string_agg(sha256(length(role) || ':' || role || text), '/') OVER (PARTITION BY c ORDER BY pos),
        len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))
    FROM rebuilt
), nodes AS (
    SELECT depth, name, min(c) AS conv_id, count(*) AS n_convs, max(words) AS words FROM paths GROUP BY depth, name
), members AS (
    SELECT c, depth, conv_id FROM paths JOIN nodes USING (depth, name)
), parents AS (
    SELECT nodes.*, members.conv_id AS parent_conv_id FROM nodes LEFT JOIN members ON members.c = nodes.conv_id AND members.depth = nodes.depth - 1
), children AS (
    SELECT depth - 1 AS depth, parent_conv_id AS conv_id, count(*) AS n_children FROM parents WHERE depth > 0 GROUP BY ALL
), own AS (
    SELECT parents.*, coalesce(n_children, 0) AS n_children FROM parents LEFT JOIN children USING (depth, conv_id)
), sums AS (
    SELECT members.depth, members.conv_id, sum((own.n_children = 0)::INT)::BIGINT AS n_leaves, sum((own.n_convs - 1) * own.words)::BIGINT AS saved_tokens
    FROM own JOIN members ON members.c = own.conv_id AND members.depth <= own.depth
    GROUP BY ALL
), ends AS (
    SELECT depth, conv_id, string_agg(c::VARCHAR, ',' ORDER BY c) AS list
    FROM (SELECT c, max(depth) AS depth FROM paths GROUP BY c) JOIN members USING (c, depth)
    GROUP BY ALL
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(coalesce(list, '')) AS ends_sha256
FROM own JOIN sums USING (depth, conv_id) LEFT JOIN ends USING (depth, conv_id)
"""

#: The other operators train, compress, parse or use a tokenizer: tests hold them against brute force.
ORACLE_SQL: dict[str, str] = {"op6_superminhash": _NEAR_DUPLICATES, "op12_conversation_trie": _PREFIX_TRIE}
