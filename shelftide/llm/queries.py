"""One query per operator over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelftide.llm import (
    conversation_trie,
    decontamination,
    fertility,
    license_classifier,
    line_runs,
    near_duplicates,
    ordinal_quality,
    pii_pseudonyms,
    piece_codec,
    term_fingerprints,
    token_files,
    toxicity,
    whitening,
)
from shelftide.llm.common import table
from shelftide.sources.shared import fresh_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_fertility(spark: SparkSession, folder: str) -> DataFrame:
    """A piece vocabulary with byte fallback, and a byte-level one for many languages."""
    vocabularies = (
        fertility.Vocabulary("piece", "piece", public_tokenizers.path("piece_bpe_32k.model")),
        fertility.Vocabulary("multi", "ranks", public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN),
    )
    return fertility.judge(table(spark, folder, "documents"), vocabularies)


def op2_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.find_groups(table(spark, folder, "documents"))


def op3_license_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return license_classifier.scan_documents(table(spark, folder, "documents"))


def op4_ordinal_quality(spark: SparkSession, folder: str) -> DataFrame:
    return ordinal_quality.grade_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_piece_codec(spark: SparkSession, folder: str) -> DataFrame:
    return piece_codec.codec_digests(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.find_contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("spans")


def op7_pii_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pii_pseudonyms.pseudonymise(docs, count_col="n_values")


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op9_line_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    left = line_runs.delete_repeated_runs(docs, counts=("n_lines", "n_deleted"))
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return left.select("doc_id", "n_lines", "n_deleted", digest.alias("text_sha256"))


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Written with production layout, then read back from the files."""
    coded = token_files.encode_documents(
        table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0
    )
    path = token_files.write_tokens(coded, fresh_path(spark, "tokens"))
    return token_files.with_checksums(token_files.read_tokens(spark, path))


def op11_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie.prefix_trie(table(spark, folder, "conversations"))


def op12_term_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return term_fingerprints.fingerprint_documents(table(spark, folder, "documents"))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_fertility,
        op2_near_duplicates,
        op3_license_classifier,
        op4_ordinal_quality,
        op5_piece_codec,
        op6_decontamination,
        op7_pii_pseudonyms,
        op8_toxicity,
        op9_line_runs,
        op10_token_files,
        op11_conversation_trie,
        op12_term_fingerprints,
        op13_whitening,
    )
}

SQL: dict[str, str] = {}
SQL["op6_decontamination"] = r"""
WITH dw AS (
    SELECT doc_id, row_number() OVER () AS rid,
        regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), iw AS (
    SELECT item_id,
        regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), item_windows AS (
    SELECT DISTINCT item_id, n, array_to_string(w[k : k + n - 1], ' ') AS g
    FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS k
          FROM (SELECT item_id, w, least(10, len(w)) AS n FROM iw) WHERE n > 0)
), doc_windows AS (
    SELECT rid, k, n, array_to_string(w[k : k + n - 1], ' ') AS g
    FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS k
          FROM dw, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)
), hits AS (
    SELECT d.rid, d.k, d.n, i.item_id FROM doc_windows d JOIN item_windows i ON d.n = i.n AND d.g = i.g
), words_hit AS (
    SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(k, k + n)) AS p FROM hits) GROUP BY rid
), items_hit AS (
    SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN words_hit USING (rid) LEFT JOIN items_hit USING (rid)
"""

SQL["op9_line_runs"] = r"""
WITH d AS (
    SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents
), counted AS (
    SELECT doc_id, l, list_transform(l, lambda x: len(regexp_extract_all(x, '[^\x20\x09-\x0D]+'))) AS w FROM d WHERE text IS NOT NULL
), lines AS (
    SELECT doc_id, l, k, sum(w[k]) OVER (PARTITION BY doc_id ORDER BY k) AS upto, w[k] AS own
    FROM (SELECT doc_id, l, w, unnest(range(1, len(l) + 1)) AS k FROM counted)
), runs AS (
    SELECT a.doc_id, a.k, min(b.k) AS j
    FROM lines a JOIN lines b ON a.doc_id = b.doc_id AND b.k >= a.k AND b.upto - a.upto + a.own >= 50
    GROUP BY a.doc_id, a.k
), named AS (
    SELECT r.doc_id, r.k, r.j, array_to_string(d.l[r.k : r.j], chr(10)) AS run FROM runs r JOIN d USING (doc_id)
), later AS (
    SELECT doc_id, k, j FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, k) AS n FROM named) WHERE n > 1
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(k, j + 1)) AS k FROM later
), left_over AS (
    SELECT l.doc_id, count(g.k) AS n_deleted, string_agg(l.l[l.k], chr(10) ORDER BY l.k) FILTER (g.k IS NULL) AS text
    FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.k = g.k GROUP BY l.doc_id
)
SELECT d.doc_id, CAST(coalesce(len(d.l), 0) AS BIGINT) AS n_lines, CAST(coalesce(n_deleted, 0) AS BIGINT) AS n_deleted,
    sha256(coalesce(left_over.text, '')) AS text_sha256
FROM d LEFT JOIN left_over ON d.doc_id = left_over.doc_id
"""

# Brute force: every pair of documents that share a shingle is counted.
SQL["op2_near_duplicates"] = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT DISTINCT doc_id, array_to_string(w[k : k + least(5, len(w)) - 1], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS k FROM d WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), links AS (
    SELECT u, v FROM (
        SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
    ) JOIN sizes x ON u = x.doc_id JOIN sizes y ON v = y.doc_id WHERE 100 * c >= 75 * (x.n + y.n - c)
), reached AS (
    SELECT doc_id, doc_id AS other FROM d
    UNION
    SELECT r.doc_id, l.v FROM reached r JOIN links l ON r.other = l.u
), groups AS (
    SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, component_id = d.doc_id AS kept
FROM d LEFT JOIN sizes ON d.doc_id = sizes.doc_id JOIN groups ON d.doc_id = groups.doc_id
"""

# CRC-32 bit by bit over the decimal digits; subtree figures by walking every node's prefixes.
SQL["op11_conversation_trie"] = r"""
WITH given AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
    FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
    SELECT DISTINCT conv_id,
        xor(list_reduce(
            list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT)),
            lambda crc, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7],
                lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, xor(crc, b)),
            4294967295), 4294967295) % 6 AS h
    FROM given
), turns AS (
    SELECT i.conv_id, g.k, g.role, g.text FROM ids i JOIN given g ON g.conv_id = i.conv_id - i.conv_id % 100 AND g.k <= i.h
    UNION ALL
    SELECT i.conv_id, g.k + 100, g.role, g.text FROM ids i JOIN given g ON g.conv_id = i.conv_id AND g.k > i.h
), built AS (
    SELECT i.conv_id, coalesce(s.path, []) AS path FROM ids i LEFT JOIN (
        SELECT conv_id, list({'role': role, 'text': text} ORDER BY k) AS path FROM turns GROUP BY conv_id
    ) s ON i.conv_id = s.conv_id
), prefixes AS (
    SELECT conv_id, len(path) AS own, d, path[1 : d] AS p FROM (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS d FROM built)
), nodes AS (
    SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs,
        string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (own = d) AS ends
    FROM prefixes GROUP BY p, d
), valued AS (
    SELECT n.*, u.conv_id AS parent_conv_id, CASE WHEN n.d > 0 THEN (n.n_convs - 1) * length(n.p[-1].text) ELSE 0 END AS saved,
        (SELECT count(*) FROM nodes c WHERE c.d = n.d + 1 AND c.p[1 : n.d] = n.p) AS n_children
    FROM nodes n LEFT JOIN nodes u ON u.d = n.d - 1 AND u.p = n.p[1 : n.d - 1]
), below AS (
    SELECT a.p, a.d, sum(b.saved) AS saved_tokens, count(*) FILTER (b.n_children = 0) AS n_leaves
    FROM (SELECT p, d, saved, n_children, unnest(range(0, d + 1)) AS at FROM valued) b JOIN nodes a ON a.d = b.at AND a.p = b.p[1 : b.at]
    GROUP BY a.p, a.d
)
SELECT CAST(v.conv_id AS BIGINT) AS conv_id, CAST(v.d AS BIGINT) AS depth, CAST(v.parent_conv_id AS BIGINT) AS parent_conv_id,
    CAST(v.n_convs AS BIGINT) AS n_convs, CAST(v.n_children AS BIGINT) AS n_children, CAST(b.n_leaves AS BIGINT) AS n_leaves,
    CAST(b.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(v.ends, '')) AS ends_sha256
FROM valued v JOIN below b ON v.p = b.p AND v.d = b.d
"""
