"""The operators' queries over the given tables, and their SQL counterparts."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.llm import (
    alignment,
    decontamination,
    exact_dedup,
    fingerprints,
    lexical_search,
    licenses,
    mixing,
    ngram_join,
    suffix_dedup,
    token_counts,
    token_files,
    toxicity,
    word_bpe,
)
from tillwright.llm.shared import benchmark, documents, new_folder

#: The end of a document in token files.
END_ID = 2


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints_of_edits(documents(spark, sf_dir))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files in folders by source, language and hundreds of ids."""
    docs = documents(spark, sf_dir)
    folder = F.floor(F.col("doc_id") / 100).cast("string")
    files = docs.select("doc_id", "text", F.concat_ws("/", "source", "lang", folder, F.col("doc_id").cast("string")).alias("path"))
    return licenses.license_scan(files, licenses.default_templates(spark))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar(documents(spark, sf_dir))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_plan(documents(spark, sf_dir))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


def op8_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = word_bpe.encode_decode(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "token-files")
    token_files.write_token_files(
        documents(spark, sf_dir), folder, public_tokenizers.path("word_bpe_49k.json"), END_ID
    )
    return token_files.ids_crc32(token_files.read_token_files(spark, folder))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked(documents(spark, sf_dir), benchmark(spark, sf_dir))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50k byte-level vocabulary (A) against the 32k pieces (B)."""
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.alignment_counts(documents(spark, sf_dir), a, b)


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(documents(spark, sf_dir), benchmark(spark, sf_dir))


QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_licenses": op2_licenses,
    "op3_token_counts": op3_token_counts,
    "op4_ngram_join": op4_ngram_join,
    "op5_mixing": op5_mixing,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_word_bpe": op8_word_bpe,
    "op9_toxicity": op9_toxicity,
    "op10_token_files": op10_token_files,
    "op11_lexical_search": op11_lexical_search,
    "op12_alignment": op12_alignment,
    "op13_decontamination": op13_decontamination,
}

ORACLE_SQL = {
    "op7_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, length(coalesce(text, '')) AS n_points,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
            FROM documents
        ), g AS (
            SELECT norm, count(*) AS group_size,
                   arg_min(doc_id, (-n_points, doc_id IS NULL, doc_id)) AS keep_id, max(n_points) AS keep_points
            FROM t GROUP BY norm
        )
        SELECT t.doc_id, g.keep_id, g.group_size,
               t.doc_id IS NOT DISTINCT FROM g.keep_id AND t.n_points = g.keep_points AS kept,
               sha256(t.norm) AS text_sha256
        FROM t JOIN g USING (norm)
    """,
    "op11_lexical_search": r"""
        WITH d AS (
            SELECT row_number() OVER () AS rid, doc_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents
        ), corpus AS (
            SELECT count(*) FILTER (len(w) > 0) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d
        ), tf AS (
            SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(w) AS term FROM d) GROUP BY rid, term
        ), weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
            FROM tf, corpus GROUP BY term
        ), norms AS (
            SELECT rid, doc_id, 75 + (25 * CAST(len(w) AS BIGINT) * n_docs) // n_terms AS m FROM d, corpus WHERE len(w) > 0
        ), impacts AS (
            SELECT rid, doc_id, term, weight * ((1000000000 * tf) // (1000 * tf + 12 * m)) AS impact
            FROM tf JOIN norms USING (rid) JOIN weights USING (term)
        ), q AS (
            SELECT qid, item_id, unnest(w) AS term
            FROM (SELECT row_number() OVER () AS qid, item_id,
                         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
                  FROM benchmark)
        ), scores AS (
            SELECT qid, item_id, rid, doc_id, CAST(sum(impact) AS BIGINT) AS score
            FROM q JOIN impacts USING (term) GROUP BY qid, item_id, rid, doc_id
        ), places AS (
            SELECT item_id, doc_id, score,
                   CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
            FROM scores WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM places WHERE rank <= 20
    """,
    "op13_decontamination": r"""
        WITH d AS (
            SELECT row_number() OVER () AS rid, doc_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents
        ), i AS (
            SELECT item_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark
        ), starts AS (
            SELECT item_id, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s
            FROM i WHERE len(w) > 0
        ), windows AS (
            SELECT DISTINCT item_id, k, array_to_string(w[s:s + k - 1], ' ') AS g FROM starts
        ), places AS (
            SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS s
            FROM d, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k
        ), grams AS (
            SELECT rid, k, s, array_to_string(w[s:s + k - 1], ' ') AS g FROM places
        ), found AS (
            SELECT rid, s, k, item_id FROM grams JOIN windows USING (k, g)
        ), hit AS (
            SELECT rid, count(DISTINCT word) AS n_hit
            FROM (SELECT rid, unnest(range(s, s + k)) AS word FROM found) GROUP BY rid
        ), named AS (
            SELECT rid, count(DISTINCT item_id) AS n_items,
                   string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
            FROM found GROUP BY rid
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hit USING (rid) LEFT JOIN named USING (rid)
    """,
}
