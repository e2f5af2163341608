"""Queries of the training-data operators: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from blotter.llm import (
    chunk_dedup, html_wrapper, ngram_join, packing, quality_cnn, quality_rules, rank_profiles, repeat_windows, secret_scan, sentencepiece_codec, spelling_groups, sql,
    token_counts, vector_codes,
)
from blotter.llm.shared import table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), BYTE_BPE)


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_windows.remove_repeats(table(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), WORD_BPE)


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrapper.main_texts(table(spark, sf_dir, "pages"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_spans(table(spark, sf_dir, "documents"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.round_trips(table(spark, sf_dir, "documents"), PIECE_BPE)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_cnn.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups.spelling_groups(table(spark, sf_dir, "documents"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_profiles.languages(table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compressed(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_ngram_jaccard_join, op2_exact_dedup, op3_token_counts, op4_suffix_array_dedup, op5_best_fit_packing, op6_html_extraction,
             op7_quality_rules, op8_secret_scans, op9_sentencepiece, op10_quality_classifier,
             op11_spelling_variants, op12_language_id, op13_vector_codes, pipeline]
    return {f.__name__: f for f in found}


#: White space of the word definitions, as a class.
_W = r"[ \t\n\x0B\f\r]"

_OP2 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '{_W}', '', 'g') AS norm FROM documents
), r AS (
  SELECT doc_id, norm, length(t) AS chars, sha256(norm) AS text_sha256 FROM d
)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept,
       text_sha256
FROM r
WINDOW w AS (PARTITION BY norm ORDER BY chars DESC, doc_id)
"""


def oracle_sql() -> dict[str, str]:
    """SQL for the operators that it can express on whole tables; the others are tested against brute force."""
    return {
        "op1_ngram_jaccard_join": sql.SHINGLE_GROUPS,
        "op2_exact_dedup": _OP2,
        "op4_suffix_array_dedup": sql.REPEATED_BYTES,
        "op11_spelling_variants": sql.SPELLING,
        "op12_language_id": sql.LANGUAGES,
        "op13_vector_codes": sql.VECTOR_CODES,
    }
