"""One query for each operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyroll.llm import bpe, collocations, cotraining, html_text, jaccard, maxscore, packing, quality_rules, token_counts, toxicity, url_filter, warc, whitening

BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_classes(_table(spark, sf_dir, "documents"), width=5, percent=75)


def op3_warc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(_table(spark, sf_dir, "pages"), least_bytes=0)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_BPE), limit=4096)


def op5_maxscore_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.top_k(_table(spark, sf_dir, "embeddings"), k=20, every=20, scale=64)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.ledger(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       (~quality_rules.passes("base")).alias("base_failed"), quality_rules.passes().alias("kept"), "failed")


def op8_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), length=2048, end_id=1).drop("source")


def op9_cotraining_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def op11_setm_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"), longest=4, least=30, top=2000)


def op12_exact_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"), k=4, scale=256)


def op13_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_bpe_round_trip, op2_ngram_jaccard, op3_warc_records, op4_token_counts, op5_maxscore_top_k, op6_url_filter,
                            op7_quality_rules, op8_mixture_packing, op9_cotraining_quality, op10_ordinal_toxicity, op11_setm_collocations, op12_exact_whitening,
                            op13_text_density)}
