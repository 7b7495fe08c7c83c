"""The numbered operators as queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from terracat.llm.common import table
from terracat.llm.decontaminate import find_contamination
from terracat.llm.html_text import extract_pages
from terracat.llm.near_dup import near_duplicates
from terracat.llm.neighbor_quality import fit_neighbors, score_quality
from terracat.llm.oracles import ORACLES  # noqa: F401  (read by the entry point)
from terracat.llm.packing import pack_documents
from terracat.llm.periodic_runs import periodic_runs, repeat_tail, run_digest
from terracat.llm.quality import judge_quality
from terracat.llm.substring_dedup import dedup_substrings
from terracat.llm.suffix_dedup import dedup_bytes
from terracat.llm.token_alignment import align_tokens
from terracat.llm.tokens import token_index
from terracat.llm.toxicity import fit_toxicity, score_toxicity
from terracat.llm.warc import archive_pages

WORD_BPE, BYTE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10).drop("hit_spans")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_index(table(spark, sf_dir, "documents"), WORD_BPE, "dropped", 1)


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages"), smallest=0)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents"), window=50).drop("kept_text")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), BYTE_BPE, "kept", 0, 2048)


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_bytes(table(spark, sf_dir, "documents"), window=50).drop("kept_text")


def op11_quality_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, fit_neighbors(docs, table(spark, sf_dir, "labels")))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(table(spark, sf_dir, "documents"), BYTE_BPE, PIECE_BPE)[0]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digest(periodic_runs(table(spark, sf_dir, "documents"), rewrite=repeat_tail))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_minhash_near_dedup, op2_decontamination, op3_quality_rules, op4_token_files, op5_html_text, op6_warc, op7_toxicity, op8_substring_dedup, op9_best_fit_packing, op10_suffix_array_dedup, op11_quality_neighbors, op12_token_alignment, op13_periodic_runs)}
