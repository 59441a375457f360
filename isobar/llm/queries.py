"""The registered queries of the training-data operators: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.llm.backoff_lm import Model, scored
from isobar.llm.decontaminate import contamination
from isobar.llm.divergence import judged
from isobar.llm.frames import token_files
from isobar.llm.interactions import audited
from isobar.llm.line_dedup import line_report
from isobar.llm.mixing import copies
from isobar.llm.multi_index import neighbours
from isobar.llm.near_duplicates import duplicate_components
from isobar.llm.neighbour_vote import quality_scores
from isobar.llm.private_terms import found
from isobar.llm.store import table
from isobar.llm.warc import archived
from isobar.llm.whitening import whitened

Query = Callable[[SparkSession, str], DataFrame]


def op1_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored(table(spark, sf_dir, "documents"), Model())
    return rows.withColumns({c: F.round(c, 6) for c in ("base_score", "score")})


def op2_neighbour_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"))


def op4_private_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return found(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.drop("text_key")


def op7_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = copies(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages"))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_components(table(spark, sf_dir, "documents"), percent=80)


def op11_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))


def op13_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_backoff_lm,
        op2_neighbour_vote,
        op3_divergence_rules,
        op4_private_terms,
        op5_line_dedup,
        op6_decontaminate,
        op7_token_frames,
        op8_mixing,
        op9_warc,
        op10_ngram_jaccard,
        op11_filter_interactions,
        op12_whitening,
        op13_multi_index,
    )
}
