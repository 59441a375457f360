"""The corpus pipeline: documents to token files, each stage one operator of ``isobar.llm``.

Each stage reads the table that the one before has written, all of it.  All but
the last return the columns of ``documents``, whatever these are called; the last
returns what its files hold.

Rows are documents of their own: a null doc_id is an id like any other, and rows
that share one aren't told apart by it.  Null, empty and wordless texts fail the
quality rules.  Very long texts are read whole.  An empty table stays empty
through all stages, and the last one gives no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from isobar.llm.decontaminate import decontaminated
from isobar.llm.divergence import passing
from isobar.llm.frames import token_files
from isobar.llm.mixing import mixed
from isobar.llm.near_duplicates import without_duplicates
from isobar.llm.store import ship, table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules go.

    Each row is judged by its own text; references are sums over the whole input,
    by ``lang`` where that is known.  Without references only the base rule holds.
    """
    ship(spark)
    return passing(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id stays of each group of near duplicates.

    Null ids come after all others; of several texts with that id one stays, by a
    hash, and of equal rows any one.  Rows with empty sets would all stay.
    """
    ship(spark)
    return without_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items go: those with hits in one word of twenty or more.

    Null and empty items, and an empty benchmark, take nothing away.
    """
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come to their targets; a document may be there twice.

    A null source is one too.  Equal rows share their copies out among them.
    """
    return mixed(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, and what was read back from them: a row for each document, null ids first, equal ids one after the other."""
    ship(spark)
    return token_files(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_output", token_output),
]

#: SQL can express neither the tokenizer nor the divergence rules; the stages are tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
