"""From documents to packed training windows: quality, near-duplicates, personal data, mixing, packing.

Every stage is one of the operators in ``limes.llm`` on all rows that the stage before kept.  Stages but the last return the
columns of ``documents``: rejected documents and near-copies go, personal data is replaced by its kind in ``text``, and mixing repeats or
drops blocks of words by their source's quota, which cuts documents at blocks' edges.  The last stage returns pieces of documents in windows of token ids.

Defined results: null, empty and very short texts fail the quality rules and go; rows without a doc_id are linked with nothing and stay; rows that
repeat a kept doc_id stay together; a null source is a source of its own; extra columns, whatever their names, go along up to mixing; columns
``n_chars`` and ``n_words`` are counted again where a text is changed; without usable labels, or without documents to learn from, only
base rules and patterns decide; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from limes.llm import mixing, near_dup, packing, pii, quality
from limes.llm.common import table, written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.kept_documents(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.kept_documents(docs, near_dup.WORDS)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redacted(docs, pii.train(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", drop_near_copies),
    ("personal_data", hide_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

#: The stages train models, link documents and tokenise, none of which SQL expresses.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
