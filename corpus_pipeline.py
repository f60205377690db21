"""A corpus from raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the result of one,
written as Parquet and read again, is the ``docs`` of the next. All but the last
return the columns of ``documents``, and further columns as they came, whatever their
names. A null text counts as empty: the language stage rejects it, the others keep it.
Repeated rows are near copies of each other, so one of them stays; a null ``doc_id``
is a document like any other; an empty table gives an empty result. Of documents that
tie, the one with the smaller hash of id and text stays.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmill.llm.base import read, row_key, saved
from salesmill.llm.language import UNKNOWN, identified
from salesmill.llm.near_copies import near_copies
from salesmill.llm.packing import pack_documents
from salesmill.llm.suffix_arrays import without_repeats
from salesmill.llm.surrogates import replaced

LEAST_SCORE = 0.3  # of a language that is believed
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def apart(stage: Stage) -> Stage:
    """The stage with further columns out of its way under names that no operator uses."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        others = [c for c in docs.columns if c not in DOCUMENT]
        hidden = {c: f"_further_{n}" for n, c in enumerate(others)}
        out = stage(spark, docs.withColumnsRenamed(hidden), sf_dir)
        return out.withColumnsRenamed({new: old for old, new in hidden.items()})

    return run


@apart
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, and those whose language is hardly better than a guess."""
    found = identified(docs)
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


@apart
def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest hash of id and text.

    Groups are those of the operator with the words and bits of its contract. The key
    comes from the contents, so that rows without id and repeated rows have one too; of
    repeated rows one stays.
    """
    keyed = docs.withColumn("_key", row_key())
    found = near_copies(keyed.select(F.col("_key").alias("doc_id"), "text"))
    stays = found.where("doc_id = component_id").select(F.col("doc_id").alias("_key")).distinct()
    kept = keyed.join(stays, "_key", "left_semi").dropDuplicates(["_key", "doc_id"])
    return kept.select(*docs.columns)


@apart
def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur again anywhere lose all their occurrences."""
    texts = without_repeats(docs, as_text=True).withColumn("n_chars", F.length("text").cast("long"))
    return texts.select(*docs.columns)


@apart
def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets give way to surrogates."""
    texts = replaced(docs).withColumn("n_chars", F.length("text").cast("long"))
    return texts.select(*docs.columns)


@apart
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences."""
    return pack_documents(docs)


STAGES = [
    ("language", known_language),
    ("near copies", one_of_near_copies),
    ("repeated passages", without_repeated_passages),
    ("surrogates", without_personal_data),
    ("packing", packed),
]

# Language models, fingerprints and packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = saved(docs, name.replace(" ", "-"))
    return docs
