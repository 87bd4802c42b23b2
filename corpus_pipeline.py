"""The corpus pipeline: quality rules, toxicity, near duplicates, repeated passages, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet in the
shared folder and read again as the next stage's docs. All stages but the last return the columns of
docs, whatever these are called; a missing lang counts as null. Null and empty texts, repeated rows
and empty tables are treated as the operators' docstrings say: documents without words fail the
quality rules, one row of each doc_id and each group of near duplicates stays, and a document of which
nothing is left after the fourth stage stays as an empty text, one id long in its sequence.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import lsh_forest, packing, quality_rules, suffix_dedup, toxicity
from tallyline.llm.storage import small_batches, stored, stored_alone

#: The rows cannot be told in SQL: stages fit models and hash texts.
ORACLE_SQL = None

USED = ("doc_id", "text", "lang")


def small(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The stage, with small batches for what of it runs only when its rows are written."""

    @wraps(stage)
    def limited(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return limited


def plain(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """docs with neutral names for the columns that no stage uses, and the way back."""
    names = {c: c if c in USED else f"other_{k}" for k, c in enumerate(docs.columns)}
    inner = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    if "lang" not in names:
        inner = inner.withColumn("lang", F.lit(None).cast("string"))
    return inner, lambda out: out.select(*[F.col(n).alias(c) for c, n in names.items()])


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie within their language's perplexity band."""
    inner, back = plain(docs)
    return back(quality_rules.assess(inner, inner.columns).filter("kept"))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity network does not call toxic."""
    inner, back = plain(docs)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return back(toxicity.classify(inner, labels).filter("predicted = 0"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    inner, back = plain(docs)
    return back(lsh_forest.deduplicated(inner))


def without_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has; n_chars, if there, follows."""
    inner, back = plain(docs)
    rest = suffix_dedup.without_repeats(inner, characters=True).withColumn("text", F.col("kept").cast("string"))
    out = back(rest)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in training sequences."""
    cut = packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"), added_vocabulary=True)
    return packing.pack(stored(cut, "pieces"))


STAGES = [
    ("quality_rules", small(good_quality)),
    ("toxicity", small(not_toxic)),
    ("near_duplicates", small(one_of_each)),
    ("suffix_dedup", small(without_passages)),
    ("packing", small(sequences)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from documents on."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored_alone(partial(stage, spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
