"""The queries of this package and their SQL, added to the entry points if the package is there."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import bpe, license_scan, lsh_forest, packing, quality_gam, quality_rules, shallot, suffix_dedup, topk, toxicity, url_filter, variants, wrappers
from tallyline.llm.storage import stored

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document."""
    docs, labels = (_table(spark, sf_dir, t) for t in ("documents", "labels"))
    judged = toxicity.classify(docs.select("doc_id", "text"), labels)
    return judged.select("doc_id", "held_out", "score", "predicted")


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    return topk.search(_table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 50 == 0)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages of earlier ones."""
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    rest = suffix_dedup.without_repeats(docs)
    return rest.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    judged = quality_rules.assess(_table(spark, sf_dir, "documents"), ["doc_id"])
    return judged.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept", "perplexity")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of documents with its sequence."""
    docs = _table(spark, sf_dir, "documents")
    cut = packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"), added_vocabulary=True)
    return packing.pack(stored(cut, "pieces"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses that every document names or quotes."""
    return license_scan.scan(_table(spark, sf_dir, "documents")).drop("spans")


def op7_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every document."""
    return lsh_forest.near_duplicates(_table(spark, sf_dir, "documents"), size=3, threshold=85)


def op8_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    found = wrappers.extract(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded bytes of every document."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(bpe.round_trip(docs, path, public_tokenizers.PATTERN))


def op10_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    docs, labels = (_table(spark, sf_dir, t) for t in ("documents", "labels"))
    return quality_gam.classify(docs, labels)


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's address."""
    return url_filter.judge(_table(spark, sf_dir, "pages").select("page_id", "url"))


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with the spelling that it goes back to."""
    return variants.group(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_shallot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster of every vector."""
    return shallot.cluster(_table(spark, sf_dir, "embeddings"))


def base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can tell of op4: the base counts and the base rule."""
    return op4_quality_rules(spark, sf_dir).drop("kept", "perplexity")


def base_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can tell of op6: the places of the phrases, and their labels."""
    return op6_license_scan(spark, sf_dir).drop("labels", "score")


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can tell of op11: host, path, the rule, and the verdict where there is one."""
    by_rule = F.when(F.col("rule").isNotNull(), F.col("verdict")).alias("rule_verdict")
    return op11_url_filter(spark, sf_dir).select("page_id", "host", "path", "rule", by_rule)


def llm_queries() -> dict[str, Query]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_exact_topk": op2_exact_topk,
        "op3_suffix_dedup": op3_suffix_dedup,
        "op4_quality_rules": op4_quality_rules,
        "op5_best_fit_packing": op5_best_fit_packing,
        "op6_license_scan": op6_license_scan,
        "op7_lsh_forest": op7_lsh_forest,
        "op8_wrappers": op8_wrappers,
        "op9_byte_bpe": op9_byte_bpe,
        "op10_quality_gam": op10_quality_gam,
        "op11_url_filter": op11_url_filter,
        "op12_variants": op12_variants,
        "op13_shallot": op13_shallot,
        "base_counts": base_counts,
        "base_licenses": base_licenses,
        "url_rules": url_rules,
    }


def llm_oracles() -> dict[str, str]:
    return {
        "op2_exact_topk": topk.ORACLE,
        "op3_suffix_dedup": suffix_dedup.ORACLE,
        "op7_lsh_forest": lsh_forest.ORACLE,
        "op12_variants": variants.ORACLE,
        "op13_shallot": shallot.oracle(),
        "base_counts": quality_rules.BASE_ORACLE,
        "base_licenses": license_scan.BASE_ORACLE,
        "url_rules": url_filter.RULES_ORACLE,
    }
