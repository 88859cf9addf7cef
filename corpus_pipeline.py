"""A corpus from raw documents to token ids, in five stages.

Every stage takes (spark, docs, sf_dir), works on all that the stage before kept, and returns a
DataFrame; all but the last keep the columns of ``documents``, further ones included, whatever they
are called. An empty table gives an empty one. A null id, or a null text, is a document like others: the first
is never a copy of another one and loses no passage, the second has no words. Very long texts are read whole.
Rows of one id are parts of one document; if their texts are equal, too, they are copies.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from risklake.llm import byte_bpe, decontaminate, ngram_jaccard, quality_rules, substring_dedup
from risklake.llm.queries import digest_ids
from risklake.session import cut_lineage, prepare, scratch_path
from risklake.sources.snapshots import has_map


def _apart(docs: DataFrame, *made: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the columns renamed that a stage would make anew or stumble over, and the names to go back to."""
    names = {c: f"_own_{i}" for i, c in enumerate(docs.columns) if c.lower() in made}
    return docs.withColumnsRenamed(names), {own: c for c, own in names.items()}


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; a null or empty text is rejected, as it has no words. Every row
    is judged by itself, so repeated rows and ids share one fate."""
    prepare(spark)
    rows, back = _apart(docs, *quality_rules.COLUMNS)
    kept = quality_rules.quality(rows).where("kept").drop(*quality_rules.COLUMNS)
    return kept.withColumnsRenamed(back).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each similarity class the document with the smallest id stays, and of its equal rows one: that with the least
    hash of all columns. Texts without words, and rows without an id, are in no class with others and stay."""
    prepare(spark)
    classes = cut_lineage(ngram_jaccard.similarity_classes(docs).select("doc_id", "component_id").where("doc_id IS NOT NULL"))
    later = classes.where("component_id < doc_id").select("doc_id").distinct()
    kept = docs.join(later, "doc_id", "left_anti").select(*docs.columns)
    repeated = classes.groupBy("doc_id").agg(F.count("*").alias("_rows")).where("_rows > 1").select("doc_id")
    if repeated.isEmpty():
        return kept
    plain = [c for c in docs.columns if not has_map(docs.schema[c].dataType)]
    copies = kept.join(repeated, "doc_id", "left_semi").groupBy("doc_id", F.col("text").alias("_text")).agg(
        F.min_by(F.struct(*docs.columns), F.xxhash64(*plain)).alias("_row")
    )
    return kept.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(copies.select("_row.*"))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds are cut out; a text without any stays as it is, a null one null."""
    prepare(spark)
    rows, back = _apart(docs, *substring_dedup.COLUMNS)
    cut = substring_dedup.remove_repeats(rows)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    told = cut.withColumn("text", text)
    if "n_chars" in docs.columns:
        told = told.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return told.drop(*substring_dedup.COLUMNS).withColumnsRenamed(back).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go. Of rows of one id, or without one, only those whose own text holds it."""
    prepare(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows, back = _apart(docs, "_id", "_key")
    found = decontaminate.contamination(rows, items).where("contaminated")
    bad = found.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_key"))
    return rows.join(bad, same, "left_anti").withColumnsRenamed(back).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row's text, a null one as empty, with the digests of the ids and of what they decode to."""
    prepare(spark)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return digest_ids(byte_bpe.encode_and_decode(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", apply_quality_rules),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("decontamination", drop_contaminated),
    ("byte_bpe", tokenize),
]

#: Learned references, an index search and BPE merges are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
