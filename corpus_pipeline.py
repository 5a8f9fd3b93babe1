"""A corpus pipeline of four filters and a packer; every stage reads what the one before wrote."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlog import workspace
from streamlog.llm import exact_dedup, language_id, packing, simhash, source_mix
from streamlog.llm.queries import documents, tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Rows in an Arrow batch. Whole texts are long, and a Python worker holds a batch several times.
BATCH_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds; the setting stays, as a stage's plan runs after its function ends."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; learned from four fifths of the labelled ones."""
    small_batches(spark)
    learn = language_id.remainder(F.col("doc_id"), 5) != 0
    return language_id.keep_identified(docs, language_id.fit(docs.where(learn)))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.keep_first(docs, exact_dedup.new_index(spark))


def near_deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    small_batches(spark)
    return simhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    _, limits = source_mix.mix(docs)
    return source_mix.apply_mix(docs, limits)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences."""
    small_batches(spark)
    cut = packing.pieces(docs, tokenizer_path())
    return packing.assign(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify),
    ("exact_dedup", deduplicate),
    ("simhash_near_dedup", near_deduplicate),
    ("source_mix", mix),
    ("packing", pack),
]

#: Language identification, tokens and fingerprints are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage. A stage's input and inner tables go when its result is stored."""
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES:
        path = workspace.new_dir(spark, f"stage-{name}")
        with workspace.scratch(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before is not None:
            workspace.delete(spark, before)
        before = path
    return docs
