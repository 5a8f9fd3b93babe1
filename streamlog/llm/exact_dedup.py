"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by the SHA-256 of the normalised text.
A batch of documents is first reduced to one row per digest (partial sums before
the shuffle, so a group of copies of any size is cheap), then anti-joined with
the index by sort-merge; what is new is appended. Index buckets line up with the
exchange of the batch, so the index itself is never shuffled.

Defined results: a null text counts as empty; among equal texts the row with the
most code points stays, then the smallest id, null ids last; of rows that are also
equal in id and length a single one stays, any of them. A text that an earlier batch brought is dropped
and carries the id which the index holds. Columns of the input other than the id
and the text are never read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from streamlog import workspace

#: Bucket count of a new index. Raise it for indexes beyond about 100 GB.
BUCKETS = 256


@dataclass(frozen=True)
class DigestIndex:
    """Where an index lives; any session can attach to the folder again."""

    path: str
    buckets: int = BUCKETS

    @property
    def name(self) -> str:
        return "digest_index_" + hashlib.md5(self.path.encode()).hexdigest()

    def attach(self, spark: SparkSession, id_type: DataType) -> DataFrame:
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep_id {id_type.simpleString()},"
            " n_points BIGINT, batch STRING) USING parquet"
            f" CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )
        return spark.table(self.name)

    def append(self, fresh: DataFrame) -> None:
        spark = fresh.sparkSession
        columns = spark.table(self.name).columns
        (
            fresh.select(*columns)
            .repartition(self.buckets, "digest")
            .write.format("parquet")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .option("path", self.path)
            .mode("append")
            .saveAsTable(self.name)
        )

    def detach(self, spark: SparkSession) -> None:
        """Forget the table in this session; the folder stays."""
        spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", "")


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


def new_index(spark: SparkSession, buckets: int = BUCKETS) -> DigestIndex:
    return DigestIndex(workspace.new_dir(spark, "digest-index"), buckets)


def _decide(
    docs: DataFrame, index: DigestIndex, batch: str, id_col: str, text_col: str
) -> tuple[DataFrame, DataFrame]:
    """Narrow rows, and one decision per digest; what the index does not hold is appended to it.

    A row number only tells rows of this run apart that are equal in digest, id and length; it is
    never kept, so a repeated run under the same name decides alike wherever its rows lie.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = workspace.materialize(
        docs.select(
            F.col(id_col).alias("id"), digest(F.col(text_col)).alias("digest"), F.length(text).cast("long").alias("n_points")
        ).withColumn("row", F.monotonically_increasing_id()),
        "digests",
    )
    # By digest, id and length first: copies under many ids are summed up in as many groups.
    equal = rows.groupBy("digest", "id", "n_points").agg(F.count(F.lit(1)).alias("n_same"), F.min("row").alias("row"))
    order = F.struct(-F.col("n_points"), F.col("id").isNull(), F.col("id"), F.col("row"), F.col("n_same"))
    groups = workspace.materialize(
        equal.groupBy("digest")
        .agg(F.min(order).alias("first"), F.sum("n_same").alias("group_size"))
        .select(
            "digest", "group_size", F.col("first.id").alias("keep_id"), (-F.col("first.col1")).alias("n_points"),
            F.col("first.row").alias("keep_row"), F.col("first.n_same").alias("n_same"),
        ),
        "digest-groups",
    )
    known = index.attach(spark, docs.schema[id_col].dataType)
    fresh = groups.join(known.hint("merge"), "digest", "left_anti")
    index.append(fresh.withColumn("batch", F.lit(batch)))
    held = spark.table(index.name).select("digest", F.col("keep_id").alias("held_id"), "batch")
    decided = groups.join(held.hint("merge"), "digest").select(
        "digest", "group_size", F.col("held_id").alias("keep_id"), "n_points", "keep_row", "n_same", (F.col("batch") == batch).alias("fresh")
    )
    # Stored, so that the join with the rows has an exchange on either side and
    # a large group of copies can be split.
    decided = workspace.materialize(decided, "digest-decisions")
    index.detach(spark)
    return rows, decided


def deduplicate(
    docs: DataFrame, index: DigestIndex, batch: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, ``keep_id``, ``group_size`` in the batch, ``kept``, ``digest``, ``fresh``.

    Texts that the index does not hold are appended to it. ``batch`` names the
    batch; a repeated run under the same name gives the same answer, also if the rows
    are partitioned otherwise. ``fresh`` tells whether this batch brought the text.
    """
    rows, decided = _decide(docs, index, batch or uuid.uuid4().hex, id_col, text_col)
    return rows.join(decided.drop("n_points", "n_same"), "digest").select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        (F.col("fresh") & (F.col("row") == F.col("keep_row"))).alias("kept"),
        "digest",
        "fresh",
    )


def keep_first(docs: DataFrame, index: DigestIndex, batch: str | None = None) -> DataFrame:
    """The documents that stay, with all their columns.

    The same plan at every size: decisions are made on narrow rows, then whole documents
    pass one exchange, by digest, id and length, in which copies under many ids spread. Of rows
    that are equal in all three one is taken, after a partial aggregate.
    """
    _, decided = _decide(docs, index, batch or uuid.uuid4().hex, "doc_id", "text")
    stays = decided.where("fresh").select(
        F.col("digest").alias("_digest"), F.col("keep_id").alias("_id"), F.col("n_points").alias("_points"), F.col("n_same").alias("_same")
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    marked = docs.withColumn("_d", digest(F.col("text"))).withColumn("_n", F.length(text).cast("long"))
    hit = (F.col("_d") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_n") == F.col("_points"))
    found = marked.join(stays.hint("merge"), hit)
    once, repeated = found.where("_same = 1"), found.where("_same > 1").dropDuplicates(["_d"])
    return once.unionByName(repeated).select(*docs.columns)
