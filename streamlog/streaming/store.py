"""An output log that many writers fill batch by batch.

A batch of a writer is two folders: its records, and one small commit file with
all source offsets the writer has covered and all ends of its output. Both become
visible together by one numbered file, the publication, which names for each writer
the batches that count. It is created only if its number is free: of two writers
that publish at the same moment one finds the number taken, looks again at what is
published by then, and either takes the next number or fails. A batch that failed
before that is written again; a published one is never written twice. The newest
publication and the commit files it names are all that a micro-batch reads, and
older ones are deleted, so its cost does not grow with their number.

``writer`` names one streaming query, whose id is kept with its commits. Writers
share an output log if no topic-partition is written by more than one of them at
a time; a writer whose offsets meet another one's fails when it publishes. Each
start of a writer claims the next epoch, which fences earlier starts that still
run: they stage into folders of their own epoch, which no reader takes from then
on, and fail when they publish.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlog import model
from streamlog.functions import partitioner
from streamlog.sources import log
from streamlog.workspace import create_file, delete, list_numbers, read_if_exists, read_text

_BATCH = [
    T.StructField("writer", T.StringType()),
    T.StructField("epoch", T.LongType()),
    T.StructField("batch_id", T.LongType()),
]

RECORDS = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        *_BATCH,
    ]
)

COMMITS = T.StructType(
    [
        T.StructField("kind", T.StringType()),  # "source", "end" or "batch"
        T.StructField("group_id", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("metadata", T.StringType()),
        T.StructField("writer", T.StringType()),
        T.StructField("query", T.StringType()),
        T.StructField("epoch", T.LongType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

BATCH_KEYS = ["writer", "epoch", "batch_id"]
# Newest publications, and commit files of a writer, that are kept.
KEPT_COMMITS = 5


@dataclass(frozen=True)
class OutputLog:
    spark: SparkSession
    root: str

    def _published(self) -> tuple[int, dict[str, dict]]:
        """Number of the newest publication, -1 for none, and what it says of each writer.

        ``query`` and ``epoch`` of its latest start, ``batch_id`` and ``commit`` of
        its last batch, and in ``last`` the last batch of each epoch that has one.
        """
        numbers = list_numbers(self.spark, f"{self.root}/published", "")
        if not numbers:
            return -1, {}
        return numbers[-1], json.loads(read_text(self.spark, f"{self.root}/published/{numbers[-1]}"))

    def _publish_next(self, number: int, writers: dict[str, dict]) -> bool:
        """Follow publication ``number``; False if another one has followed it already."""
        if not create_file(self.spark, f"{self.root}/published/{number + 1}", json.dumps(writers)):
            return False
        kept = list_numbers(self.spark, f"{self.root}/published", "")
        if number >= 0 and number not in kept:
            # So many have followed that the number was free again; readers take the newest.
            delete(self.spark, f"{self.root}/published/{number + 1}")
            return False
        for old in kept[:-KEPT_COMMITS]:
            delete(self.spark, f"{self.root}/published/{old}")
        return True

    def _own(self, writers: dict[str, dict], writer: str, query_id: str | None) -> dict:
        """What is published of ``writer``; fails if it belongs to another query than ``query_id``."""
        mine = writers.get(writer, {"query": str(query_id), "epoch": 0, "batch_id": -1, "commit": None, "last": {}})
        if mine["query"] != str(query_id):
            raise RuntimeError(
                f"writer {writer} of {self.root} belongs to query {mine['query']}, not to {query_id}:"
                " continue with its checkpoint, or use another writer name"
            )
        return mine

    def claim(self, writer: str, query_id: str | None = None) -> int:
        """Begin a new epoch of ``writer`` and fence all earlier ones; what they left unpublished is deleted."""
        while True:
            number, writers = self._published()
            mine = self._own(writers, writer, query_id)
            epoch = mine["epoch"] + 1
            if self._publish_next(number, writers | {writer: mine | {"epoch": epoch}}):
                break
        before = f"{self.root}/records/writer={writer}/epoch={epoch - 1}"
        for batch in list_numbers(self.spark, before, "batch_id="):
            if batch > mine["last"].get(str(epoch - 1), -1):
                delete(self.spark, f"{before}/batch_id={batch}")
        return epoch

    def commits(self) -> DataFrame:
        """The newest commit file of each writer; it holds all that the writer has reached."""
        return self._commits(self._published()[1])

    def _commits(self, writers: dict[str, dict]) -> DataFrame:
        newest = [f"{self.root}/{mine['commit']}" for mine in writers.values() if mine["commit"]]
        if not newest:
            return self.spark.createDataFrame([], COMMITS)
        return self.spark.read.schema(COMMITS).option("basePath", f"{self.root}/commits").parquet(*newest)

    def records(self) -> DataFrame:
        """Records of committed batches: a writer publishes its batches in order.

        The batches that count are one number per writer and start, known to the driver. They are
        compared with the names of the folders: other folders are not read, and records not shuffled.
        """
        stored = read_if_exists(self.spark, f"{self.root}/records", RECORDS)
        last = {f"{e}/{w}": n for w, mine in self._published()[1].items() for e, n in mine["last"].items()}
        counts = F.lit(False)
        if last:
            of_start = F.map_from_arrays(F.array(*map(F.lit, last)), F.array(*map(F.lit, last.values())))
            counts = F.col("batch_id") <= of_start[F.concat_ws("/", "epoch", "writer")]
        return stored.filter(counts).select(*RECORDS.fieldNames())

    def last_batch(self, writer: str, query_id: str | None = None) -> int:
        """Number of the last batch published by ``writer``, -1 for none.

        Fails if another query than ``query_id`` published it: its batches are
        numbered by another checkpoint, so numbers cannot be compared.
        """
        return self._own(self._published()[1], writer, query_id)["batch_id"]

    def is_published(self, writer: str, batch_id: int, query_id: str | None = None) -> bool:
        return batch_id <= self.last_batch(writer, query_id)

    def ends(self) -> DataFrame:
        """End offset per topic-partition, from the commit files alone."""
        return (
            self.commits()
            .filter("kind = 'end'")
            .groupBy(*model.TP)
            .agg(F.max("offset").alias("end_offset"))
        )

    def _local_ends(self) -> DataFrame | None:
        """``ends`` as a table of values, which joins without a job of its own; None if there are none."""
        rows = self.ends().collect()
        return self.spark.createDataFrame(rows, self.ends().schema) if rows else None

    def source_offsets(self) -> DataFrame:
        """Committed source offsets per group and topic-partition."""
        return (
            self.commits()
            .filter("kind = 'source'")
            .groupBy(*model.GTP)
            .agg(F.max("offset").alias("offset"), F.max_by("metadata", "offset").alias("metadata"))
        )

    def stage(
        self, records: DataFrame, writer: str, batch_id: int, order_by: list[str], *,
        partitions: int | None = None, epoch: int = 0,
    ) -> log.Placed:
        """Write a batch's records with offsets; nobody sees them yet.

        Records without a partition get that of their key, which needs the number
        of ``partitions``. ``epoch``: what ``claim`` returned, 0 without a claim.
        """
        choices = [F.col("partition")]
        if partitions is not None:
            choices.append(partitioner.partition_for_key(F.col("key"), partitions))
        choices.append(F.raise_error(F.lit("record without partition")).cast("int"))
        placed = log.place_sorted(
            records.withColumn("partition", F.coalesce(*choices)),
            order_by=order_by,
            base=self._local_ends(),
        )
        path = f"{self.root}/records/writer={writer}/epoch={epoch}/batch_id={batch_id}"
        # No folders per topic-partition: a micro-batch would be cut into tiny files.
        # The files are sorted by it, so their statistics prune.
        (
            placed.records.select(*model.TP, "offset", "timestamp", "key", "value")
            .write.mode("overwrite")
            .parquet(path)
        )
        schema = T.StructType([f for f in RECORDS.fields if f.name not in BATCH_KEYS])
        return log.Placed(self.spark.read.schema(schema).parquet(path), placed.ends)

    def publish(
        self, staged: log.Placed, source: DataFrame, writer: str, batch_id: int, query_id: str | None = None, *,
        epoch: int = 0,
    ) -> None:
        """Make a staged batch visible together with the source offsets it covers.

        One commit file with a row per topic-partition that the writer has ever reached,
        one per source topic-partition, and one for the batch itself; the driver puts
        it together, so it sees as many rows as there are topic-partitions. Older files
        of the writer are then of no use and go, but for the last few, which
        readers may still have open. Fails if the writer has been claimed again since
        ``epoch``, or if another writer has meanwhile published offsets that this batch
        gives out too. If others publish at the same moment, all is checked again.
        """
        ends = {(r["topic"], r["partition"]): r for r in staged.ends.collect()}
        offsets = source.select(*model.GTP, "offset", "metadata").collect()
        commit = f"commits/writer={writer}/query={query_id}/epoch={epoch}/batch_id={batch_id}"
        tried = False
        while True:
            number, writers = self._published()
            mine = self._own(writers, writer, query_id)
            if mine["epoch"] != epoch:
                raise RuntimeError(f"writer {writer} of {self.root} is fenced: epoch {epoch}, claimed since by {mine['epoch']}")
            if tried and mine["commit"] == commit:
                return
            before = self._commits(writers).collect()
            self._require_free(before, ends, writer)
            reached = {tuple(r[:4]): tuple(r[4:6]) for r in before if r["writer"] == writer and r["kind"] != "batch"}
            reached |= {("end", None, *tp): (r["end_offset"], None) for tp, r in ends.items()}
            for row in offsets:
                key = ("source", row["group_id"], row["topic"], row["partition"])
                if row["offset"] >= reached.get(key, (row["offset"],))[0]:
                    reached[key] = (row["offset"], row["metadata"])
            rows = [(*key, *value) for key, value in reached.items()] + [("batch", None, None, None, None, None)]
            table = self.spark.createDataFrame(rows, T.StructType(COMMITS.fields[:6]))
            table.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/{commit}")
            last = mine["last"] | {str(epoch): batch_id}
            if self._publish_next(number, writers | {writer: mine | {"batch_id": batch_id, "commit": commit, "last": last}}):
                break
            tried = True
        self._drop_commits(f"{self.root}/commits/writer={writer}/query={query_id}", epoch, batch_id - KEPT_COMMITS)

    def _require_free(self, before: list, ends: dict, writer: str) -> None:
        """Fail if another writer has published offsets that this batch gives out too."""
        for row in before:
            mine = ends.get((row["topic"], row["partition"]))
            if row["kind"] == "end" and row["writer"] != writer and mine and mine["first_offset"] < row["offset"]:
                raise RuntimeError(
                    f"{row['topic']}/{row['partition']} of {self.root}: writer {row['writer']} has published offsets"
                    f" up to {row['offset']}, this batch of {writer} starts at {mine['first_offset']}"
                )

    def _drop_commits(self, folder: str, epoch: int, last: int) -> None:
        """Delete commit files of batches up to ``last``, and what earlier epochs leave empty."""
        for e in list_numbers(self.spark, folder, "epoch="):
            batches = list_numbers(self.spark, f"{folder}/epoch={e}", "batch_id=")
            for old in (b for b in batches if b <= last):
                delete(self.spark, f"{folder}/epoch={e}/batch_id={old}")
            if e < epoch and all(b <= last for b in batches):
                delete(self.spark, f"{folder}/epoch={e}")
