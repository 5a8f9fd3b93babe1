"""A log table that knows its partitions, ends and times without reading records.

Records are Parquet files under ``append=<name>/topic=.../partition=...``. Beside them,
``_manifest/append=<name>`` holds one row per file: the topic-partition, the first offset and
the one after the last, the number of records, and the least and greatest timestamp; and a row
without a file for each topic-partition that was declared. The manifest of an append is
written after its files, so a reader sees whole appends only, and an append that is
repeated under its name replaces what a failed one left.

Metadata come from the manifest. A read from start offsets takes the files of each
topic-partition that reach beyond its own start, so one reader that lags behind does not widen
the others. Files are cut at ``FILE_RECORDS`` records, which makes them the segments of a
sparse index by offset and, by their greatest timestamps, by time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlog import model
from streamlog.workspace import list_names, local_table, measured

FILE_RECORDS = 1 << 20
MANIFEST = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("file", T.StringType()),
        T.StructField("begin", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("records", T.LongType()),
        T.StructField("least_time", T.TimestampNTZType()),
        T.StructField("greatest_time", T.TimestampNTZType()),
    ]
)
_APPENDED = T.StructType([*model.LOG.fields, T.StructField("append", T.StringType())])


@dataclass(frozen=True)
class LogTable:
    spark: SparkSession
    path: str

    # Writing

    def append(
        self, records: DataFrame, name: str, *, file_records: int = FILE_RECORDS, declared: DataFrame | None = None
    ) -> bool:
        """Add records, which have offsets, under the name of this append; False if it is there already.

        Offsets of a topic-partition must lie beyond those of earlier appends, as a log grows.
        ``declared``: topic, partition of topic-partitions that exist with or without records.
        """
        if self.has(name):
            return False
        data = f"{self.path}/append={name}"
        # Ranges of one order, so a file holds a run of offsets that no other file of the append reaches into.
        (
            records.select(*model.LOG.fieldNames()).repartitionByRange(*model.TP, "offset")
            .sortWithinPartitions(*model.TP, "offset")
            .write.mode("overwrite").option("maxRecordsPerFile", file_records).partitionBy(*model.TP).parquet(data)
        )
        written = self.spark.read.schema(model.LOG).parquet(data).select(
            *model.TP, "offset", "timestamp", F.col("_metadata.file_path").alias("file")
        )
        rows = written.groupBy(*model.TP, "file").agg(
            F.min("offset").alias("begin"), (F.max("offset") + 1).alias("end"), F.count(F.lit(1)).alias("records"),
            F.min("timestamp").alias("least_time"), F.max("timestamp").alias("greatest_time"),
        )
        if declared is not None:
            rows = rows.unionByName(declared.select(*model.TP).distinct(), allowMissingColumns=True)
        rows.select(*MANIFEST.fieldNames()).coalesce(1).write.mode("overwrite").parquet(self._manifest_path(name))
        return True

    def declare(self, partitions: DataFrame, name: str) -> bool:
        """Add topic-partitions without records."""
        if self.has(name):
            return False
        rows = self.spark.createDataFrame([], MANIFEST).unionByName(partitions.select(*model.TP).distinct(), allowMissingColumns=True)
        rows.coalesce(1).write.mode("overwrite").parquet(self._manifest_path(name))
        return True

    def has(self, name: str) -> bool:
        return "_SUCCESS" in list_names(self.spark, self._manifest_path(name))

    def _manifest_path(self, name: str) -> str:
        return f"{self.path}/_manifest/append={name}"

    # What is in the table

    def manifest(self) -> DataFrame:
        """One row per file, and one per declared topic-partition."""
        names = list_names(self.spark, f"{self.path}/_manifest", "append=")
        whole = [n for n in names if "_SUCCESS" in list_names(self.spark, f"{self.path}/_manifest/{n}")]
        if not whole:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(*[f"{self.path}/_manifest/{n}" for n in whole])

    def offset_range(self) -> DataFrame:
        """begin_offset and end_offset of every topic-partition; both are 0 for one without records."""
        ends = self.manifest().groupBy(*model.TP).agg(F.min("begin").alias("b"), F.max("end").alias("e"))
        return ends.select(
            *model.TP, F.coalesce("b", F.lit(0)).cast("bigint").alias("begin_offset"),
            F.coalesce("e", F.lit(0)).cast("bigint").alias("end_offset"),
        )

    def partitions(self) -> DataFrame:
        return self.manifest().select(*model.TP).distinct()

    # Records

    def records(self) -> DataFrame:
        return self._read(self.manifest().filter("file IS NOT NULL"))

    def _read(self, files: DataFrame) -> DataFrame:
        """Records of some files; as many names come to the driver as Spark would list."""
        paths = sorted(r["file"] for r in files.select("file").distinct().collect())
        if not paths:
            return self.spark.createDataFrame([], model.LOG)
        read = self.spark.read.schema(_APPENDED).option("basePath", self.path).parquet(*paths)
        return read.select(*model.LOG.fieldNames())

    def of(self, partitions: DataFrame) -> DataFrame:
        """Records of some topic-partitions."""
        wanted = measured(partitions.select(*model.TP).distinct(), "wanted")
        return self._read(self.manifest().filter("file IS NOT NULL").join(wanted, model.TP, "left_semi"))

    def of_topics(self, topic: Column) -> DataFrame:
        return self._read(self.manifest().filter(F.col("file").isNotNull() & topic))

    def from_starts(self, starts: DataFrame) -> DataFrame:
        """Records at or after ``starts(topic, partition, start)``; topic-partitions without a start are left out.

        Of each topic-partition only the files beyond its own start are read.
        """
        at = measured(starts.filter("start IS NOT NULL").select(*model.TP, F.col("start").alias("_start")), "starts")
        files = self.manifest().join(at, model.TP).filter(F.col("end") > F.col("_start"))
        return self._read(files).join(at, model.TP).filter("offset >= _start").drop("_start")

    # Times

    def _files_for_times(self, times: DataFrame) -> DataFrame:
        """``times(topic, partition, at)`` with the file that holds the first record at or after it, if any.

        Along the offsets of a topic-partition the greatest timestamp so far only rises. Files and times are
        merged by it: a time belongs to the first file that reaches it. One sort; no time meets every file.
        """
        in_order = Window.partitionBy(*model.TP).orderBy("begin").rowsBetween(Window.unboundedPreceding, 0)
        before = Window.partitionBy(*model.TP).orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
        files = (
            self.manifest().filter("greatest_time IS NOT NULL")
            .withColumn("so_far", F.max("greatest_time").over(in_order))
            .withColumn("earlier", F.max("greatest_time").over(before))
            .filter("earlier IS NULL OR so_far > earlier")  # others hold no first record
            .select(*model.TP, F.col("so_far").alias("at"), "file", F.lit(False).alias("asked"))
        )
        asked = times.select(*model.TP, "at", F.lit(None).cast("string").alias("file"), F.lit(True).alias("asked"))
        # From the latest time down, so that the last file seen is the first one that reaches a time.
        down = Window.partitionBy(*model.TP).orderBy(F.desc("at"), "asked").rowsBetween(Window.unboundedPreceding, 0)
        merged = files.unionByName(asked).withColumn("file", F.last("file", ignorenulls=True).over(down))
        return merged.filter("asked").select(*model.TP, "at", "file")

    def offsets_for_times(self, times: DataFrame) -> DataFrame:
        """First record at or after ``times(topic, partition, at)``: offset and timestamp, NULL if there is none.

        At most one file per time is read. In a file only records that exceed all before them can be first ones;
        they rise in offset and in time, so times and records are merged by one sort.
        """
        wanted = measured(times.select(*model.TP, "at").distinct(), "times")
        asked = measured(self._files_for_times(wanted), "files-of-times")
        files = asked.filter("file IS NOT NULL").select("file").distinct()
        paths = sorted(r["file"] for r in files.collect())
        if not paths:
            none = F.lit(None)
            return wanted.select(*model.TP, "at", none.cast("bigint").alias("offset"), none.cast("timestamp_ntz").alias("timestamp"))
        read = self.spark.read.schema(_APPENDED).option("basePath", self.path).parquet(*paths)
        read = read.select(*model.TP, "offset", "timestamp", F.col("_metadata.file_path").alias("file"))
        before = Window.partitionBy("file").orderBy("offset").rowsBetween(Window.unboundedPreceding, -1)
        first = (
            read.filter("timestamp IS NOT NULL").withColumn("so_far", F.max("timestamp").over(before))
            .filter("so_far IS NULL OR timestamp > so_far")
            .select(*model.TP, "file", F.col("timestamp").alias("at"), F.struct("offset", "timestamp").alias("hit"), F.lit(False).alias("asked"))
        )
        kind = first.schema["hit"].dataType
        sought = asked.select(*model.TP, "file", "at", F.lit(None).cast(kind).alias("hit"), F.lit(True).alias("asked"))
        down = Window.partitionBy("file").orderBy(F.desc("at"), "asked").rowsBetween(Window.unboundedPreceding, 0)
        found = first.unionByName(sought.filter("file IS NOT NULL")).withColumn("hit", F.last("hit", ignorenulls=True).over(down))
        # A time after the last record has no file and takes no part in the sort.
        missed = sought.filter("file IS NULL").select(*model.TP, "at", "hit")
        return found.filter("asked").select(*model.TP, "at", "hit").unionByName(missed).select(
            *model.TP, "at", F.col("hit.offset").alias("offset"), F.col("hit.timestamp").alias("timestamp")
        )

    def starts_for_times(self, times: DataFrame) -> DataFrame:
        """``offsets_for_times`` as start offsets, with the begin and end of each topic-partition."""
        found = self.offsets_for_times(times).select(*model.TP, F.col("offset").alias("start"))
        return found.join(self.offset_range(), model.TP, "left")


def partition_table(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """Topic-partitions 0 to n-1 of each topic, to declare them."""
    import pyarrow as pa

    pairs = [(topic, p) for topic, n in counts.items() for p in range(n)]
    return local_table(spark, {"topic": pa.array([t for t, _ in pairs], pa.string()), "partition": pa.array([p for _, p in pairs], pa.int32())})
