"""Where intermediate tables go: the folder all executors share.

``spark.checkpoint.dir`` names it. Only a local session without that setting
gets a folder of its own; on a cluster a missing setting is an error, because a
driver-local folder would be lost on, or invisible to, the executors.
"""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}
_scratch: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("scratch", default=None)


def shared_root(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="streamlog-")
    return _local_roots[app]


def new_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; nothing is created yet."""
    return f"{shared_root(spark)}/streamlog/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage and pins values that depend on how rows were partitioned
    (range boundaries, positions); the columnar file still allows pruning.
    """
    spark = df.sparkSession
    path = new_dir(spark, name)
    df.write.parquet(path)
    made = _scratch.get()
    if made is not None:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def measured(df: DataFrame, name: str = "small") -> DataFrame:
    """Store a table that is expected to be small, so that its size is known.

    Spark estimates an aggregate to be as large as its input and would shuffle
    both sides of a join with it. Once stored, the planner sees the real number
    of bytes: below ``spark.sql.autoBroadcastJoinThreshold`` it broadcasts the
    table and the other side is not shuffled, above it the join is a sort-merge
    join in which AQE splits hot keys.
    """
    return materialize(df, name)


def local_table(spark: SparkSession, columns: dict[str, pa.Array]) -> DataFrame:
    """A table of values the driver was given; the planner knows its size."""
    return spark.createDataFrame(pa.table(columns))


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete what ``materialize`` stores inside the block when the block ends.

    For micro-batches, which would otherwise leave their tables behind.
    """
    made: list[str] = []
    token = _scratch.set(made)
    try:
        yield
    finally:
        _scratch.reset(token)
        for path in made:
            delete(spark, path)


def clear(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application."""
    path = f"{shared_root(spark)}/streamlog/{spark.sparkContext.applicationId}"
    fs, folder = _file_system(spark, path)
    fs.delete(folder, True)


def list_names(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """Names in a folder that begin with ``prefix``, without starting a job."""
    fs, folder = _file_system(spark, path)
    if not fs.exists(folder):
        return []
    return sorted(name for status in fs.listStatus(folder) if (name := status.getPath().getName()).startswith(prefix))


def list_numbers(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers of the folders ``prefix<number>`` in a folder."""
    return sorted(int(name.removeprefix(prefix)) for name in list_names(spark, path, prefix))


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds a data file."""
    return any(not name.startswith(("_", ".")) for name in list_names(spark, path))


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Put a whole file in place; False, and nothing changed, if there is one of that name.

    It is written aside and renamed without overwriting, the way Spark commits
    its own checkpoints, and is as atomic as that rename is on the file system.
    """
    fs, target = _file_system(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(f"{target.getParent()}-aside/{uuid.uuid4().hex}")
    fs.mkdirs(target.getParent())
    out = fs.create(aside, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    modes = getattr(hadoop, "Options$Rename")
    strict = spark.sparkContext._gateway.new_array(modes, 1)
    strict[0] = modes.NONE
    try:
        hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(aside, target, strict)
    except Py4JJavaError as error:
        if not error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            raise
        fs.delete(aside, False)
        return False
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, read by the driver without a job."""
    fs, file = _file_system(spark, path)
    stream = fs.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    fs, folder = _file_system(spark, path)
    fs.delete(folder, True)


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the streaming query that owns a checkpoint; it outlives restarts."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]


def read_if_exists(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read a table that may not have been written yet."""
    fs, folder = _file_system(spark, path)
    if fs.exists(folder):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)
