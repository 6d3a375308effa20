"""Session settings every job relies on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

BATCH_BYTES = "4m"


def configure(spark: SparkSession) -> SparkSession:
    """Tick times carry no zone, so the session zone is pinned to UTC and no
    conversion between zoned and unzoned times can move a tick. Partition values
    such as ``0000`` are text and must not be read back as numbers."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    return spark


def small_batches(spark: SparkSession) -> None:
    """Send long texts to Python a few MB at a time. A batch is held by the JVM, by the
    stream between and by Python, and by default is as large as 10,000 rows make it."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def build(master: str = "local[*]", app: str = "tickloom", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder the cluster names; in local mode a fresh one."""
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tickloom-"))
        folder = context.getCheckpointDir()
    return folder


def _file_system(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def folder_exists(spark: SparkSession, folder: str) -> bool:
    files, path = _file_system(spark, folder)
    return bool(files.exists(path))


def delete_folder(spark: SparkSession, folder: str) -> bool:
    """Delete a folder of any file system; false if there is none."""
    files, path = _file_system(spark, folder)
    return bool(files.exists(path) and files.delete(path, True))


def move_only_file(spark: SparkSession, folder: str, target: str) -> None:
    """Give the one data file of a written folder a name of its own."""
    files, source = _file_system(spark, folder)
    (found,) = [s.getPath() for s in files.listStatus(source) if s.getPath().getName().startswith("part-")]
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    files.mkdirs(path.getParent())
    if not files.rename(found, path):
        raise OSError(f"{target} cannot be written")


def _write_scratch(df: DataFrame) -> tuple[str, DataFrame]:
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/staged-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(folder)
    files, path = _file_system(spark, folder)
    files.deleteOnExit(path)
    return folder, spark.read.schema(df.schema).parquet(folder)


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it from there: every later
    use sees the same rows, reads only the columns it needs and does not depend
    on executors that may be gone. The table goes when the application ends."""
    return _write_scratch(df)[1]


def listed(keys: DataFrame) -> DataFrame:
    """A list of keys to join ticks with, written down first. The planner then
    sees its true size and broadcasts a short list; taken straight from an
    aggregate it would shuffle all ticks by a few, uneven keys."""
    return staged(keys)


@contextmanager
def scratch(df: DataFrame) -> Iterator[DataFrame]:
    """Like ``staged`` within a job that runs to its end here: the table goes
    with the block."""
    folder, rows = _write_scratch(df)
    try:
        yield rows
    finally:
        delete_folder(df.sparkSession, folder)
