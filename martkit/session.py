"""Session settings, the shared scratch folder and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

# Settings that results depend on; applied to whatever session runs a job.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # a map task that is run again after a loss and gives other output makes its
    # readers start again too, rather than mix the two
    "spark.sql.shuffle.orderIndependentChecksum.enabled": "true",
    "spark.sql.shuffle.orderIndependentChecksum.enableFullRetryOnMismatch": "true",
}

# Settings that only speed or layout depend on, plus the identifier quoting
# that the roll-up SQL texts use.
BUILD_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.compression.codec": "snappy",
    # INT96, the default, carries no min/max statistics, so no pruning on time
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.ansi.doubleQuotedIdentifiers": "true",
}


# Shuffle partitions: no fewer than Spark's default, and an error rather than partitions
# beyond a task's memory where the driver's bookkeeping would not bear as many as it
# takes; adaptive execution merges those that turn out small.
PARTITION_BYTES = 256 << 20
PARTITIONS = (200, 1_000_000)


def sizing(shuffle_bytes: int) -> dict[str, str]:
    """Settings for a job whose widest shuffle moves about ``shuffle_bytes``."""
    low, high = PARTITIONS
    wanted = -(-shuffle_bytes // PARTITION_BYTES)
    if wanted > high:
        raise ValueError(f"{shuffle_bytes} bytes take {wanted} partitions; split the job")
    return {"spark.sql.shuffle.partitions": str(max(wanted, low))}


# Whether Spark deletes the shuffle files of a query as soon as it has ended; otherwise
# they stay until the driver happens to collect its garbage.
REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(
    app: str = "martkit",
    master: str | None = None,
    conf: dict[str, str] | None = None,
    shuffle_bytes: int | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    sized = sizing(shuffle_bytes) if shuffle_bytes is not None else {}
    for key, value in {**BUILD_CONF, **RUNTIME_CONF, **sized, **(conf or {})}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings that results depend on in an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def require_utc(spark: SparkSession) -> None:
    """Zone conversions are only right when the session itself is in UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "GMT", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, not {zone}")


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor can read and write.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a local
    session may go without: there, and only there, a temporary folder is made.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    folder = spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="martkit-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def remove_scratch(spark: SparkSession) -> None:
    """Delete what this application stored in the shared folder.

    For the end of a job: frames that read a stored table are of no use afterwards.
    """
    path = f"{shared_dir(spark)}/martkit/{spark.sparkContext.applicationId}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with its whole content, unless there is one; tells if it did.

    The content is written beside it under a hidden name and moved into place by a rename
    that does not replace, which file systems such as HDFS do atomically.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    target = hadoop.Path(path)
    hidden = hadoop.Path(target.getParent(), f"_{uuid.uuid4().hex}")
    files = hadoop.FileContext.getFileContext(hidden.getFileSystem(conf).getUri(), conf)
    stream = hidden.getFileSystem(conf).create(hidden, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    replace = getattr(hadoop, "Options$Rename")
    never = spark.sparkContext._gateway.new_array(replace, 0)
    try:
        files.rename(files.makeQualified(hidden), files.makeQualified(target), never)
    except Py4JJavaError as refused:
        hidden.getFileSystem(conf).delete(hidden, False)
        if "FileAlreadyExistsException" in str(refused.java_exception):
            return False
        raise
    return True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, grouped by application for clean-up."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/martkit/{app}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage so that a lost executor cannot re-run what came before
    (calls to an outside service, say), and lets several actions share the work.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(stored: DataFrame) -> None:
    """Delete what ``materialize`` stored; frames that read it are of no use afterwards."""
    spark = stored.sparkSession
    files = stored.inputFiles()
    if not files:
        return
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
    if f"/martkit/{spark.sparkContext.applicationId}/" not in folder.toString():
        raise ValueError(f"not a stored intermediate table: {folder.toString()}")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside leave no shuffle files behind.

    For jobs that store what they go on with. A frame made inside should be run once, as
    a second run makes its shuffles anew.
    """
    before = spark.conf.get(REMOVE_SHUFFLES, None)
    spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(REMOVE_SHUFFLES)
        else:
            spark.conf.set(REMOVE_SHUFFLES, before)
