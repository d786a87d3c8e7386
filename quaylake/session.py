"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Only what the results depend on. Parallelism, memory and shuffle sizes belong
# to the cluster that runs the job.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A repeated key in a JSON object keeps its last value instead of failing the parse.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

CHECKPOINT_SETTING = "spark.checkpoint.dir"

# Largest build side that is broadcast after measuring it.
BROADCAST_BYTES = 64 * 1024 * 1024


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("quaylake")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        # Tracing every column expression to its line of Python takes longer than small queries.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names for checkpoints, by setting or by
    `setCheckpointDir`.

    Only a local session without either gets a folder of its own.
    """
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    context = spark.sparkContext
    if not root and context.getCheckpointDir() is not None:
        # Spark makes a folder of its own below the one it was given.
        root = context.getCheckpointDir().rstrip("/").rpartition("/")[0]
        spark.conf.set(CHECKPOINT_SETTING, root)
    if not root:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError(f"{CHECKPOINT_SETTING} must name a shared folder")
        root = tempfile.mkdtemp(prefix="quaylake-")
        spark.conf.set(CHECKPOINT_SETTING, root)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root.rstrip("/")


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path for it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def moved(spark: SparkSession, path: str, to: str) -> bool:
    """Rename a folder; whether it was there. A refused rename is an error."""
    files, place = file_system(spark, path)
    if not files.exists(place):
        return False
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    files.mkdirs(target.getParent())
    if not files.rename(place, target):
        raise OSError(f"{path} could not be renamed to {to}")
    return True


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote, if it is there."""
    files, place = file_system(spark, path)
    files.delete(place, True)


def new_folder(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_root(spark)}/quaylake/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Run `df` once and keep its rows in the shared folder, with the lineage cut."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only when the measured size of `df` is within `limit` bytes.

    Pass a materialized frame: its rows are read once more to add up their size.
    Larger frames come back without a hint and are joined by a shuffle.
    """
    return F.broadcast(df) if fits_broadcast(df, limit) else df


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    row_overhead = 64
    width = F.lit(row_overhead)
    for field in df.schema.fields:
        text = F.col(f"`{field.name}`").cast("string")
        width = width + F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(8)
    size = df.agg(F.sum(width.cast("bigint")).alias("bytes")).first()["bytes"]
    return (size or 0) <= limit
