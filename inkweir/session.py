"""Session helpers: table access and cutting lineage through shared storage."""

from __future__ import annotations

import atexit
import contextlib
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A session for tests and benches on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("inkweir")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for checkpoints: ``spark.checkpoint.dir`` of the session. Only a local master may do
    without it and then gets a temporary folder, removed in the end; on a cluster a missing setting is an
    error, as executors would each write to a folder of their own machine."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        made = tempfile.mkdtemp(prefix="inkweir-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        folder = "file://" + made
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder, as soon as this is called. The copy there
    survives the loss of executors and goes when it is no longer referred to, where
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, *sort: str) -> DataFrame:
    """``df`` written at once as a Parquet table of the shared checkpoint folder and read back: smaller
    than a checkpoint, and of a size that the planner knows. ``sort`` orders each file. The table goes
    with ``drop_stored``, at the latest when the driver ends."""
    spark = df.sparkSession
    folder = scratch(spark)
    (df.sortWithinPartitions(*sort) if sort else df).write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def scratch(spark: SparkSession) -> str:
    """A fresh path below the shared checkpoint folder, deleted with the tables of ``stored``."""
    folder = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    if not _stored:
        atexit.register(drop_stored, spark)
    _stored.append(folder)
    return folder


_stored: list[str] = []


def drop_stored(spark: SparkSession) -> None:
    """Delete the tables that ``stored`` wrote. Frames that still read them can't be used any more."""
    with contextlib.suppress(Exception):  # the session may be gone, and its folder with it
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        while _stored:
            path = jvm.org.apache.hadoop.fs.Path(_stored.pop())
            path.getFileSystem(conf).delete(path, True)
