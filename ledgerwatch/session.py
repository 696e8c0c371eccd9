"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", app: str = "ledgerwatch", **conf) -> SparkSession:
    """A local session for tests and the bench. On a cluster use the session you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        # the rules make more generated classes than the default of 100 keeps
        .config("spark.sql.codegen.cache.maxEntries", "2000")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder for written intermediate tables: the one `spark.checkpoint.dir` names.

    Only a local master may go without the setting; it then gets a new temporary
    folder. On a cluster such a folder would exist on one machine only.
    """
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if root:
        return root
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="ledgerwatch-")
    context.setCheckpointDir(root)
    return root


DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_settled: list[str] = []  # folders written by this process, for `dropping_settled`


@contextmanager
def dropping_settled(spark: SparkSession):
    """Drops, at the end of the block, what was settled in it. Results must be stored by then."""
    before = len(_settled)
    try:
        yield
    finally:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        while len(_settled) > before:
            path = jvm.org.apache.hadoop.fs.Path(_settled.pop())
            path.getFileSystem(conf).delete(path, True)


def drop_settled(df: DataFrame) -> None:
    """Drops the folder of one settled table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {os.path.dirname(file) for file in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession, size: int = 4 << 20):
    """Jobs in the block hand rows to Python so many bytes at a time: batches of long rows stand in memory twice."""
    before = spark.conf.get(ARROW_BYTES)
    spark.conf.set(ARROW_BYTES, str(size))
    try:
        yield
    finally:
        spark.conf.set(ARROW_BYTES, before)


def ship_package(spark: SparkSession) -> None:
    """Let every executor import this package, wherever the driver has it from.

    Needed where executors do not have it installed; once for each session.
    """
    context = spark.sparkContext
    if getattr(context, "_ledgerwatch_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="ledgerwatch-")
    context.addPyFile(shutil.make_archive(f"{folder}/ledgerwatch", "zip", os.path.dirname(root), "ledgerwatch"))
    context._ledgerwatch_shipped = True


def settle(df: DataFrame, *metrics: Column) -> tuple[DataFrame, dict]:
    """Write a frame to the scratch folder, read it back, and return the metrics of the write.

    Cuts the lineage at a table that outlives lost executors. The metrics come
    from the writing job itself, so sizing the table costs no second pass. What the
    job shuffled goes when it ends, and not only when the driver collects garbage:
    nothing reads it again once the table is there.
    """
    spark = df.sparkSession
    path = os.path.join(scratch_root(spark), f"table-{uuid.uuid4().hex}")
    seen, before = Observation(), spark.conf.get(DROP_SHUFFLES)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.observe(seen, F.count(F.lit(1)).alias("rows"), *metrics).write.parquet(path)
    finally:
        spark.conf.set(DROP_SHUFFLES, before)
    _settled.append(path)
    return spark.read.schema(df.schema).parquet(path), seen.get
