"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", app: str = "tidemark", **conf: str) -> SparkSession:
    """A single-machine session for tests and benches; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def tune(spark: SparkSession) -> SparkSession:
    """Planner settings that suit wide rule projections.

    Constraint propagation rewrites every alias of a projection into every other; over some two
    hundred rule expressions that is tens of seconds of planning for nothing the plans use.

    One fused method over that many expressions is larger than the JVM ever compiles (8,000 bytes of bytecode) and
    would run interpreted; Spark then generates a method per expression instead.
    """
    spark.conf.set("spark.sql.constraintPropagation.enabled", "false")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point ``checkpoint()`` at the cluster's shared folder.

    The folder named by ``spark.checkpoint.dir`` always wins. Only a local-mode session that names
    none gets a temporary folder; on a cluster that would not survive an executor, so it is an error.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(shared)
        return
    if context.getCheckpointDir() is not None:
        return
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-checkpoint-"))


@dataclass
class StoredTable:
    """A table written to the shared checkpoint folder; its files go at the session's end or on ``delete``."""

    table: DataFrame
    path: str

    def delete(self) -> None:
        folder = self.table.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(self.table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


#: Whether Spark deletes an execution's shuffle files when it ends, not when the driver happens to collect its plan.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Executions in here leave no shuffle files behind."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def stored_table(df: DataFrame) -> StoredTable:
    """Write ``df`` as Parquet to the shared checkpoint folder and read it back: the lineage ends here.

    Unlike a row checkpoint the files are compressed, are read by column, and give the planner their size. As the write is
    the only reader of its shuffles, their files go with it; else a long run's disk holds those of all its steps at once.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    path = f"{root.rstrip('/')}/tidemark-{uuid.uuid4().hex}"
    with _shuffles_deleted(spark):
        df.write.parquet(path)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return StoredTable(spark.read.schema(df.schema).parquet(path), path)
