"""Session settings, shared scratch space and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str, cores: str | int = "*", memory: str = "8g") -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8" if cores == "*" else str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local session without the setting (unit tests) gets a temporary folder;
    on a cluster its absence is an error, because a machine-local folder would
    be lost together with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named is None and context.getCheckpointDir() is not None:
        named = context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemill-"))
        named = context.getCheckpointDir()
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/tidemill/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the frame to the shared folder once and read it back.

    Later steps start from the files: a lost executor does not restart a loop,
    an expensive input is not computed again for each use, and Spark knows the
    real size when it picks a join.
    """
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parallelism(spark: SparkSession) -> int:
    """How many ranges a global order is cut into: the shuffle width, or all cores if there are more."""
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
