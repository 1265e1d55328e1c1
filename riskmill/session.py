"""Session defaults and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Java leaves methods above 8000 bytes to its interpreter. With this limit Spark splits the code
# of a wide stage into small methods instead of generating one that never gets compiled.
# With open files for that many parts a task writes a table in parts without sorting all its rows
# first; a sort of wide rows spills several times what is written.
WIDE_STAGE_SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": "8000", "spark.sql.maxConcurrentOutputFileWriters": "8",
}


def tune(spark: SparkSession) -> SparkSession:
    """Settings for wide tables on a session made elsewhere."""
    for name, value in WIDE_STAGE_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def get_session(app_name: str = "riskmill", **conf: str) -> SparkSession:
    """Session with adaptive execution; master, memory and partitions come from the submit."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    return tune(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session.

    ``spark.checkpoint.dir`` names it on a cluster. Only a local session without one gets a
    temporary folder, since a machine-local path would be lost with its executor.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="riskmill-"))
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later passes read the same stored rows, also after a lost executor."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def sized(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back, so that Spark knows how large they are.

    A checkpoint keeps the estimate of the plan behind it, by which the side of a few thousand rows that an
    aggregate leaves counts as large, and a join with it shuffles the other side.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
