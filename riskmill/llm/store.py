"""Where operators keep intermediate tables: the shared folder that the cluster names."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

BATCH_ROWS = 1000


def _path(spark: SparkSession, name: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def shared_folder(spark: SparkSession) -> str:
    """A folder of this session's own inside spark.checkpoint.dir, removed when the session's JVM ends.

    Only a local session without that setting (a test) gets a temporary folder, since a machine-local path
    would be lost with its executor.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir")
        if named is None and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="shared-"))
    files, path = _path(spark, context.getCheckpointDir())
    files.deleteOnExit(path)
    return context.getCheckpointDir()


def small_batches(spark: SparkSession) -> None:
    """Texts reach Python by at most `BATCH_ROWS` rows, so that neither the JVM nor a worker holds a whole split of them."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def stored(df: DataFrame) -> DataFrame:
    """The rows, computed once and kept in the shared folder, so that a lost executor costs nothing
    of what led to them."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def remove(spark: SparkSession, name: str) -> None:
    """Deletes a folder."""
    files, path = _path(spark, name)
    files.delete(path, True)


def release(df: DataFrame) -> None:
    """Deletes what `stored` kept, once nothing will read it any more."""
    file = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
    if file.isDefined():
        remove(df.sparkSession, file.get())
