"""Frames written to the folder that driver and executors share, so that lineage is cut and lost executors cost nothing."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.

    Where it is unset (tests on one machine) a temporary folder is made and set; on anything but a
    local master that would lose data, so it is an error there.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spanweave-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses; it is deleted by discard() or at the end of the process."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    hold(spark, path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back.

    The files live until discard() or the end of the Python process.
    """
    path = new_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.stored_at = path
    return back


def hold(spark: SparkSession, path: str) -> None:
    """Delete a folder when the Python process ends, if discard() has not done so before."""
    if not _written:
        atexit.register(_clean)
    _written[path] = spark


def discard(*what: DataFrame | str) -> None:
    """Delete folders, or the files of materialized frames, that nothing will read again."""
    for x in what:
        path = x if isinstance(x, str) else x.stored_at
        spark = _written.pop(path, None)
        if spark:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _clean() -> None:
    for path in list(_written):
        try:
            discard(path)
        except Exception:  # the session has ended; its owner clears the checkpoint folder
            return
