"""Where intermediate tables may be written."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can read, as named in ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder; a cluster
    without it is an error, as a machine-local folder would lose data there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="tabloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_OPEN: dict[str, str] = {}      # by application: the folder of the phase that is under way
_CLOSED: dict[str, list[str]] = {}  # folders of phases that are over


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, removed when the session's JVM ends, or after the
    phase that is under way (see ``phase``)."""
    run, folder, files = _run_folder(spark)
    if not files.exists(folder):
        files.mkdirs(folder)
        files.deleteOnExit(folder)
    own = _OPEN.get(spark.sparkContext.applicationId, "")
    return f"{run}/{own}{name}-{uuid.uuid4().hex}"


def _run_folder(spark: SparkSession):
    run = f"{shared_folder(spark).rstrip('/')}/tabloom-{spark.sparkContext.applicationId}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(run)
    return run, folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


@contextmanager
def phase(spark: SparkSession, name: str) -> Iterator[None]:
    """Scratch tables written inside belong to this phase; those of phases that are over go now.

    For work in phases whose results are written out one after the other: what a phase
    gave must be written before the next one begins.
    """
    application = spark.sparkContext.applicationId
    run, _, files = _run_folder(spark)
    while _CLOSED.get(application):
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(
            f"{run}/{_CLOSED[application].pop()}"), True)
    release_shuffles(spark)
    _OPEN[application] = f"phase-{name}-{uuid.uuid4().hex}/"
    try:
        yield
    finally:
        _CLOSED.setdefault(application, []).append(_OPEN.pop(application))


def release_shuffles(spark: SparkSession) -> None:
    """Have Spark remove the shuffle files of plans that nobody holds any more."""
    gc.collect()
    spark._jvm.System.gc()


def stage(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back from there.

    Later readings prune columns, see the same rows each time and run nothing that
    came before.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
