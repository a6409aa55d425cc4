"""Session and lineage helpers shared by every operator."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_staged: list[tuple[SparkSession, str]] = []
#: The setting by which Spark deletes a query's shuffle files when it ends; by default they stay until the driver collects its garbage.
_CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_session(app: str = "quirelake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for; extra keyword settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    return builder.config(map=settings).getOrCreate()


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The parquet table ``name`` under ``root``."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or where it is unset a temporary one.

    A machine-local folder is used only by a session whose master is local, as in tests.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return "file://" + os.path.join(tempfile.gettempdir(), f"quirelake-{os.getuid()}")


def stage(df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """K4: write ``df`` as parquet in the shared folder and read it back.

    Cuts the lineage so that a lost executor costs only the tasks that follow, and lets two
    consumers share one computation. The files go with :func:`release`, else when the session's process ends.
    What the write shuffled is deleted as soon as it is written, as nothing reads it any more.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stage-{uuid.uuid4().hex}"
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    kept = spark.conf.get(_CLEANED, None)
    spark.conf.set(_CLEANED, "true")
    try:
        writer.parquet(path)
    finally:
        spark.conf.unset(_CLEANED) if kept is None else spark.conf.set(_CLEANED, kept)
    if not _staged:
        atexit.register(release_stages)
    _staged.append((spark, path))
    made = spark.read.schema(df.schema).parquet(path)
    made._quirelake_stage = path
    return made


def release(*tables: DataFrame) -> None:
    """Delete the files of staged ``tables`` that nothing reads any more; what comes after them must be staged itself."""
    for df in tables:
        path = getattr(df, "_quirelake_stage", None)
        for entry in [e for e in _staged if e[1] == path]:
            _staged.remove(entry)
            _delete(*entry)


def release_stages() -> None:
    """Delete all that :func:`stage` wrote and that hasn't been released; only for results that are no longer read."""
    while _staged:
        _delete(*_staged.pop())


def _delete(spark: SparkSession, path: str) -> None:
    try:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session has ended: a cluster's own cleaning removes the folder
        if path.startswith("file://"):
            import shutil

            shutil.rmtree(path[7:], ignore_errors=True)
