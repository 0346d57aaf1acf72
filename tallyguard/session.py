"""Session settings and the shared scratch folder used by the jobs, the tests and the bench."""

from __future__ import annotations

import contextlib
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def run_until_stopped(spark: SparkSession, *queries: StreamingQuery) -> None:
    """Wait for streams until one ends or the user interrupts, then end the session.

    An interrupt stops every stream at the end of its micro-batch; a stream that failed raises here.
    """
    with contextlib.closing(_Closing(spark, queries)), contextlib.suppress(KeyboardInterrupt):
        spark.streams.awaitAnyTermination()


class _Closing:
    def __init__(self, spark: SparkSession, queries: tuple[StreamingQuery, ...]):
        self.spark, self.queries = spark, queries

    def close(self) -> None:
        for query in self.queries:
            if query.isActive:
                query.stop()
        self.spark.stop()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the checkpoint folder that the session names.

    On a cluster ``spark.checkpoint.dir`` is storage every executor sees. Only where it is unset, as in
    a local test session, a temporary folder takes its place.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="run-")
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/tallyguard/{uuid.uuid4().hex}/{name}"


def checkpoint_folder(spark: SparkSession) -> None:
    """Name the folder of written RDDs, beside the stages, where none is named."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_path(spark, "checkpoints"))


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once a session, for functions that run there."""
    context = spark.sparkContext
    if getattr(context, "_tallyguard_shipped", False):
        return
    root, folder = Path(__file__).resolve().parent, tempfile.mkdtemp(prefix="package-")
    copy = Path(folder, "copy", root.name)
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns("__pycache__"))
    context.addPyFile(shutil.make_archive(str(Path(folder, "tallyguard_workers")), "zip", copy.parent, root.name))
    context._tallyguard_shipped = True


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table once and read it back.

    Used where several passes follow one expensive step. Later passes read only the columns they need,
    and a lost executor costs no recomputation of the step.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
