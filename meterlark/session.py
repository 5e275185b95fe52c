"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "meterlark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; pass further settings as keywords with `__` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by `spark.checkpoint.dir`.

    A local session without that setting gets a temporary folder. A cluster session
    without it is an error: a machine-local path would lose data with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="meterlark-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder. Folders of a `scratch` block go with the block."""
    path = f"{shared_folder(spark)}/meterlark-{label}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


_SCOPES: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Remove the folders that the library writes inside the block when it ends; yields their list.

    Results that read those folders must be written elsewhere before the block ends.
    """
    _SCOPES.append([])
    try:
        yield _SCOPES[-1]
    finally:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for made in _SCOPES.pop():
            path = jvm.org.apache.hadoop.fs.Path(made)
            path.getFileSystem(conf).delete(path, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Later steps then see one fixed set of rows, also after an executor is lost, and
    still get column pruning and filter pushdown from the Parquet scan.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
