"""Session settings and lineage cuts shared by every job."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_spark(app_name: str = "replyscope", **conf) -> SparkSession:
    """Session for scripts and tests; on a cluster spark-submit settings win."""
    builder = SparkSession.builder.appName(app_name).config("spark.sql.session.timeZone", "UTC")
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. A temporary folder is used only where
    none is configured and Spark runs in one local process (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="replyscope-")
    context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def spread_by(df: DataFrame, *columns: str) -> DataFrame:
    """Placement by key over all shuffle partitions. Used before rows are
    unrolled into many: a count chosen from the size before would be too small."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


_scopes: list[list[str]] = []


def cut_lineage(df: DataFrame, name: str = "cut") -> DataFrame:
    """Materialise a reused intermediate as a table in the shared folder, so that
    a lost executor costs a file read and not the whole history of the plan.
    Parquet keeps column pruning and size statistics for the joins that follow.
    Inside `temporary_tables` or `own_scratch` the table is deleted at the end."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    if _scopes:
        _scopes[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end the tables that `cut_lineage` wrote inside: for callers
    that write a result before they leave."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def own_scratch(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The function with its result written and its other tables deleted. The
    result in turn is a temporary table of the caller, if it has a scope."""

    @functools.wraps(fn)
    def run(*args, **options) -> DataFrame:
        with temporary_tables(SparkSession.active()):
            result = fn(*args, **options)
            inside = _scopes.pop()
            try:
                return cut_lineage(result, fn.__name__)
            finally:
                _scopes.append(inside)

    return run
