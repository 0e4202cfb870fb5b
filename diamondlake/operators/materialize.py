"""Cut a lineage in the shared checkpoint folder, so a lost executor loses no work."""

from __future__ import annotations

import gc
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Folders written in the open scopes of a thread, the innermost last.
_open = threading.local()


def _scopes() -> list[list[str]]:
    if not hasattr(_open, "scopes"):
        _open.scopes = []
    return _open.scopes


def _new_table(spark: SparkSession) -> str:
    path = f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"
    if _scopes():
        _scopes()[-1].append(path)
    return path


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where nothing is named, a folder below the warehouse, which driver and
    executors share as well.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        context.setCheckpointDir(folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints")
    return context.getCheckpointDir()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it lies; one that is not there is no error."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder in the place of another."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(source)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    remove(spark, target)
    if not files.rename(place, jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"cannot move {source} to {target}")


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once and read it back wherever it is used again.

    Columnar files rather than a checkpointed plan: each later use reads only the
    columns it needs, and the planner knows the size of what it reads. Inside
    ``tables`` the files go when the scope ends.
    """
    spark = df.sparkSession
    path = _new_table(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def tables(spark: SparkSession) -> Iterator[None]:
    """Tables that ``materialize`` writes inside are deleted at the end: all that reads them must have run by then."""
    scopes = _scopes()
    scopes.append([])
    try:
        yield
    finally:
        for path in scopes.pop():
            remove(spark, path)
        # Shuffle files go when the driver's memory of their plans is collected.
        gc.collect()
        spark._jvm.System.gc()


def settled(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """``make()`` as a written table, without the tables that it needed on its way."""
    path = _new_table(spark)
    with tables(spark):
        df = make()
        schema = df.schema
        df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)
