"""Intermediate tables in a folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


@lru_cache(maxsize=1)
def _own_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="rowan-checkpoints-")


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where the session names none, a folder of the warehouse, which a
    cluster shares as well; a folder of this machine only if all tasks run here."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder and spark.sparkContext.master.partition("[")[0] == "local":
        folder = _own_folder()
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_rowan").rstrip("/")


def _new_path(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/rowan-{uuid.uuid4().hex}"


def _write(frame: DataFrame, path: str) -> DataFrame:
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def written(frame: DataFrame) -> DataFrame:
    """The frame, written to the shared folder and read again: computed once, its lineage ends there.

    The files stay until whoever owns the folder clears it, as a result may be read lazily and late.
    """
    return _write(frame, _new_path(frame.sparkSession))


@contextmanager
def written_for_now(frame: DataFrame) -> Iterator[DataFrame]:
    """As ``written``, for a frame that nothing reads later: its files go at the end."""
    spark = frame.sparkSession
    path = _new_path(spark)
    try:
        yield _write(frame, path)
    finally:
        remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of our own, wherever it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
