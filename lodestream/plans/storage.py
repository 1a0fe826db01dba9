"""Tables between steps, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

#: Folders that this driver has made and not removed, in order.
_MADE: list[str] = []


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, which driver and executors share. Where that is unset, a session on this
    machine alone (local mode) gets one here; on a cluster no local folder would do."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = f"file://{tempfile.gettempdir()}/lodestream"
    _MADE.append(f"{base.rstrip('/')}/{uuid.uuid4().hex}")
    return _MADE[-1]


def materialize(df: DataFrame) -> DataFrame:
    """Writes df to the shared folder and reads it again: its lineage ends there and a lost executor loses nothing."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_blocks(path: str) -> Iterator[pa.Table]:
    """In a task: the files of a table in the shared folder, one after the other, through any store that pyarrow opens."""
    store, at = fs.FileSystem.from_uri(path)
    for file in sorted(f.path for f in store.get_file_info(fs.FileSelector(at)) if f.path.endswith(".parquet")):
        yield pq.read_table(file, filesystem=store)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of any store that Spark knows; one that isn't there is none to delete."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes, at its end, the folders made inside: for callers that have written their result by then."""
    first = len(_MADE)
    try:
        yield
    finally:
        for path in _MADE[first:]:
            remove(spark, path)
        del _MADE[first:]
