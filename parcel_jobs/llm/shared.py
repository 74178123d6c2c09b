"""Helpers that the operators share: the shared folder, written tables, chunks of Arrow batches."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from weakref import WeakKeyDictionary

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, or where it is unset and Spark runs in one process, a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base if "://" in base or base.startswith("file:") else f"file://{base}"


_FOLDER: ContextVar[str | None] = ContextVar("folder", default=None)
_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{_FOLDER.get() or shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch(spark: SparkSession, tag: str) -> Iterator[None]:
    """What operators write while it is open goes when it closes: the result must have been written elsewhere by then."""
    path = new_path(spark, tag)
    token = _FOLDER.set(path)
    try:
        yield
    finally:
        _FOLDER.reset(token)
        _delete(spark, path)


def written(df: DataFrame, tag: str, path: str | None = None) -> DataFrame:
    """The same rows, read back from Parquet in the shared folder: lineage is cut and a lost executor loses nothing."""
    spark = df.sparkSession
    path = path or new_path(spark, tag)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    return out


def forget(*frames: DataFrame) -> None:
    """Delete tables that written() made and that nothing reads any more: all that was made of them is written itself."""
    for df in frames:
        if path := _PATHS.pop(df, None):
            _delete(df.sparkSession, path)


def text_column(batch: pa.RecordBatch, path: str) -> pa.Array:
    """The column that path names, or the field of a struct column."""
    name, _, field = path.partition(".")
    column = batch.column(batch.schema.get_field_index(name))
    return column.field(field) if field else column


def chunks(texts: pa.Array, most_chars: int = 1_000_000) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of runs of rows with a bounded number of characters; null texts come as ''. One longer text is a run alone."""
    start, run, size = 0, [], 0
    for i, t in enumerate(texts):
        t = t.as_py() or ""
        if run and size + len(t) > most_chars:
            yield start, run
            start, run, size = i, [], 0
        run.append(t)
        size += len(t)
    if run:
        yield start, run


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once: a lambda variable holds it, so that lambdas inside don't compute it again."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
