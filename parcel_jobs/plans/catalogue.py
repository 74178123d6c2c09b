"""Registry of queries, each with the SQL that gives the same rows."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bindings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Given tables and bindings by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __call__(self, name: str) -> DataFrame:
        return bindings.table(self.spark, self.sf_dir, name)

    def stored(self, tag: str, df: DataFrame) -> DataFrame:
        """The same rows as a table in the shared folder, for what is read more than once."""
        path = self.folder(tag)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def folder(self, tag: str) -> str:
        """A new path in the folder of spark.checkpoint.dir; where that is unset and Spark runs in one process, in a temporary one."""
        base = self.spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not re.match(r"local(\[|$)", self.spark.sparkContext.master):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            base = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
            self.spark.conf.set("spark.checkpoint.dir", base)
        return f"{base if ':' in base else 'file://' + base}/{tag}-{uuid.uuid4().hex}"

    def sql(self, text: str, **frames: DataFrame) -> DataFrame:
        """A projection of frames, by name, in SQL."""
        return self.spark.sql(text, **frames)


def query(name: str, sql: str | None = None) -> Callable:
    """Register a function of Tables. sql goes on behind the bindings; it begins with select, or with a comma and more of them."""

    def register(f: Callable[[Tables], DataFrame]) -> Callable:
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            body = sql.strip()
            ORACLES[name] = f"with {bindings.ctes()}{body if body.startswith(',') else ' ' + body}"
        return f

    return register
