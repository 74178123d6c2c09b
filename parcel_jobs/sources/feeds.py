"""Readers and writers of feeds: fixed headers, strict rows, write-once snapshots."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import SALES, md5_shard, sha_shard
from ..operators.gates import GateClosed
from .ranges import opened, read_ranges
from .snapshot import read_snapshot, source_digests, write_snapshot  # noqa: F401 - part of the readers and writers here

#: Windows-1252 at 0x80 to 0x9F; the five codes that it leaves open stay as they are.
CP1252 = "€\x81‚ƒ„…†‡ˆ‰Š‹Œ\x8dŽ\x8f\x90‘’“”•–—˜™š›œ\x9džŸ"


def read_strict_csv(spark: SparkSession, path: str, header: Sequence[str], sep: str = ",", range_bytes: int = 32 << 20) -> DataFrame:
    """All-text rows under an exact header, quoted line breaks allowed, with error: width, nul or quote. Blank is '', not null.

    Files are split into ranges of bytes, each a task, wherever quotes stand. Another header or bytes that aren't UTF-8 fail the job.
    """
    return read_ranges(spark, path, header, sep, range_bytes)


def read_sales_feed(spark: SparkSession, path: str) -> DataFrame:
    """The sales feed: 15 columns."""
    return read_strict_csv(spark, path, [c.upper() for c in SALES])


def read_delimited_feed(spark: SparkSession, path: str, header: Sequence[str]) -> DataFrame:
    """read_strict_csv with the separator (comma, tab, bar or semicolon) that splits the first line into the header."""
    first = spark.read.text(path).limit(1).collect()
    line = first[0][0].lstrip("﻿").rstrip("\r") if first else ""
    for sep in (",", "\t", "|", ";"):
        if [x.strip('"') for x in line.split(sep)] == list(header):
            return read_strict_csv(spark, path, header, sep)
    raise GateClosed(f"header drift: {line[:200]}")


def read_property_feed(spark: SparkSession, feed: str, path: str, headers: dict[str, Sequence[str]]) -> DataFrame:
    """The parcel or owner feed under its header."""
    return read_strict_csv(spark, path, headers[feed])


def decode_cp1252(latin1: Column) -> Column:
    """Text that was read as ISO-8859-1, as Windows-1252."""
    return F.translate(latin1, "".join(map(chr, range(0x80, 0xA0))), CP1252)


def land_zip_feed(spark: SparkSession, path: str, encoding: str = "utf-8-sig") -> DataFrame:
    """Lines (file, line_no, value) of ZIP archives that must hold one data member each, decoded strictly.

    An archive is one task, which seeks its directory and inflates the member in blocks: memory doesn't grow with either, and both may be of any
    size. Another number of members, a wrong checksum, or bytes that can't be decoded fail the job.
    """

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(name: str, n: int, held: list[str]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"file": pa.array([name] * len(held), pa.string()), "line_no": pa.array(range(n, n + len(held)), pa.int64()), "value": pa.array(held, pa.string())})

        for name in (x for batch in batches for x in batch.column(0).to_pylist()):
            store, where = opened(name)
            with store.open_input_file(where) as source, zipfile.ZipFile(source) as archive:
                members = [m for m in archive.infolist() if not m.is_dir()]
                if len(members) != 1:
                    raise GateClosed(f"{name} holds {len(members)} members")
                with archive.open(members[0]) as raw, io.TextIOWrapper(raw, encoding=encoding, errors="strict", newline="\n") as text:
                    held, n, size = [], 0, 0
                    for line in text:
                        held.append(line.rstrip("\r\n"))
                        size += len(line)
                        if size > 4_000_000:
                            yield batch_of(name, n, held)
                            n, held, size = n + len(held), [], 0
                    if held:
                        yield batch_of(name, n, held)

    files = spark.read.format("binaryFile").load(path).select("path")
    return files.repartition(spark.sparkContext.defaultParallelism * 4).mapInArrow(lines, "file string, line_no long, value string")


def read_json_snapshot(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """JSON documents, one or several lines each, under a declared schema."""
    return spark.read.schema(schema).json(path, multiLine=True)


def require_digests(found: DataFrame, accepted: DataFrame, key: str) -> DataFrame:
    """found (key, sha256), or GateClosed if a file is not the accepted one of its key, is missing or is one too many."""
    both = found.select(key, F.col("sha256").alias("is")).join(accepted.select(key, F.col("sha256").alias("should")), key, "full_outer")
    if bad := both.where(~F.col("is").eqNullSafe(F.col("should"))).limit(20).collect():
        raise GateClosed(f"not the accepted files: {[r.asDict() for r in bad]}")
    return found


def require_source(spark: SparkSession, path: str, sha256: str, rows: int | None = None, lines: DataFrame | None = None) -> None:
    """GateClosed unless the file has this SHA-256 and, if lines are given, so many rows."""
    found = source_digests(spark, path).limit(2).collect()
    if [r["sha256"] for r in found] != [sha256]:
        raise GateClosed(f"{path} is not the accepted file")
    if rows is not None and lines is not None and (n := lines.count()) != rows:
        raise GateClosed(f"{path} has {n} rows, not {rows}")


def write_shards(df: DataFrame, key: str, n: int, path: str, digest: str = "sha") -> None:
    """CSV files by hash shard of the key, which no prefix of the key can skew."""
    shard = sha_shard(F.col(key), n) if digest == "sha" else md5_shard(F.col(key), n)
    df.withColumn("shard", shard).repartition(n, "shard").write.mode("errorifexists").partitionBy("shard").option("header", True).csv(path)
