"""Committed snapshots: rows as Parquet, and a manifest that says READY or BLOCKED, made of what the tasks report when they commit.

A folder is written once. Tasks write files of their own and report rows, bytes and SHA-256; the driver's commit names those
files in the manifest, so what a lost or repeated task left behind is never read. A failed write leaves no data, and BLOCKED.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..operators.gates import GateClosed
from .ranges import opened

READY, BLOCKED = "READY", "BLOCKED"


@dataclass
class Part(WriterCommitMessage):
    name: str
    rows: int
    bytes: int
    sha256: str


def digest(store, path: str) -> tuple[int, str]:
    """Bytes and SHA-256 of a file, read in chunks."""
    seen, size = hashlib.sha256(), 0
    with store.open_input_stream(path) as f:
        while chunk := f.read(8 << 20):
            seen.update(chunk)
            size += len(chunk)
    return size, seen.hexdigest()


class SnapshotWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.manifest = options["path"], json.loads(options["manifest"])
        self.rows = int(options["rows"]) if "rows" in options else None

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        """What the task wrote; of a partition without rows a part without a file, since Spark takes no other answer than a message."""
        import pyarrow.parquet as pq
        from pyspark import TaskContext

        store, path = opened(self.path)
        name, out, rows = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}.parquet", None, 0
        for batch in iterator:
            if out is None:
                store.create_dir(f"{path}/data", recursive=True)
                out = pq.ParquetWriter(f"{path}/data/{name}", batch.schema, filesystem=store)
            out.write_batch(batch)
            rows += batch.num_rows
        if out is None:
            return Part("", 0, 0, "")
        out.close()
        return Part(name, rows, *digest(store, f"{path}/data/{name}"))

    def _say(self, **fields: object) -> None:
        store, path = opened(self.path)
        store.create_dir(path, recursive=True)
        with store.open_output_stream(f"{path}/manifest.json") as f:
            f.write(json.dumps(self.manifest | fields).encode())

    def commit(self, messages: list[Part | None]) -> None:
        parts = sorted((asdict(m) for m in messages if m and m.name), key=lambda p: p["name"])
        rows = sum(p["rows"] for p in parts)
        if self.rows is not None and rows != self.rows:
            self._block(f"{rows} rows, not {self.rows}")
            raise GateClosed(f"{self.path}: {rows} rows, not {self.rows}")
        self._say(state=READY, rows=rows, files=parts)

    def abort(self, messages: list[Part | None]) -> None:
        self._block("the write failed")

    def _block(self, reason: str) -> None:
        _clear(self.path)
        self._say(state=BLOCKED, reasons=[reason])


def _clear(uri: str) -> bool:
    """Delete the data of a snapshot; whether there was any."""
    from pyarrow import fs

    store, path = opened(uri)
    if store.get_file_info(f"{path}/data").type == fs.FileType.NotFound:
        return False
    store.delete_dir(f"{path}/data")
    return True


class Snapshots(DataSource):
    @classmethod
    def name(cls) -> str:
        return "parcel_snapshot"

    def writer(self, schema, overwrite: bool) -> SnapshotWriter:
        return SnapshotWriter(self.options)


def write_snapshot(df: DataFrame, path: str, manifest: dict, rows: int | None = None) -> None:
    """Write df once under path: files in data, and manifest.json with the given fields, state, rows and files.

    GateClosed if the path exists already, or has another number of rows than expected, if that is given. If the write fails the state is
    BLOCKED, with reasons, no data is left, and the failure is raised.
    """
    from pyarrow import fs

    path = path if ":" in path.split("/")[0] else f"file://{path}"
    store, where = opened(path)
    if store.get_file_info(where).type != fs.FileType.NotFound:
        raise GateClosed(f"{path} exists already")
    df.sparkSession.dataSource.register(Snapshots)
    options = {"path": path, "manifest": json.dumps(manifest)} | ({} if rows is None else {"rows": str(rows)})
    try:
        df.write.format(Snapshots.name()).options(**options).mode("append").save()
    except Exception:
        for _ in range(20):  # tasks that are being stopped may still write: their files go too, and no manifest names them
            time.sleep(0.25)
            if not _clear(path):
                break
        raise


def read_snapshot(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    """(rows, manifest) of a snapshot that is READY: the files that its manifest names, GateClosed if one of them isn't as it was written."""
    path = path if ":" in path.split("/")[0] else f"file://{path}"
    store, where = opened(path)
    with store.open_input_stream(f"{where}/manifest.json") as f:
        manifest = json.loads(f.read())
    if manifest.get("state") != READY:
        raise GateClosed(f"{path} is {manifest.get('state')}: {manifest.get('reasons')}")
    names = [(p["name"], p["sha256"]) for p in manifest["files"]]
    if not names:
        raise GateClosed(f"{path} has no rows")

    def changed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, base = opened(path)
        for batch in batches:
            bad = [r["name"] for r in batch.to_pylist() if digest(own, f"{base}/data/{r['name']}")[1] != r["sha256"]]
            yield pa.RecordBatch.from_pydict({"name": pa.array(bad, pa.string())})

    listed = spark.createDataFrame(names, "name string, sha256 string").repartition(min(len(names), 1000))
    if bad := listed.mapInArrow(changed, "name string").limit(20).collect():
        raise GateClosed(f"{path}: changed since written: {[r.name for r in bad]}")
    return spark.read.parquet(*[f"{path}/data/{n}" for n, _ in names]), manifest


def source_digests(spark: SparkSession, path: str) -> DataFrame:
    """path, bytes and sha256 of each file, of any size: a file is read in chunks, by one task."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column(0).to_pylist()
            found = [digest(*opened(p)) for p in paths]
            yield pa.RecordBatch.from_pydict({"path": pa.array(paths, pa.string()), "bytes": pa.array([n for n, _ in found], pa.int64()), "sha256": pa.array([h for _, h in found], pa.string())})

    files = spark.read.format("binaryFile").load(path).select(F.col("path"))
    return files.repartition(spark.sparkContext.defaultParallelism * 4).mapInArrow(hashed, "path string, bytes long, sha256 string")
