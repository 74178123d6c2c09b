"""Token-ID / binary output: flat files of unsigned integers with 64-bit document offsets.

A set of files lies in one folder. Each part holds documents of one range of ids, in ascending order:

- ``<part>.bin``  ids of all its documents, little-endian, two bytes each if the vocabulary allows, else four
- ``<part>.docs`` Arrow file with doc_id and n_tokens
- ``<part>-*.idx`` n_docs + 1 offsets, little-endian unsigned 64-bit: ids before each document in the whole set

A part's base is the prefix sum of the sizes of the parts before it. Parts are named by task attempt and only those in
the manifest count, so tasks may fail or run twice. Readers map ``.bin`` and ``.idx`` into memory where the folder is a
mounted one and read them otherwise.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import new_path, written
from .wordcache import runs_of, word_bpe

PART = "part int, name string, width int, n_docs long, n_tokens long"


def _open(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def _mapped(folder: str, name: str, dtype: str) -> np.ndarray:
    from pyarrow import fs

    store, path = _open(folder)
    if isinstance(store, fs.LocalFileSystem):
        source = pa.memory_map(f"{path}/{name}")
    else:
        source = store.open_input_file(f"{path}/{name}")
    return np.frombuffer(source.read_buffer() if hasattr(source, "read_buffer") else source.read(), dtype)


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None) -> tuple[str, DataFrame]:
    """Encode docs (doc_id, text) and write them as token files; return (folder, index).

    Documents are dealt by ranges of doc_id, so every file is in ascending order; null ids come first, rows of equal ids
    by a hash of their text. doc_id may be of any type that sorts. Null text is empty: it holds the end id alone.
    Repeated rows are written each. Other columns are ignored. An empty table makes no files.
    The index has a row for each part: part, name, width, n_docs, n_tokens, base, idx (file of offsets).
    """
    spark = docs.sparkSession
    folder = folder or new_path(spark, "tokens")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bpe, part = word_bpe(tokenizer), TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex[:12]}"
        store, path = _open(folder)
        out, ids, sizes = None, [], []
        for batch in batches:
            if out is None and batch.num_rows:
                store.create_dir(path, recursive=True)
                out = store.open_output_stream(f"{path}/{name}.bin")
            ids.append(batch.column(0))
            for _, texts in runs_of(batch.column(1)):
                coded, at = bpe.encode(texts)
                out.write(np.insert(coded, at[1:], end_id).tobytes())
                sizes.append(np.diff(at) + 1)
        if out is None:
            return
        out.close()
        n_tokens = np.concatenate([np.zeros(0, np.int64), *sizes]).astype(np.int64)
        table = pa.table({"doc_id": pa.chunked_array(ids), "n_tokens": pa.array(n_tokens)})
        with store.open_output_stream(f"{path}/{name}.docs") as f, pa.ipc.new_file(f, table.schema) as w:
            w.write_table(table)
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "name": [name], "width": pa.array([bpe.dtype.itemsize], pa.int32()), "n_docs": [len(n_tokens)], "n_tokens": [int(n_tokens.sum())]})

    order = ("doc_id", "turn", "row")  # rows of one doc_id, however many, are dealt to several parts
    dealt = docs.select("doc_id", "text", F.xxhash64("text").alias("turn"), F.monotonically_increasing_id().alias("row"))
    dealt = dealt.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    manifest = written(dealt.mapInArrow(encode, PART), "token-parts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over parts, not documents
    based = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")))

    def offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _open(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{path}/{row['name']}.docs") as f:
                    sizes = pa.ipc.open_file(f).read_all()["n_tokens"].to_numpy()
                at = np.concatenate([[row["base"]], row["base"] + np.cumsum(sizes)]).astype("<u8")
                row["idx"] = f"{row['name']}-{uuid.uuid4().hex[:12]}.idx"
                with store.open_output_stream(f"{path}/{row['idx']}") as f:
                    f.write(at.tobytes())
                yield pa.RecordBatch.from_pylist([row], schema=pa.schema([*batch.schema, ("idx", pa.string())]))

    index = _one_each(based).mapInArrow(offsets, PART + ", base long, idx string")
    return folder, written(index, "token-index")


def _one_each(parts: DataFrame) -> DataFrame:
    """Parts dealt to about as many tasks as there are parts, for each is a file to work on."""
    return parts.repartition(parts.sparkSession.sparkContext.defaultParallelism * 4, "part")


def read_token_files(folder: str, index: DataFrame, with_ids: bool = False, id_type: str = "long") -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit) of each document, and its ids if asked for.

    id_type is the type of doc_id that was written. An index without rows gives none.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _open(folder)
        for batch in batches:
            for row in batch.to_pylist():
                at = _mapped(folder, row["idx"], "<u8")
                ids = _mapped(folder, f"{row['name']}.bin", f"<u{row['width']}")
                with store.open_input_file(f"{path}/{row['name']}.docs") as f:
                    docs = pa.ipc.open_file(f).read_all()["doc_id"].combine_chunks()
                base, i = int(at[0]), 0
                while i < len(docs):  # as many documents as hold some million ids, one at least
                    stop = max(i + 1, int(np.searchsorted(at, at[i] + np.uint64(4_000_000), side="right")) - 1)
                    stop = min(stop, i + 4096, len(docs))
                    ends = (at[i : stop + 1].astype(np.int64) - base).tolist()
                    wide = ids[ends[0] : ends[-1]].astype("<u4")
                    cut = [wide[a - ends[0] : b - ends[0]] for a, b in zip(ends, ends[1:], strict=False)]
                    out = {
                        "doc_id": docs.slice(i, stop - i),
                        "start": pa.array([base + a for a in ends[:-1]], pa.int64()),
                        "n_tokens": pa.array([len(x) for x in cut], pa.int64()),
                        "ids_crc32": pa.array([zlib.crc32(x) for x in cut], pa.int64()),
                    }
                    if with_ids:
                        out["ids"] = pa.array([x.astype(np.int32) for x in cut], pa.list_(pa.int32()))
                    yield pa.RecordBatch.from_pydict(out)
                    i = stop

    kept = f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    return _one_each(index).mapInArrow(read, kept)


def token_file_digests(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write docs as token files and read every document back from them."""
    return read_token_files(*write_token_files(docs, tokenizer, end_id), id_type=docs.schema["doc_id"].dataType.simpleString())
