"""Token ids as flat binary files with 64-bit document offsets, written and read by Spark tasks."""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.llm.common import arrow_text
from textloom.llm.tokenize import END_ID, encoder
from textloom.session import stored

MANIFEST = "manifest.json"
READ_ROWS = 4096


def _folder(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def _mapped(path: str, dtype) -> np.ndarray:
    """A file as an array: memory-mapped where the file system is local, read in parts elsewhere."""
    fs, inner = _folder(path)
    size = fs.get_file_info(inner).size
    if size == 0:
        return np.zeros(0, dtype)
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(inner, dtype, mode="r")
    with fs.open_input_file(inner) as file:
        return np.frombuffer(file.read_buffer(size), dtype)


def write_token_files(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID, parts: int | None = None
) -> DataFrame:
    """Encode whole texts and write them to ``path`` in ascending ``doc_id`` order.

    ``path`` is a folder that driver and executors share. Each range of ids becomes one part:
    ``tokens-*.bin`` holds the ids of its documents one after the other, each document ended by
    ``end_id``, as little-endian unsigned integers (16 bits if the vocabulary allows, else 32);
    ``offsets-*.bin`` holds the position of each document's first id in the whole corpus as unsigned
    64-bit integers, and one more for the end; ``docs-*.bin`` holds the document ids. ``manifest.json`` names
    type, parts and their bases. A part's base is the prefix sum of the tokens before it.

    A task names its files by a fresh id and hands the name on in its rows, so files of lost or repeated
    tasks are never referred to. The driver sees one row per part. Returns ``doc_id, start, n_tokens``.

    Edge cases: a null text is empty, an empty text is the end id alone; rows that share a ``doc_id``
    are separate documents, in the order of their texts; a null ``doc_id`` sorts first and is stored as
    the smallest long; an empty table gives a manifest without parts; other columns are ignored.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    vocabulary = max(Tokenizer.from_file(tokenizer_path).get_vocab_size(), end_id + 1)
    dtype = "<u2" if vocabulary <= 1 << 16 else "<u4"
    path = path.rstrip("/")
    fs, inner = _folder(path)
    fs.create_dir(inner)

    no_id = int(np.iinfo(np.int64).min)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(no_id)).alias("doc_id"), "text")
    order = [F.col("doc_id"), F.xxhash64("text"), F.col("text")]
    ranges = rows.repartitionByRange(parts, *order[:2]) if parts else rows.repartitionByRange(*order[:2])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, place, begin = None, uuid.uuid4().hex, 0, 0
        part = TaskContext.get().partitionId()
        fs, inner = _folder(path)
        encode = encoder(tokenizer_path).encode
        for batch in batches:
            if out is None:
                out = fs.open_output_stream(f"{inner}/tokens-{name}.bin")
            counts = []
            for ids in encode(*arrow_text(batch.column(1))):
                out.write(np.append(ids, np.uint32(end_id)).astype(dtype).tobytes())
                counts.append(len(ids) + 1)
            n = len(counts)
            starts = begin + np.cumsum([0, *counts[:-1]]) if n else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.full(n, part), pa.int32()),
                    pa.array([name] * n, pa.string()),
                    pa.array(np.arange(place, place + n), pa.int64()),
                    pa.array(starts, pa.int64()),
                    pa.array(counts, pa.int64()),
                ],
                names=["doc_id", "part", "name", "place", "local_start", "n_tokens"],
            )
            place, begin = place + n, begin + sum(counts)
        if out is not None:
            out.close()

    written = stored(
        ranges.sortWithinPartitions(*order).mapInArrow(
            write, "doc_id long, part int, name string, place long, local_start long, n_tokens long"
        ),
        "token-index",
    )
    # One row per part; the running sum over them is the only order that crosses parts.
    sizes = written.groupBy("part", "name").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    before = F.sum("tokens").over(Window.orderBy("part")) - F.col("tokens")
    bases = stored(sizes.withColumn("base", before), "token-bases")
    based = written.join(bases.select("part", "base"), "part")

    def offsets(group: pa.Table) -> pa.Table:
        group = group.sort_by("place")
        starts = group["local_start"].to_numpy() + group["base"].to_numpy()
        end = starts[-1] + group["n_tokens"][-1].as_py()
        name = group["name"][0].as_py()
        fs, inner = _folder(path)
        for kind, values in (("offsets", np.append(starts, end).astype("<u8")), ("docs", group["doc_id"].to_numpy().astype("<i8"))):
            with fs.open_output_stream(f"{inner}/{kind}-{name}.bin") as out:
                out.write(values.tobytes())
        return pa.table({"part": group["part"][:1], "name": group["name"][:1], "docs": pa.array([len(group)], pa.int64())})

    done = stored(based.groupBy("part").applyInArrow(offsets, "part int, name string, docs long"), "token-parts")
    listed = done.select("part", "docs").join(bases.drop("docs"), "part").orderBy("part").collect()
    manifest = {
        "dtype": dtype,
        "end_id": end_id,
        "parts": [{"name": r["name"], "base": r["base"], "tokens": r["tokens"], "docs": r["docs"]} for r in listed],
    }
    with fs.open_output_stream(f"{inner}/{MANIFEST}") as out:
        out.write(json.dumps(manifest).encode())
    own_id = F.when(F.col("doc_id") != no_id, F.col("doc_id")).alias("doc_id")
    return based.select(own_id, (F.col("base") + F.col("local_start")).alias("start"), "n_tokens")


def read_manifest(path: str) -> dict:
    fs, inner = _folder(path)
    with fs.open_input_file(f"{inner.rstrip('/')}/{MANIFEST}") as file:
        return json.loads(file.read())


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of written token files, and ``ids`` on demand.

    Each part is read by one task through a memory map, a few thousand documents at a time.
    ``ids_crc32`` is the unsigned crc32 of the ids as little-endian unsigned 32-bit integers.
    """
    path = path.rstrip("/")
    manifest = read_manifest(path)
    dtype = manifest["dtype"]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    if not manifest["parts"]:
        return spark.createDataFrame([], schema)
    parts = spark.createDataFrame([(p["name"], p["base"]) for p in manifest["parts"]], "name string, base long")
    no_id = int(np.iinfo(np.int64).min)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens = _mapped(f"{path}/tokens-{name}.bin", dtype)
                starts = _mapped(f"{path}/offsets-{name}.bin", "<u8").astype(np.int64)
                docs = _mapped(f"{path}/docs-{name}.bin", "<i8")
                for a in range(0, len(docs), READ_ROWS):
                    b = min(a + READ_ROWS, len(docs))
                    ids = [tokens[starts[i] - base : starts[i + 1] - base].astype("<u4") for i in range(a, b)]
                    own = np.array(docs[a:b])
                    columns = [
                        pa.array(own, pa.int64(), mask=own == no_id),
                        pa.array(starts[a:b], pa.int64()),
                        pa.array(starts[a + 1 : b + 1] - starts[a:b], pa.int64()),
                        pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()),
                    ]
                    if with_ids:
                        columns.append(pa.array([x.astype(np.int64) for x in ids], pa.list_(pa.int64())))
                    names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return parts.repartition(len(manifest["parts"]), "name").mapInArrow(read, schema)
