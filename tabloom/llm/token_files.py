"""Token ids in flat binary files.

A folder holds for every part (in the order of ids):

- ``ids-PART.bin``: the ids of all its documents one after the other, little-endian unsigned
  16-bit integers where the vocabulary allows it, else 32-bit;
- ``docs-PART.bin``: the documents' ids as signed 64-bit integers (null: the least one);
- ``offsets-PART.bin``: where each document starts among the ids of all parts, and where the
  last one ends, as unsigned 64-bit integers;

and a Parquet table ``parts``: ``part, docs, tokens, base`` and ``width`` (bytes of an id).
The base of a part is the prefix sum of the tokens of all parts before it.

Tasks write through pyarrow's file systems, under a name of their own attempt that is moved
to the final one at the end, so a repeated task leaves the same files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm.common import ids_and_bytes, pieces, qualified, record_batch, ship
from tabloom.llm.encoding import encoder

SLICE = 1 << 21     # bytes of text encoded at once
READ = 1 << 22      # ids read at once
NO_ID = -(2**63)

PARTS = pa.schema([("part", pa.int32()), ("docs", pa.int64()), ("tokens", pa.int64()),
                   ("width", pa.int32())])
INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                   ("ids_crc32", pa.int64())])


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


class _Files:
    """Files of one part, written under the attempt's names until they are whole."""

    def __init__(self, folder: str, part: int, kinds: tuple[str, ...]):
        self.system, path = _open(folder)
        self.system.create_dir(path, recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        self.final = {k: f"{path}/{k}-{part:06d}.bin" for k in kinds}
        self.streams = {k: self.system.open_output_stream(f"{p}.{attempt}")
                        for k, p in self.final.items()}
        self.own = {k: f"{p}.{attempt}" for k, p in self.final.items()}

    def write(self, kind: str, data: bytes) -> None:
        self.streams[kind].write(data)

    def done(self) -> None:
        for kind, stream in self.streams.items():
            stream.close()
            self.system.move(self.own[kind], self.final[kind])


def write_token_files(df: DataFrame, folder: str, tokenizer: str, kind: str = "byte_level",
                      end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write every row's ids and ``end_id`` in ascending order of ids; returns ``parts``.

    ``tokenizer`` is a file of the tokenizers library, on every machine; ``kind`` as in
    ``Encoder``. Null and empty texts have the end id alone. A null id comes first; rows with
    one id come in the order of a hash of their text. Further columns are not read. An empty
    table gives no parts.
    """
    spark = df.sparkSession
    folder = qualified(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, files, docs, tokens = TaskContext.get().partitionId(), None, 0, 0
        known = encoder(tokenizer, kind)
        end = np.array([end_id], known.type).tobytes()
        for batch in batches:
            for some in pieces(batch, SLICE):
                files = files or _Files(folder, part, ("ids", "docs", "lengths"))
                found = known.ids([t.as_buffer().to_pybytes().decode("utf-8", "replace")
                                   for t in some.column("text")])
                sizes = np.array([len(x) for x in found], "<u8") + 1
                files.write("ids", b"".join(x.tobytes() + end for x in found))
                files.write("lengths", sizes.tobytes())
                files.write("docs", some.column("doc_id").fill_null(NO_ID).to_numpy()
                            .astype("<i8").tobytes())
                docs, tokens = docs + len(found), tokens + int(sizes.sum())
        if files:
            files.done()
            yield record_batch({"part": [part], "docs": [docs], "tokens": [tokens],
                                "width": [known.type.itemsize]}, PARTS)

    def offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, base in zip(batch.column("part").to_pylist(),
                                  batch.column("base").to_pylist(), strict=True):
                files = _Files(folder, part, ("offsets",))
                system, path = _open(folder)
                with system.open_input_stream(f"{path}/lengths-{part:06d}.bin") as stream:
                    ends = np.cumsum(np.frombuffer(stream.read(), "<u8")) + np.uint64(base)
                files.write("offsets", np.uint64(base).tobytes() + ends.astype("<u8").tobytes())
                files.done()
            yield batch

    slim = ids_and_bytes(df, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    ordered = (slim.repartitionByRange("doc_id", F.xxhash64("text"))
               .sortWithinPartitions("doc_id", F.xxhash64("text"), "text"))
    # One row per part, as many as Spark's driver keeps track of anyway.
    found = ordered.mapInArrow(
        run, "part int, docs long, tokens long, width int").toArrow().sort_by("part")
    base = np.cumsum(found.column("tokens").to_numpy()) - found.column("tokens").to_numpy()
    parts = found.append_column("base", pa.array(base, pa.int64()))
    table = spark.createDataFrame(parts, "part int, docs long, tokens long, width int, base long")
    (table.repartition(max(1, found.num_rows)).mapInArrow(offsets, table.schema)
     .write.mode("overwrite").parquet(f"{folder}/parts"))
    return spark.read.schema(table.schema).parquet(f"{folder}/parts")


class _Ids:
    """The ids of one part, memory-mapped where the file is local, else read piece by piece."""

    def __init__(self, folder: str, part: int, width: int):
        system, path = _open(folder)
        name, self.type = f"{path}/ids-{part:06d}.bin", np.dtype(f"<u{width}")
        self.local = isinstance(system, fs.LocalFileSystem)
        self.file = np.memmap(name, self.type, "r") if self.local else system.open_input_file(name)

    def __call__(self, start: int, end: int) -> np.ndarray:
        if self.local:
            return self.file[start:end]
        width = self.type.itemsize
        return np.frombuffer(self.file.read_at((end - start) * width, start * width), self.type)


def _numbers(folder: str, name: str, kind: str) -> np.ndarray:
    system, path = _open(folder)
    with system.open_input_stream(f"{path}/{name}") as stream:
        return np.frombuffer(stream.read(), kind)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files alone.

    ``start`` counts the ids of all documents before it; the checksum is of the ids as
    little-endian unsigned 32-bit integers.
    """

    folder = qualified(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                part, base = row["part"], row["base"]
                docs = _numbers(folder, f"docs-{part:06d}.bin", "<i8")
                at = _numbers(folder, f"offsets-{part:06d}.bin", "<u8").astype(np.int64)
                ids, sums = _Ids(folder, part, row["width"]), np.empty(len(docs), np.int64)
                for k in range(len(docs)):
                    crc = 0
                    for start in range(at[k] - base, at[k + 1] - base, READ):
                        some = ids(start, min(start + READ, at[k + 1] - base))
                        crc = zlib.crc32(some.astype("<u4").tobytes(), crc)
                    sums[k] = crc
                for low in range(0, len(docs), 1 << 16):
                    cut = slice(low, min(low + (1 << 16), len(docs)))
                    yield record_batch({
                        "doc_id": pa.array(docs[cut], mask=docs[cut] == NO_ID),
                        "start": at[:-1][cut], "n_tokens": np.diff(at)[cut],
                        "ids_crc32": sums[cut]}, INDEX)

    ship(spark)
    parts = spark.read.parquet(f"{folder}/parts")
    return parts.repartition(max(1, parts.count())).mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id`` and its ``ids`` (an array of int, the end id included)."""

    folder = qualified(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
        for batch in batches:
            for row in batch.to_pylist():
                part, base = row["part"], row["base"]
                docs = _numbers(folder, f"docs-{part:06d}.bin", "<i8")
                at = _numbers(folder, f"offsets-{part:06d}.bin", "<u8").astype(np.int64) - base
                ids = _Ids(folder, part, row["width"])
                for k, doc in enumerate(docs.tolist()):
                    yield record_batch({
                        "doc_id": [None if doc == NO_ID else doc],
                        "ids": [ids(at[k], at[k + 1]).astype(np.int32)]}, schema)

    ship(spark)
    parts = spark.read.parquet(f"{folder}/parts")
    return parts.repartition(max(1, parts.count())).mapInArrow(run, "doc_id long, ids array<int>")
