"""Packing documents into sequences of a fixed number of tokens.

Documents are cut into pieces no longer than a sequence. How pieces go together depends on
their lengths alone, and there are at most as many lengths as tokens in a sequence; so the
packing is planned on the number of pieces of each length, which Spark counts, and every
piece then finds its place by its length and its number among the pieces of that length.
The plan's size depends on the sequence length, never on the number of documents.

The plan: pieces above a third of the capacity go at most two to a sequence, each of the
longest with the longest one that still fits; the others then fill the tightest gap left,
longest first (best fit decreasing), and open new sequences only where no gap is wide enough.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabloom.functions.checkpoints import stage
from tabloom.llm.common import ids_and_bytes, pieces, record_batch
from tabloom.llm.encoding import encoder

CAPACITY = 2_048
SLICE = 1 << 21     # bytes of text encoded at once

CUT = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
    ("ids_crc32", pa.int64()), ("part", pa.int32()), ("place", pa.int64())])
PACKED = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
    ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def plan(counts: Mapping[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Where the pieces of each length go: rows ``length, first, sequence, each, offset``.

    Pieces of a length are numbered from 0. A row holds for the pieces from number ``first``
    on: they fill sequences from ``sequence`` on, ``each`` of them in one, from ``offset``.
    """
    left = {s: n for s, n in counts.items() if n > 0}
    taken = dict.fromkeys(left, 0)
    gaps: dict[int, list[tuple[int, int]]] = {}     # runs of sequences (first, how many) by gap
    widths: list[int] = []                          # the gaps there are, in order
    rows, bins = [], 0

    def put(size: int, n: int, sequence: int, each: int, offset: int) -> None:
        rows.append((size, taken[size], sequence, each, offset))
        taken[size] += n
        left[size] -= n

    def leave(gap: int, first: int, many: int) -> None:
        if gap and many:
            if gap not in gaps:
                gaps[gap] = []
                insort(widths, gap)
            gaps[gap].append((first, many))

    large = sorted(s for s in left if 3 * s > capacity)
    for size in reversed(large):
        while left[size]:
            at = bisect_left(large, min(size, capacity - size) + 1) - 1
            while at >= 0 and not left[large[at]]:
                at -= 1
            mate = large[at] if at >= 0 else None
            if mate == size and left[size] == 1:    # its own last one has no other
                at -= 1
                while at >= 0 and not left[large[at]]:
                    at -= 1
                mate = large[at] if at >= 0 else None
            if mate is None:
                many = left[size]
                put(size, many, bins, 1, 0)
                leave(capacity - size, bins, many)
            elif mate == size:
                many = left[size] // 2
                put(size, 2 * many, bins, 2, 0)
                leave(capacity - 2 * size, bins, many)
            else:
                many = min(left[size], left[mate])
                put(size, many, bins, 1, 0)
                put(mate, many, bins, 1, size)
                leave(capacity - size - mate, bins, many)
            bins += many
    for size in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        while left[size]:
            at = bisect_left(widths, size)
            if at == len(widths):   # no gap is wide enough: new sequences
                each = min(capacity // size, left[size])
                many = left[size] // each
                put(size, many * each, bins, each, 0)
                leave(capacity - each * size, bins, many)
                bins += many
                continue
            gap = widths[at]
            first, many = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], widths[at]
            each = min(gap // size, left[size])
            used = min(many, left[size] // each)
            put(size, used * each, first, each, capacity - gap)
            leave(gap - each * size, first, used)
            leave(gap, first + used, many - used)
    return np.array(rows, np.int64).reshape(-1, 5)


def cut_documents(df: DataFrame, tokenizer: str, kind: str, end_id: int, capacity: int,
                  id_col: str, text_col: str) -> DataFrame:
    """Pieces with the task that made them (``part``) and their number there by length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, known = TaskContext.get().partitionId(), encoder(tokenizer, kind)
        seen = np.zeros(capacity + 1, np.int64)
        end = np.array([end_id], "<u4")
        for batch in batches:
            for some in pieces(batch, SLICE):
                texts = [t.as_buffer().to_pybytes().decode("utf-8", "replace")
                         for t in some.column("text")]
                out = {name: [] for name in CUT.names}
                for doc, found in zip(some.column("doc_id").to_pylist(), known.ids(texts),
                                      strict=True):
                    ids = np.concatenate([found.astype("<u4"), end])
                    for start in range(0, len(ids), capacity):
                        own = ids[start:start + capacity]
                        row = (doc, start // capacity, start, len(own), zlib.crc32(own), part,
                               int(seen[len(own)]))
                        seen[len(own)] += 1
                        for name, value in zip(CUT.names, row, strict=True):
                            out[name].append(value)
                yield record_batch(out, CUT)

    slim = ids_and_bytes(df, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return slim.mapInArrow(run, "doc_id long, piece int, start long, length long, "
                                "ids_crc32 long, part int, place long")


def pack(df: DataFrame, tokenizer: str, kind: str = "lower_words", end_id: int = 0,
         capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece.

    A document is its ids and ``end_id``; only documents longer than ``capacity`` are cut.
    Null and empty texts are pieces of the end id alone; repeated rows are packed each; a null
    id stays null. Further columns are not read. An empty table gives no rows.
    """
    spark = df.sparkSession
    cut = stage(cut_documents(df, tokenizer, kind, end_id, capacity, id_col, text_col), "pieces")
    by_part = stage(cut.groupBy("part", "length").count(), "lengths")
    counts = by_part.groupBy("length").agg(F.sum("count").alias("n"))
    # At most `capacity` rows.
    rows = plan({r["length"]: r["n"] for r in counts.collect()}, capacity)
    order = np.lexsort((rows[:, 1], rows[:, 0]))
    table = spark.sparkContext.broadcast(rows[order])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, first, sequence, each, offset = table.value.T
        bits = 40   # a piece's number stays below 2**40, a length below 2**23
        key = (size << bits) + first
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("number").to_numpy()
            at = np.searchsorted(key, (length << bits) + number, "right") - 1
            run_of = number - first[at]
            columns = {n: batch.column(n) for n in PACKED.names[:5]}
            yield record_batch(columns | {
                "sequence_id": sequence[at] + run_of // each[at],
                "offset": offset[at] + run_of % each[at] * length}, PACKED)

    before = by_part.withColumn("before", F.coalesce(F.sum("count").over(
        W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    numbered = cut.join(before.drop("count"), ["part", "length"]).withColumn(
        "number", F.col("place") + F.col("before"))
    return numbered.select(*PACKED.names[:5], "number").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, "
             "sequence_id long, offset long")
