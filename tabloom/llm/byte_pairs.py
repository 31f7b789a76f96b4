"""Byte-level BPE with the tiktoken library and a local rank file, both ways.

Long texts are encoded piece by piece, cut where no match of the word pattern can reach
across: between an ASCII letter or digit and a space or line end. Ids decode to raw bytes.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import ids_and_bytes, named, pieces, record_batch, ship

LONG = 1 << 16      # characters from which on the next safe place is looked for
SLICE = 1 << 22     # bytes handled at once
SAFE = re.compile(r"(?<=[A-Za-z0-9])[ \n]")
# Unicode's white space. A run that long is taken out of the pattern search.
BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{4096,}")
BLANK_RULE = r"|\s+(?!\S)|\s+"     # how patterns end in which all blanks but the last are a match

ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])
DECODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str):
    """The library's encoding of a rank file (lines of a base64 token and its rank)."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_pieces(text: str, long: int = LONG) -> Iterator[str]:
    """The text in pieces of at least ``long`` characters, cut at safe places only."""
    start = 0
    while len(text) - start > long and (cut := SAFE.search(text, start + long)):
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def ids_of(known, text: str, long: int = LONG) -> np.ndarray:
    """The library's ids of a text of any length."""
    out: list[np.ndarray] = []

    def add(ids: list[int]) -> None:
        out.append(np.array(ids, "<u4"))

    start = 0
    if known._pat_str.endswith(BLANK_RULE) and r"\r\n" not in known._pat_str:
        for run in BLANKS.finditer(text):
            for piece in safe_pieces(text[start:run.start()], long):
                add(known.encode_ordinary(piece))
            # Before a mark, the last blank belongs to what follows.
            start = run.end() if run.end() == len(text) else run.end() - 1
            add(known._encode_single_piece(text[run.start():start]))
    for piece in safe_pieces(text[start:], long):
        add(known.encode_ordinary(piece))
    return np.concatenate(out)


def encode(df: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text", long: int = LONG) -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian unsigned 32-bit integers as bytes) of every row.

    Special strings in a text are ordinary text. Null and empty texts have no ids; repeated
    rows are encoded each; a null id stays null. Texts may be of any length and hold runs of
    any length; a task's memory grows with its longest text. An empty table gives no rows.
    Further columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoding(ranks, pattern)
        for batch in batches:
            for some in pieces(batch, SLICE):
                ids = [ids_of(known, t.as_buffer().to_pybytes().decode("utf-8", "replace"),
                              long).tobytes() for t in some.column("text")]
                yield record_batch({"doc_id": some.column("doc_id"), "ids": ids}, ENCODED)

    slim = ids_and_bytes(df, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return slim.mapInArrow(run, "doc_id long, ids binary")


def decode(df: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id",
           ids_col: str = "ids") -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded`` (raw bytes); null ids decode to null, ids of an empty
    text to no bytes. Rows of any number of ids; an empty table gives no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoding(ranks, pattern)
        for batch in batches:
            for some in pieces(batch, SLICE, "ids"):
                out = [known.decode_bytes(np.frombuffer(x.as_buffer(), "<u4").tolist())
                       if x.is_valid else None for x in some.column("ids")]
                yield record_batch({"doc_id": some.column("doc_id"), "ids": some.column("ids"),
                                    "decoded": out}, DECODED)

    ship(df.sparkSession)
    slim = df.select(named(id_col).cast("long").alias("doc_id"), named(ids_col).alias("ids"))
    return slim.mapInArrow(run, "doc_id long, ids binary, decoded binary")
