"""Token counts by a tokenizer compiled to finite-state transducers.

The word pattern of byte-level BPE runs as a transducer over character classes (``words``):
chunks of text give state maps, which a parallel prefix scan composes. Merges never cross
words, so each word is one more transition, annotated with the number of tokens it emits;
these are compiled on first sight, by the library itself, and kept.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import ids_and_bytes, pieces, record_batch
from tabloom.llm.words import forget, words_of

SLICE = 1 << 21     # bytes of text counted at once

COUNTED = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

class Counter:
    """Token counts of texts for one byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are parallel already
        from tokenizers import Tokenizer

        with open(path) as file:
            made = json.load(file)
        before = made.get("pre_tokenizer") or {}
        if made.get("normalizer") or before.get("type") != "ByteLevel" or \
                not before.get("use_regex", True) or before.get("add_prefix_space"):
            raise ValueError("only byte-level BPE with the usual word pattern can be compiled")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = [t["content"] for t in made.get("added_tokens", [])]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.words: dict[str, int] = {}

    def count(self, texts: list[str]) -> np.ndarray:
        """The number of tokens of each text; a special string in it is one token."""
        parts = [self.special.split(t) if self.special and self.special.search(t) else [t]
                 for t in texts]
        owner = np.repeat(np.arange(len(texts)), [len(x) for x in parts])
        words = words_of([p for x in parts for p in x], "byte_level")
        new = [w for w in words.distinct if w not in self.words]
        found = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
        self.words.update(zip(new, map(len, found), strict=True))
        emitted = np.fromiter(map(self.words.__getitem__, words.distinct), np.int64,
                              len(words.distinct))
        forget(self.words, new, len(words.distinct))
        total = np.bincount(owner[words.owner], emitted[words.place], len(texts))
        return total.astype(np.int64) + np.array([len(x) - 1 for x in parts], np.int64)


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One counter for all tasks that a Python worker runs."""
    return Counter(path)


def token_counts(df: DataFrame, tokenizer: str, limit: int = 512, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row.

    ``tokenizer`` is a byte-level BPE file, on every machine. Null and empty texts have no
    tokens; repeated rows are counted each; a null id stays null. Further columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counter(tokenizer)
        for batch in batches:
            for some in pieces(batch, SLICE):
                data = [t.as_buffer().to_pybytes() for t in some.column("text")]
                yield record_batch({
                    "doc_id": some.column("doc_id"), "n_bytes": [len(x) for x in data],
                    "n_tokens": known.count([x.decode("utf-8", "replace") for x in data])},
                    COUNTED)

    slim = ids_and_bytes(df, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return slim.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit)
