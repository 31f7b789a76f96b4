"""How the tokens of two tokenizers lie over each other, counted over a corpus.

Every distinct text is tokenised and aligned once: rows are shuffled by their full text, and what
a text adds to the corpus-wide counts is weighted by how many rows hold it. A text's tokens are
cut into groups at the byte offsets where tokens of both tokenizers end; the tokens of a group
are linked with each other.

Counts come from Spark's own aggregation of the distinct links of each text. To bring them back
to the texts, texts are put into blocks of a bounded number of links; a block asks
for each of its distinct links once, and gets one row for each, so that a frequent link costs one
row for each block rather than one for each text.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.checkpoints import stage
from tabloom.llm.common import named, pieces, record_batch, ship, whole_text
from tabloom.llm.encoding import Encoder
from tabloom.llm.words import forget

SLICE = 1 << 20             # bytes of text aligned at once
BLOCK_LINKS = 1_500_000     # distinct links of texts in a block, beyond which a new one begins
WIDE = 1 << 9               # links of a group from which on its distinct ids are paired
SPACE = "▁"            # SentencePiece's mark of a space

ALIGNED = pa.schema([
    ("text_id", pa.binary()), ("rows", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
    ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
    ("block", pa.int64()), ("links", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])
ALIGNED_DDL = ("text_id binary, rows long, n_a long, n_b long, n_groups long, n_links long, "
               "groups_sha256 string, block long, links array<bigint>, times array<bigint>")
MEASURED = pa.schema([("text_id", pa.binary()), ("n_best", pa.int64()), ("count_sum", pa.int64())])


class ByteLevel(Encoder):
    """Byte-level BPE of the tokenizers library, without special strings, on a space and a text."""

    def __init__(self, path: str):
        super().__init__(path, "byte_level")
        self.tokenizer.encode_special_tokens = True
        self.odd = re.compile(r"(?!)")
        size = self.tokenizer.get_vocab_size()
        of = bytes_of_characters()
        self.bytes = [bytes(of[c] for c in self.tokenizer.id_to_token(i) if c in of)
                      for i in range(size)]


def bytes_of_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable bytes of Latin-1 stand for themselves, the others are numbered from 256 on.
    """
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Pieces:
    """A SentencePiece model that puts a space before a text, with its words remembered.

    No piece of such a model has a space after another character, so nothing is merged across
    the begin of a run of spaces; a text's ids are those of its words, each with the
    spaces before it. A model with other pieces gets whole texts.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else
                      n.replace(SPACE, " ").encode() for i, n in enumerate(names)]
        self.by_words = not any(SPACE in n.lstrip(SPACE) for n in names) and \
            self.model.encode(" x") != self.model.encode("x")
        self.lone = np.array([self.model.piece_to_id(SPACE)], "<u4").tobytes()
        self.words: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.model.encode(texts, num_threads=1)
        return [np.array(x, "<u4").tobytes() for x in found]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of texts without the space that comes before them."""
        if not self.by_words:
            return [np.frombuffer(b, "<u4") for b in self._whole(texts)]
        split = [WORD.findall(" " + t.replace(SPACE, " ")) for t in texts]
        distinct = set().union(*split) if split else set()
        new = [w for w in distinct if w not in self.words]
        # A word begins with a space at least; the model puts one there itself.
        self.words.update(zip(new, self._whole([w[1:] for w in new]), strict=True))
        if " " in distinct:     # the last character of a text; an empty text would get no space
            self.words[" "] = self.lone
        out = [np.frombuffer(b"".join(map(self.words.__getitem__, x)), "<u4") for x in split]
        forget(self.words, new, len(distinct))
        return out


WORD = re.compile(" +[^ ]*")


class Aligner:
    """The tokens, groups and links of texts under two tokenizers."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self.many_b = len(self.b.bytes)
        self.sizes_a = np.fromiter(map(len, self.a.bytes), np.int64, len(self.a.bytes))
        self.sizes_b = np.fromiter(map(len, self.b.bytes), np.int64, self.many_b)
        # Ids as text with what follows them, by side: within a side, after it.
        self.told = [b"%d%b" % (i, mark) for n, marks in ((len(self.a.bytes), (b",", b"|")),
                                                         (self.many_b, (b",", b";")))
                     for mark in marks for i in range(n)]

    def _tokens(self, texts: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        read = [t.decode("utf-8", "replace") for t in texts]
        a = [x.astype(np.int64) for x in self.a.ids([" " + t for t in read])]
        b = [x.astype(np.int64) for x in self.b.ids(read)]
        for k, text in enumerate(texts):
            want = b" " + text
            if not text or b"".join(map(self.a.bytes.__getitem__, a[k].tolist())) != want or \
                    b"".join(map(self.b.bytes.__getitem__, b[k].tolist())) != want:
                a[k] = b[k] = np.zeros(0, np.int64)
        return a, b

    def align(self, texts: list[bytes]) -> dict[str, list]:
        """The columns of each text; ``links`` are ``a * |B| + b``, each once, with ``times``."""
        per_a, per_b = self._tokens(texts)
        n_a = np.array([len(x) for x in per_a], np.int64)
        n_b = np.array([len(x) for x in per_b], np.int64)
        a = np.concatenate([*per_a, np.zeros(0, np.int64)])
        b = np.concatenate([*per_b, np.zeros(0, np.int64)])
        ends_a, ends_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a = np.searchsorted(common, ends_a)
        group_b = np.searchsorted(common, ends_b)
        in_a = np.bincount(group_a, minlength=len(common))
        in_b = np.bincount(group_b, minlength=len(common))
        first_b = np.cumsum(in_b) - in_b
        owner_a = np.repeat(np.arange(len(texts)), n_a)
        owner = owner_a[np.cumsum(in_a) - 1] if len(common) else np.zeros(0, np.int64)
        many = in_a * in_b
        text, link, times = self._links(a, b, group_a, in_a, in_b, first_b, owner_a, owner)
        cuts = np.searchsorted(text, np.arange(1, len(texts)))
        return {
            "n_a": n_a, "n_b": n_b, "n_groups": np.bincount(owner, minlength=len(texts)),
            "n_links": np.bincount(owner, many, len(texts)).astype(np.int64),
            "groups_sha256": self._digests(a, b, group_a, group_b, in_a, in_b, n_a, n_b),
            "links": np.split(link, cuts), "times": np.split(times, cuts)}

    def _links(self, a, b, group_a, in_a, in_b, first_b, owner_a, owner):
        """Text, link and how often, sorted by text and link."""
        wide = in_a * in_b > WIDE
        take = ~wide[group_a] if len(wide) else np.zeros(0, bool)
        fan = in_b[group_a[take]]
        before = np.cumsum(fan) - fan
        partner = np.repeat(first_b[group_a[take]] - before, fan) + np.arange(fan.sum())
        link = np.repeat(a[take] * self.many_b, fan) + b[partner]
        space = len(self.a.bytes) * self.many_b
        keys, times = np.unique(np.repeat(owner_a[take], fan) * space + link, return_counts=True)
        if wide.any():
            first_a = np.cumsum(in_a) - in_a
            more, more_times = [keys], [times]
            for g in np.nonzero(wide)[0].tolist():
                ids_a, t_a = np.unique(a[first_a[g]:first_a[g] + in_a[g]], return_counts=True)
                ids_b, t_b = np.unique(b[first_b[g]:first_b[g] + in_b[g]], return_counts=True)
                more.append((owner[g] * space + ids_a[:, None] * self.many_b + ids_b).ravel())
                more_times.append((t_a[:, None] * t_b).ravel())
            keys, place = np.unique(np.concatenate(more), return_inverse=True)
            whole = np.zeros(len(keys), np.int64)
            np.add.at(whole, place, np.concatenate(more_times))
            times = whole
        return keys // space, keys % space, times

    def _digests(self, a, b, group_a, group_b, in_a, in_b, n_a, n_b) -> list[str]:
        """The hash of each text's groups as text, empty without tokens."""
        before_b = np.cumsum(in_b) - in_b
        upto_a = np.cumsum(in_a)
        at_a = np.arange(len(a)) + before_b[group_a]
        at_b = np.arange(len(b)) + upto_a[group_b]
        base = 2 * len(self.a.bytes)
        last_a, last_b = np.diff(group_a, append=-1) != 0, np.diff(group_b, append=-1) != 0
        order = np.empty(len(a) + len(b), np.int64)
        order[at_a] = a + last_a * len(self.a.bytes)
        order[at_b] = base + b + last_b * self.many_b
        parts = list(map(self.told.__getitem__, order.tolist()))
        out, start = [], 0
        for size in (n_a + n_b).tolist():
            whole = b"".join(parts[start:start + size])[:-1]
            out.append(hashlib.sha256(whole).hexdigest() if size else "")
            start += size
        return out


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One for all tasks that a Python worker runs."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Aligner(path_a, path_b)


def aligned_texts(texts: DataFrame, path_a: str, path_b: str,
                  block_links: int = BLOCK_LINKS) -> DataFrame:
    """Distinct texts (``text`` as bytes, ``rows``) with the measures of their own.

    ``links`` are ``a * |B| + b``, each once, with its ``times``; ``block`` numbers stretches of
    texts of one task that have about ``block_links`` distinct links together.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = aligner(path_a, path_b)
        block, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for some in pieces(batch, SLICE):
                data = [t.as_buffer().to_pybytes() for t in some.column("text")]
                found = known.align(data)
                blocks = []
                for own in found["links"]:
                    if held and held + len(own) > block_links:
                        block, held = block + 1, 0
                    held += len(own)
                    blocks.append(block)
                yield record_batch(found | {
                    "text_id": [hashlib.sha256(x).digest() for x in data],
                    "rows": some.column("rows"), "block": blocks}, ALIGNED)

    ship(texts.sparkSession)
    return texts.select("text", "rows").mapInArrow(run, ALIGNED_DDL)


def _measured(left: pa.Table, right: pa.Table) -> pa.Table:
    """The sums over each text's links, from the counts of the block's distinct links."""
    link = right.column("link").to_numpy()
    order = np.argsort(link)
    link, count = link[order], right.column("count").to_numpy()[order]
    best = right.column("best").to_numpy(zero_copy_only=False)[order]
    own, times = left.column("links").combine_chunks(), left.column("times").combine_chunks()
    sizes = np.diff(own.offsets.to_numpy())
    at = np.searchsorted(link, own.flatten().to_numpy())
    times = times.flatten().to_numpy()
    sums = [np.concatenate([[0], np.cumsum(x)]) for x in (times * best[at], times * count[at])]
    ends = np.cumsum(sizes)
    return pa.table({"text_id": left.column("text_id"),
                     "n_best": sums[0][ends] - sums[0][ends - sizes],
                     "count_sum": sums[1][ends] - sums[1][ends - sizes]}, schema=MEASURED)


def align_tokenizers(df: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id",
                     text_col: str = "text", block_links: int = BLOCK_LINKS) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row.

    A is a byte-level BPE file of the tokenizers library, run on a space and the text; B a
    SentencePiece model, which adds that space itself; special strings are plain text. A
    null or empty text, and one whose tokens do not give back its bytes under both (as one with
    the mark U+2581 in it, or bytes that are no UTF-8), has no tokens: zeros and an empty hash.
    Repeated rows count each; a null id stays null. Texts of any length are handled whole; a
    task's memory grows with its longest text and that text's distinct links. An empty table
    gives no rows. Other columns are not read.

    A link's count is the number of rows whose text holds it; ``n_best`` is the number of a
    row's links whose count is the highest of their A id, ``count_sum`` the sum of counts.
    """
    rows = df.select(named(id_col).cast("long").alias("doc_id"),
                     whole_text(text_col).cast("binary").alias("text"))
    texts = rows.groupBy("text").agg(F.count(F.lit(1)).alias("rows"))
    known = stage(aligned_texts(texts, path_a, path_b, block_links), "aligned", compression="zstd")
    many_b = vocabulary_size(path_b)
    links = known.select("rows", "block", F.explode("links").alias("link"))
    # Each task's blocks are its own, so this combines most of what there is before the shuffle.
    asked = stage(links.groupBy("block", "link").agg(F.sum("rows").alias("rows")), "asked",
                  compression="zstd")
    counts = stage(asked.groupBy("link").agg(F.sum("rows").alias("count")), "counts")
    id_a = F.floor(F.col("link") / many_b)
    highest = counts.groupBy(id_a.alias("a")).agg(F.max("count").alias("highest"))
    judged = counts.withColumn("a", id_a).join(highest, "a").select(
        "link", "count", (F.col("count") == F.col("highest")).alias("best"))
    told = asked.select("block", "link").join(judged, "link")
    measures = known.where("n_links > 0").select("block", "text_id", "links", "times").groupBy(
        "block").cogroup(told.groupBy("block")).applyInArrow(
            _measured, "text_id binary, n_best long, count_sum long")
    whole = stage(known.drop("links", "times", "block", "rows").join(measures, "text_id", "left"),
                  "measures")
    # Written out, so that the join has plain exchanges, which can be cut at copies.
    keyed = rows.select("doc_id", F.unhex(F.sha2("text", 256)).alias("text_id"))
    return keyed.join(whole, "text_id").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")], "groups_sha256")


@lru_cache(maxsize=4)
def vocabulary_size(path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size()
