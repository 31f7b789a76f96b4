"""A quality classifier: logistic regression over hashed word n-grams.

Words are runs of letters and digits, or of other marks. Features are hashed single words,
word pairs, and triples of word shapes (case, digits, marks, repeated word), each kind as
shares of the document that sum to one, so that a document's score does not depend on its
length. Training is one pass after another of follow-the-regularised-leader updates
(FTRL-proximal) over a bounded sample, in one task; scoring is a sparse dot product per
document with the broadcast weights, whose number is fixed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm.common import named, pieces, record_batch, remainder, ship, whole_text

DIMENSIONS = 1 << 18    # hashed features; the last weight is the bias
SAMPLE = 10_000         # labelled documents to learn from, at most
EPOCHS = 6
SCALE = 20.0            # a feature's value is its share of the document times this
SLICE = 1 << 21         # bytes of text turned into features at once
WORDS_KEPT = 100_000    # words whose hash a task remembers

# Bytes beyond ASCII count as letters.
WORD = re.compile(rb"[\w\x80-\xff]+|[^\w\s\x80-\xff]+")
TRAINED = pa.schema([("index", pa.int32()), ("weight", pa.float64())])


def _shape(word: bytes) -> int:
    """0 lower, 1 capitalised, 2 upper, 3 digits, 4 other letters, 5 a mark, 6 several marks."""
    if word.isalpha() or word[0] >= 0x80 or word[:1].isalnum():
        if word.isdigit():
            return 3
        if word.islower():
            return 0
        if word.isupper() and len(word) > 1:
            return 2
        return 1 if word.istitle() or word[:1].isupper() else 4
    return 5 if len(word) == 1 else 6


class _Hashes(dict):
    """The hash of each word, its last three bits replaced by the word's shape."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word) & ~7 | _shape(word)
        return value


HASHES = _Hashes()


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which text, which feature, and the feature's value; one feature may come repeatedly."""
    get = HASHES.__getitem__
    lists = [list(map(get, WORD.findall(t))) for t in texts]
    sizes = np.array([len(x) for x in lists], np.int64)
    words = np.array([h for x in lists for h in x], np.uint64)
    if not len(words):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    doc = np.repeat(np.arange(len(texts)), sizes)
    shape = (words & np.uint64(7)).astype(np.int64)
    before = np.concatenate([[np.uint64(0)], words[:-1]])
    first = np.concatenate([[True], doc[1:] != doc[:-1]])
    before[first] = 0
    was = np.where(first, 7, np.concatenate([[7], shape[:-1]]))
    older = np.where(first, 7, np.concatenate([[7], was[:-1]]))
    mix, top = np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - 18)
    with np.errstate(over="ignore"):
        one = (words * mix) >> top
        two = ((before * mix ^ words) * mix + np.uint64(1)) >> top
        code = ((older * 8 + was) * 8 + shape) * 2 + (before == words)
        three = (code.astype(np.uint64) * mix + np.uint64(2)) * mix >> top
    which = np.concatenate([one, two, three]).astype(np.int64) % (DIMENSIONS - 1)
    return np.tile(doc, 3), which, np.tile(np.repeat(SCALE / np.maximum(sizes, 1), sizes), 3)


def summed(doc: np.ndarray, which: np.ndarray, value: np.ndarray, n: int) -> list[tuple]:
    """For each of ``n`` texts, its features (each once) and their values."""
    key, place = np.unique(doc * DIMENSIONS + which, return_inverse=True)
    total = np.bincount(place, value)
    cuts = np.searchsorted(key, np.arange(1, n) * DIMENSIONS)
    return list(zip(np.split(key % DIMENSIONS, cuts), np.split(total, cuts), strict=True))


def learn(rows: list[tuple[np.ndarray, np.ndarray, float]], epochs: int = EPOCHS,
          alpha: float = 0.1, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1) -> np.ndarray:
    """Weights after ``epochs`` passes of FTRL-proximal over features, values and labels."""
    z, n = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS)

    def weights(i):
        part = z[i]
        return np.where(np.abs(part) <= l1, 0.0, (np.sign(part) * l1 - part)
                        / ((beta + np.sqrt(n[i])) / alpha + l2))

    order = np.random.default_rng(0)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            which, value, label = rows[k]
            i, x = np.append(which, DIMENSIONS - 1), np.append(value, 1.0)
            w = weights(i)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
            step = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - step * w
            n[i] += g * g
    return weights(np.arange(DIMENSIONS))


def train(df: DataFrame, text_col: str = "text", label_col: str = "quality") -> np.ndarray:
    """Weights learned from the rows' texts and 0/1 labels.

    The rows are held in one task as sparse features, so their number must be bounded by
    the caller. Rows without a label are left out; no rows give zero weights, which score
    every text 0.5.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for part in pieces(batch, SLICE):
                texts = [t.as_buffer().to_pybytes() for t in part.column("text")]
                found = summed(*features(texts), len(texts))
                rows += [(i, x, y) for (i, x), y in
                         zip(found, part.column("label").to_pylist(), strict=True)]
        w = learn(rows)
        kept = np.nonzero(w)[0]
        yield record_batch({"index": kept, "weight": w[kept]}, TRAINED)

    ship(df.sparkSession)
    slim = (df.where(named(label_col).isNotNull())
            .select(whole_text(text_col).cast("binary").alias("text"),
                    named(label_col).cast("double").alias("label"))
            .repartition(1).sortWithinPartitions(F.xxhash64("text"), "text", "label"))
    found = slim.mapInArrow(run, "index int, weight double").toArrow()
    w = np.zeros(DIMENSIONS)
    w[found.column("index").to_numpy()] = found.column("weight").to_numpy()
    return w


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", label_col: str = "quality",
                  usable: Column | None = None, sample: int = SAMPLE) -> DataFrame:
    """At most about ``sample`` labelled documents, ``text`` and ``label``.

    The ids with the smallest hashes are taken, from all ids for which ``usable`` (an
    expression on the labels table) holds. An id whose labels contradict each other is left
    out. Where ids repeat in the documents, each row counts.
    """
    known = labels.where(named(id_col).isNotNull() & named(label_col).isNotNull())
    known = known if usable is None else known.where(usable)
    picked = (known.groupBy(named(id_col).alias("__id"))
              .agg(F.min(named(label_col)).alias("__label"), F.max(named(label_col)).alias("__most"))
              .where("__label = __most").orderBy(F.xxhash64("__id"), "__id").limit(sample))
    # At most `sample` rows of two numbers.
    rows = docs.select(named(id_col).alias("__id"), named(text_col).alias("text")).join(
        F.broadcast(picked.select("__id", "__label")), "__id")
    return rows.select("text", F.col("__label").alias("label")).limit(2 * sample)


def score_column(spark: SparkSession, text: Column, weights: np.ndarray) -> Column:
    """The score (0 to 1) of a text column; null counts as empty.

    A text without any word has the score of the bias alone.
    """
    ship(spark)
    model = spark.sparkContext.broadcast(weights)

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        w, out = model.value, []
        for part in pieces(pa.RecordBatch.from_arrays([texts], ["text"]), SLICE):
            some = [t.as_buffer().to_pybytes() for t in part.column("text")]
            doc, which, value = features(some)
            total = np.bincount(doc, w[which] * value, len(some)) + w[-1]
            out.append(1 / (1 + np.exp(-np.clip(total, -35, 35))))
        return pa.array(np.concatenate(out) if out else np.empty(0))

    return run(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def learned(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            label_col: str = "quality", divisor: int = 4, fold: int = 2,
            sample: int = SAMPLE) -> np.ndarray:
    """Weights from labelled rows whose crc32 of the id modulo ``divisor`` is not ``fold``."""
    rows = training_rows(docs, labels, id_col, text_col, label_col,
                         remainder(id_col, divisor) != fold, sample)
    return train(rows, "text", "label")


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text", label_col: str = "quality", divisor: int = 4,
                   fold: int = 2, threshold: float = 0.7, sample: int = SAMPLE) -> DataFrame:
    """Every document's ``doc_id, held_out, score, predicted``.

    Learns from labelled rows whose crc32 of the id modulo ``divisor`` is not ``fold``.
    Null and empty texts are scored by the bias; repeated rows are scored each; a null id
    is never learned from. Further columns are not read. An empty table gives no rows.
    """
    weights = learned(docs, labels, id_col, text_col, label_col, divisor, fold, sample)
    scored = docs.select(
        named(id_col).alias("doc_id"), (remainder(id_col, divisor) == fold).alias("held_out"),
        score_column(docs.sparkSession, named(text_col), weights).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
