"""Scoring texts with a word bigram model by deleted interpolation.

P(w | v) = a c(v,w)/c(v) + b c(w)/N + c 1/(V+1), where the weights depend on how frequent the
context v is (buckets by powers of two). They are learned by expectation-maximisation on a
part of the training texts whose own counts are taken off first (the deleted part).

Counts cover all training texts. Texts are tokenised once, into blocks of a few million
tokens that are written out, bucketed by block. Each block asks for the counts of its distinct
words and word pairs, packed by ranges of their hashes; a range's requests meet in one task,
which adds them up and answers every block in the order it asked. So a frequent pair is sent
once per block, nothing is sent per token, and the number of ranges follows the number of
tokens. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.functions.checkpoints import scratch_path, stage
from tabloom.llm.common import ids_and_bytes, pieces, record_batch, remainder

BLOCK = 2_000_000       # tokens of a block, about
RANGE = 3_000_000       # requested counts that one task adds up, about
SLICE = 1 << 22         # bytes of text tokenised at once
ROUNDS = 40             # of expectation-maximisation
END = xxhash.xxh64_intdigest(b" ")  # no word has a space
WORDS, PAIRS, TOTALS = 0, 1, 2

BLOCKS = pa.schema([
    ("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("held_out", pa.list_(pa.bool_())),
    ("deleted", pa.list_(pa.bool_())), ("lengths", pa.list_(pa.int64())),
    ("words", pa.binary()), ("tokens", pa.binary())])
BLOCKS_SQL = ("block long, doc_ids array<long>, held_out array<boolean>, deleted array<boolean>, "
              "lengths array<long>, words binary, tokens binary")
REQUESTS = pa.schema([("kind", pa.int32()), ("range", pa.int32()), ("block", pa.int64()),
                      ("n", pa.int64()), ("data", pa.binary())])
ANSWERS = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("range", pa.int32()),
                     ("n", pa.int64()), ("data", pa.binary()), ("tokens", pa.int64()),
                     ("types", pa.int64()), ("deleted_tokens", pa.int64())])
CELLS = pa.schema([("bucket", pa.int32()), ("pair_bin", pa.int32()), ("word_bin", pa.int32()),
                   ("n", pa.float64()), ("log_pair", pa.float64()), ("log_word", pa.float64())])
SCORES = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
    ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()),
    ("score", pa.float64())])


def _sql(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "long", pa.int32(): "int", pa.float64(): "double", pa.bool_(): "boolean",
             pa.binary(): "binary"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def squeezed(*arrays: np.ndarray) -> bytes:
    """Arrays of equal length as compressed byte planes: high bytes are mostly zero."""
    planes = [np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8).T) for a in arrays]
    return pa.compress(b"".join(p.tobytes() for p in planes), codec="zstd", asbytes=True)


def unsqueezed(data: bytes, n: int, arrays: int) -> list[np.ndarray]:
    flat = np.frombuffer(pa.decompress(data, n * 8 * arrays, codec="zstd", asbytes=True), np.uint8)
    return [np.ascontiguousarray(p.T).view("<u8").reshape(-1) for p in flat.reshape(arrays, 8, n)]


def tokenised(df: DataFrame, id_col: str, text_col: str, divisor: int, fold: int,
              block: int) -> DataFrame:
    """The texts as blocks: distinct words (hashes) and each token's place among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        known: dict[bytes, int] = {}
        docs, parts, tokens = [], [], 0

        def flush() -> pa.RecordBatch:
            words = np.array([END, *(xxhash.xxh64_intdigest(w) for w in known)], "<u8")
            return record_batch({
                "block": [(task << 32) + made], "doc_ids": [[d[0] for d in docs]],
                "held_out": [[d[1] for d in docs]], "deleted": [[d[2] for d in docs]],
                "lengths": [[len(p) for p in parts]], "words": [words.tobytes()],
                "tokens": [np.concatenate(parts).astype("<u4").tobytes()]}, BLOCKS)

        for batch in batches:
            for some in pieces(batch, SLICE):
                rows = zip(*(some.column(c).to_pylist() for c in ("doc_id", "fold", "text")),
                           strict=True)
                for doc, part, text in rows:
                    words = text.lower().split()
                    ids = np.zeros(len(words) + 1, np.uint32)   # the end is word 0
                    for w in words:
                        if w not in known:
                            known[w] = len(known) + 1
                    ids[:-1] = [known[w] for w in words]
                    docs.append((doc, part == fold, part == (fold + 1) % divisor))
                    parts.append(ids)
                    tokens += len(ids)
                    if tokens >= block:
                        yield flush()
                        made, known, docs, parts, tokens = made + 1, {}, [], [], 0
        if docs:
            yield flush()

    slim = ids_and_bytes(df, id_col, text_col, remainder(id_col, divisor).cast("int").alias("fold"))
    return slim.withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(run, BLOCKS_SQL)


class _Block:
    """One block, with its distinct words and pairs in the order of their hashes."""

    def __init__(self, row: dict):
        self.block, self.doc_ids = row["block"], row["doc_ids"]
        self.held_out = np.array(row["held_out"], bool)
        self.lengths = np.array(row["lengths"], np.int64)
        words = np.frombuffer(row["words"], "<u8")
        tokens = np.frombuffer(row["tokens"], "<u4").astype(np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.training = np.repeat(~self.held_out, self.lengths)
        self.deleted = np.repeat(np.array(row["deleted"], bool), self.lengths)
        order = np.argsort(words)
        place = np.empty(len(words), np.int64)
        place[order] = np.arange(len(words))
        self.words, self.word = words[order], place[tokens]
        before = np.concatenate([[0], tokens[:-1]])
        before[self.starts] = 0     # a text begins after an end
        self.context = place[before]
        with np.errstate(over="ignore"):
            mixed = words[before] * np.uint64(0x9E3779B97F4A7C15)
            mixed = ((mixed ^ (mixed >> np.uint64(29))) + words[tokens]) * np.uint64(0xBF58476D1CE4E5B9)
            mixed ^= mixed >> np.uint64(32)
        self.pairs, self.pair = np.unique(mixed * np.uint64(0x94D049BB133111EB), return_inverse=True)

    def counts(self, which: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences in training texts, and in the deleted part of them."""
        return (np.bincount(which, self.training, n).astype(np.uint64),
                np.bincount(which, self.deleted, n).astype(np.uint64))


def _edges(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where each range of hashes begins among sorted keys."""
    bounds = [(k << 64) // ranges for k in range(ranges)]
    return np.append(np.searchsorted(keys, np.array(bounds, np.uint64)), len(keys))


def _requests(ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                b = _Block(batch.slice(i, 1).to_pylist()[0])
                for kind, keys, which in ((WORDS, b.words, b.word), (PAIRS, b.pairs, b.pair)):
                    ours, deleted = b.counts(which, len(keys))
                    cut = _edges(keys, ranges)
                    out = {name: [] for name in REQUESTS.names}
                    for k in range(ranges):
                        low, high = cut[k], cut[k + 1]
                        if low < high:
                            steps = np.diff(keys[low:high], prepend=np.uint64(0))
                            for name, value in zip(REQUESTS.names, (
                                    kind, k, b.block, high - low,
                                    squeezed(steps, ours[low:high], deleted[low:high])),
                                    strict=True):
                                out[name].append(value)
                    yield record_batch(out, REQUESTS)

    return run


def _answer(table: pa.Table) -> pa.Table:
    """Totals of one range of hashes, for every block in the order it asked."""
    rows = table.to_pylist()
    asked = [unsqueezed(r["data"], r["n"], 3) for r in rows]
    keys = np.concatenate([np.cumsum(a[0], dtype=np.uint64) for a in asked])
    unique, place = np.unique(keys, return_inverse=True)
    ours = np.bincount(place, np.concatenate([a[1] for a in asked]), len(unique)).astype(np.uint64)
    deleted = np.bincount(place, np.concatenate([a[2] for a in asked]), len(unique)).astype(np.uint64)
    out, start = {name: [] for name in ANSWERS.names}, 0
    for r in rows:
        own = place[start:start + r["n"]]
        start += r["n"]
        row = (r["block"], r["kind"], r["range"], r["n"], squeezed(ours[own], deleted[own]), 0, 0, 0)
        for name, value in zip(ANSWERS.names, row, strict=True):
            out[name].append(value)
    if rows[0]["kind"] == WORDS:
        row = (-1, TOTALS, rows[0]["range"], 0, b"", int(ours.sum()), int((ours > 0).sum()),
               int(deleted.sum()))
        for name, value in zip(ANSWERS.names, row, strict=True):
            out[name].append(value)
    return pa.table({f.name: pa.array(out[f.name], f.type) for f in ANSWERS}, schema=ANSWERS)


def _known(block: pa.Table, answers: pa.Table) -> tuple[_Block, list[np.ndarray]]:
    """A block, and for each token the counts (all, deleted) of its pair, context and word."""
    b = _Block(block.to_pylist()[0])
    found: dict[int, list] = {WORDS: [], PAIRS: []}
    for r in sorted(answers.to_pylist(), key=lambda r: r["range"]):
        found[r["kind"]].append(unsqueezed(r["data"], r["n"], 2))
    words = [np.concatenate([x[i] for x in found[WORDS]]).astype(np.float64) for i in range(2)]
    pairs = [np.concatenate([x[i] for x in found[PAIRS]]).astype(np.float64) for i in range(2)]
    return b, [c[which] for which, source in (
        (b.pair, pairs), (b.context, words), (b.word, words)) for c in source]


def bucket_of(context_count: np.ndarray) -> np.ndarray:
    """0 for a context never seen, else 1 more than the whole binary logarithm."""
    return np.where(context_count > 0, np.frexp(np.maximum(context_count, 1))[1], 0)


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.divide(a, b, out=np.zeros_like(a), where=b > 0)


def _held_out_counts(tokens: int):
    """Counts of the deleted part by context bucket and by both probabilities, in half octaves."""

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        if not block.num_rows:
            return CELLS.empty_table()
        b, (pair, pair_own, context, context_own, word, word_own) = _known(block, answers)
        own = b.deleted
        context = (context - context_own)[own]
        p2 = _ratio((pair - pair_own)[own], context)
        p1 = (word - word_own)[own] / max(1, tokens)
        logs = [np.log2(p, out=np.zeros_like(p), where=p > 0) for p in (p2, p1)]
        bins = [np.where(p > 0, 1 - np.round(2 * x), 0).astype(np.int64)
                for p, x in zip((p2, p1), logs, strict=True)]
        key = (bucket_of(context).astype(np.int64) << 20) + (bins[0] << 10) + bins[1]
        cells, place = np.unique(key, return_inverse=True)
        sums = [np.bincount(place, x, len(cells)) for x in (None, *logs)]
        return pa.table({
            "bucket": pa.array(cells >> 20, pa.int32()),
            "pair_bin": pa.array(cells >> 10 & 1023, pa.int32()),
            "word_bin": pa.array(cells & 1023, pa.int32()),
            "n": sums[0].astype(np.float64), "log_pair": sums[1], "log_word": sums[2]},
            schema=CELLS)

    return run


def learn_weights(bucket: np.ndarray, n: np.ndarray, p: np.ndarray, buckets: int = 64,
                  rounds: int = ROUNDS, prior: float = 5.0) -> np.ndarray:
    """Mixture weights per bucket (rows) by expectation-maximisation.

    ``p`` has a column for each probability (pair, word, uniform), ``n`` the held-out counts.
    Every bucket leans on the weights of all buckets together with ``prior`` counts, so a
    bucket without data has those; all weights stay above zero.
    """
    def fit(rows: np.ndarray, start: np.ndarray, lean: np.ndarray) -> np.ndarray:
        w = start
        for _ in range(rounds):
            share = p[rows] * w
            share *= (n[rows] / share.sum(axis=1))[:, None]
            w = share.sum(axis=0) + prior * lean
            w = w / w.sum()
        return w

    even = np.full(3, 1 / 3)
    everything = fit(np.arange(len(n)), even, even)
    out = np.tile(everything, (buckets, 1))
    for k in np.unique(bucket):
        out[k] = fit(np.nonzero(bucket == k)[0], everything, everything)
    return out


def _score(tokens: int, types: int, weights: np.ndarray):
    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        if not block.num_rows:
            return SCORES.empty_table()
        b, (pair, _, context, _, word, _) = _known(block, answers)
        w = weights[bucket_of(context)]
        p = (w[:, 0] * _ratio(pair, context) + w[:, 1] * word / max(1, tokens)
             + w[:, 2] / (types + 1))
        base = np.log10((word + 1) / (tokens + types + 1))
        return pa.table({
            "doc_id": pa.array(b.doc_ids, pa.int64()), "held_out": b.held_out,
            "n_tokens": b.lengths,
            "n_known": np.add.reduceat((word > 0).astype(np.int64), b.starts),
            "train_tokens": np.full(len(b.lengths), tokens, np.int64),
            "base_score": np.add.reduceat(base, b.starts),
            "score": np.add.reduceat(np.log10(p), b.starts)}, schema=SCORES)

    return run


def _bucketed(df: DataFrame, key: str, parts: int) -> tuple[DataFrame, str, str]:
    """``df`` written out bucketed, so that grouping by ``key`` moves nothing any more."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "blocks")
    table = f"blocks_{uuid.uuid4().hex}"
    (df.write.bucketBy(parts, key).option("path", path).option("compression", "zstd")
     .saveAsTable(table))
    return spark.table(table), table, path


def _remove(spark: SparkSession, table: str, path: str) -> None:
    spark.sql(f"DROP TABLE {table}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def model_scores(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", divisor: int = 7,
                 fold: int = 2, block: int = BLOCK, per_range: int = RANGE) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Tokens are words of the text with A-Z lower-cased, then one end. Rows whose crc32 of the
    id modulo ``divisor`` is ``fold`` are held out; all others are learned from. The base is
    the add-one unigram model's log10 probability of the text, the score this model's.
    Null and empty texts have the end alone; repeated rows count and are scored each; a null
    id stays null and counts as the empty text for the remainder. Further columns are not
    read. Without training texts all words are unknown; an empty table gives no rows.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks, table, path = _bucketed(
        tokenised(df, id_col, text_col, divisor, fold, block), "block", parts)
    size = blocks.select(F.expr("aggregate(lengths, 0L, (s, x) -> s + x)").alias("n")).agg(
        F.sum("n")).first()[0] or 0
    ranges = max(1, min(parts, size // 10_000 + 1), -(-size // per_range))
    answers = stage(
        blocks.mapInArrow(_requests(ranges), _sql(REQUESTS))
        .groupBy("kind", "range").applyInArrow(_answer, _sql(ANSWERS)), "answers")
    total = answers.where(F.col("kind") == TOTALS).agg(
        F.sum("tokens"), F.sum("types"), F.sum("deleted_tokens")).first()
    tokens, types, deleted = (int(x or 0) for x in total)
    own = answers.where(F.col("kind") != TOTALS).groupBy("block")
    cells = (blocks.groupBy("block").cogroup(own)
             .applyInArrow(_held_out_counts(tokens - deleted), _sql(CELLS))
             .groupBy("bucket", "pair_bin", "word_bin")
             .agg(F.sum("n").alias("n"), F.sum("log_pair").alias("log_pair"),
                  F.sum("log_word").alias("log_word")).toPandas())
    # A few thousand cells: 64 buckets by half octaves of two probabilities at most.
    n = cells["n"].to_numpy()
    p = np.stack([
        np.where(cells["pair_bin"] > 0, 2.0 ** (cells["log_pair"] / n), 0.0),
        np.where(cells["word_bin"] > 0, 2.0 ** (cells["log_word"] / n), 0.0),
        np.full(len(n), 1 / (types + 1))], axis=1)
    weights = learn_weights(cells["bucket"].to_numpy(), n, p)
    scored = stage(blocks.groupBy("block").cogroup(own).applyInArrow(
        _score(tokens, types, weights), _sql(SCORES)), "scores")
    _remove(spark, table, path)
    return scored
