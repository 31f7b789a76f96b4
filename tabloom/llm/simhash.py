"""Near duplicates by SimHash fingerprints.

A fingerprint has 64 bits; two of them are linked if at most ``radius`` bits differ.
Pairs are found without comparing all rows: a fingerprint is cut into ``radius + 2``
bands, and two linked ones agree in at least two whole bands, so it is enough to compare
within the buckets of each pair of bands. A bucket with too many fingerprints is dealt
again by further bits, in the same way (two linked ones agree in one of ``radius + 1``
parts of the remaining bits), which loses no pair and bounds every bucket by the number
of bits left. Within a bucket the comparison is bit-sliced: bit planes are stored
vertically, 64 distances are counted at once by carry-save adders, and a block of lanes
is left as soon as all its distances exceed the radius.

Copies share one fingerprint and are counted once, and each block of a bucket gives the
edges of a spanning forest, never all its pairs.

A radius of a few bits only finds texts that hardly differ: at a similarity of 0.8 (of sets of
five-word shingles) about ten bits do, too many for bands. ``similar_documents`` therefore takes
its buckets from minima of shingle hashes, compares bits of these within them by the same
bit-sliced counting at a wide radius (repeats count for nothing), and decides by the sets. With a
``radius`` it links by the fingerprints of ``near_duplicates`` as well.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.functions.checkpoints import release_shuffles, stage
from tabloom.llm.common import named, record_batch, ship
from tabloom.llm.graph import components

BITS = 64
SEED = 42
SHINGLES_AT_ONCE = 1 << 16
BUCKET = 2_048          # fingerprints of a bucket that are compared without dealing again
LANES = 1_024           # fingerprints that are compared at once, at least
ALL = np.uint64(2**64 - 1)

EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def shingle_hashes(text: bytes, width: int) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of all shingles, in blocks; fewer words than ``width`` are one shingle."""
    words = text.lower().split()  # of bytes: A-Z, and space and 9 to 13
    digest, seam = xxhash.xxh64_intdigest, b" ".join
    n = max(1, len(words) - width + 1) if words else 0
    for start in range(0, n, SHINGLES_AT_ONCE):
        part = words[start:min(n, start + SHINGLES_AT_ONCE) + width - 1]
        shingles = map(seam, zip(*(part[i:] for i in range(width)), strict=False)) \
            if len(part) >= width else [seam(part)]
        yield np.array([digest(s, SEED) for s in shingles], np.uint64)


def _majority(blocks: list[np.ndarray] | Iterator[np.ndarray]) -> int:
    """The bits set in over half of the hashes."""
    ones, n = np.zeros(BITS, np.int64), 0
    for hashes in blocks:
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def simhash(text: bytes, width: int = 3) -> int:
    """The SimHash of UTF-8 text: A-Z lower-cased, shingles of ``width`` words.

    Bit k is 1 if it is set in over half of the shingles' XXH64 (seed 42), repeats
    included. Fewer words than ``width`` are one shingle; no word at all gives 0.
    """
    return _majority(shingle_hashes(text, width))


def fingerprint_column(text: Column, width: int = 3) -> Column:
    """The fingerprint of a text column, its 64 bits as a signed long; null counts as empty."""
    ship(SparkSession.active())

    @F.arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        prints = [simhash(t.as_buffer().to_pybytes(), width) for t in texts]
        return pa.array(np.array(prints, np.uint64).view(np.int64))

    return run(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def _mask(bits: list[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - 2**64 if value >= 2**63 else value


def _cut(bits: list[int], parts: int) -> list[list[int]]:
    return [[int(b) for b in p] for p in np.array_split(bits, parts)]


def band_masks(radius: int) -> list[int]:
    """Masks of all pairs of ``radius + 2`` bands."""
    bands = _cut(list(range(BITS)), radius + 2)
    return [_mask(a + b) for a, b in combinations(bands, 2)]


def finer_masks(mask: int, radius: int) -> list[int]:
    """The mask with one of ``radius + 1`` parts of its free bits added."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    return [_mask([b for b in range(BITS) if mask >> b & 1] + p) for p in _cut(free, radius + 1)]


def _buckets(prints: DataFrame, radius: int, bucket: int) -> DataFrame:
    """``mask``, ``value`` (the bits under the mask) and ``fp``: what to compare."""

    def dealt(df: DataFrame, masks) -> DataFrame:
        return (df.select("fp", F.explode(masks).alias("mask"))
                .withColumn("value", F.col("fp").bitwiseAND(F.col("mask"))))

    rows = dealt(prints, F.array(*[F.lit(m).cast("long") for m in band_masks(radius)]))
    found, finer = [], {m: finer_masks(m, radius) for m in band_masks(radius)}
    for _ in range(2):
        large = stage(rows.groupBy("mask", "value").count().where(F.col("count") > bucket)
                      .drop("count"), "buckets")
        if large.isEmpty():
            break
        found.append(rows.join(large, ["mask", "value"], "left_anti"))
        table = F.create_map(*[x for m, parts in finer.items() for x in (
            F.lit(m).cast("long"), F.array(*[F.lit(p).cast("long") for p in parts]))])
        rows = dealt(rows.join(large, ["mask", "value"], "left_semi"), table[F.col("mask")])
        finer = {p: finer_masks(p, radius) for parts in finer.values() for p in parts}
    found.append(rows)
    whole = found[0]
    for part in found[1:]:
        whole = whole.union(part.select(*whole.columns))
    return whole


def planes_of(prints: np.ndarray) -> np.ndarray:
    """Bit planes, 64 rows of packed lanes: bit j of word i of a row is lane 64 i + j."""
    lanes = -(-len(prints) // 64) * 64
    padded = np.zeros(lanes, np.uint64)
    padded[:len(prints)] = prints
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def close_pairs(prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs i < j of (unsigned, distinct) fingerprints at ``radius`` bits or fewer."""
    n = len(prints)
    planes = planes_of(prints)
    words = planes.shape[1]
    counters = max(1, int(radius).bit_length())
    start = (1 << counters) - 1 - radius  # so that a carry leaves the counters beyond the radius
    bit = np.arange(words * 64)
    left, right = [], []
    step = max(64, (1 << 20) // max(1, words))
    for low in range(0, n, step):
        rows = np.arange(low, min(n, low + step))
        # Lanes at or before the row itself, and beyond the last, are left from the start.
        over = np.packbits((bit[None, :] <= rows[:, None]) | (bit[None, :] >= n),
                           axis=1, bitorder="little").view(np.uint64)
        r, w = np.nonzero(over != ALL)
        over = over[r, w]
        flip = np.where(prints[rows][:, None] >> np.arange(BITS, dtype=np.uint64) & np.uint64(1),
                        ALL, np.uint64(0)).T
        count = [np.full(len(r), ALL if start >> k & 1 else 0, np.uint64) for k in range(counters)]
        for k in range(BITS):
            carry = planes[k][w] ^ flip[k][r]
            for c in range(counters):
                count[c], carry = count[c] ^ carry, count[c] & carry
            over |= carry
            if k >= 15 and k % 4 == 3:  # abandon what holds no near lane any more
                alive = np.nonzero(over != ALL)[0]
                if len(alive) < 0.7 * len(r):
                    r, w, over = r[alive], w[alive], over[alive]
                    count = [c[alive] for c in count]
                    if not len(r):
                        break
        if len(r):
            near = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            cell, lane = np.nonzero(near)
            left.append(rows[r[cell]])
            right.append(w[cell] * 64 + lane)
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least member of each one's component."""
    root = np.arange(n)
    while True:
        least = root.copy()
        np.minimum.at(least, i, root[j])
        np.minimum.at(least, j, root[i])
        least = least[least]
        if (least == root).all():
            return root
        root = least


def _compare(radius: int, lanes: int):
    def edges(prints: np.ndarray) -> pa.RecordBatch:
        prints = np.unique(prints)
        i, j = close_pairs(prints.view(np.uint64), radius)
        root = forest(len(prints), i, j)
        child = np.nonzero(root != np.arange(len(prints)))[0]
        return record_batch({"a": prints[child], "b": prints[root[child]]}, EDGES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.empty((0, 3), np.int64)]
        held = 0
        for batch in batches:
            rest.append(np.stack([batch.column(c).to_numpy() for c in ("mask", "value", "fp")], 1))
            held += batch.num_rows
            if held < lanes:
                continue
            rows = np.concatenate(rest)
            ends = np.nonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1))[0] + 1
            begin = 0
            for end in ends:  # whole buckets only
                if end - begin >= lanes:
                    yield edges(rows[begin:end, 2])
                    begin = end
            rest, held = [rows[begin:]], len(rows) - begin
        rows = np.concatenate(rest)
        if len(rows):
            yield edges(rows[:, 2])

    return run


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    *more: Column, width: int = 3, radius: int = 2, bucket: int = BUCKET,
                    lanes: int = LANES) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``, ``kept`` and ``more``
    columns for every row.

    ``component_id`` is the smallest id that can be reached over links, the row's own
    included; one row of each component is ``kept``, one with that id. Null and empty texts
    have fingerprint 0 and are linked like any other. Repeated rows are all returned. A null
    id is never the smallest; a component without any other id has a null ``component_id``.
    An empty table gives no rows. Other columns are only read for ``more``.
    """
    texts = df.select(named(id_col).cast("long").alias("doc_id"),
                      fingerprint_column(named(text_col), width).alias("fp"), *more)
    prints = stage(texts.withColumn("__row", F.monotonically_increasing_id()), "prints")
    classes = stage(_classes(prints, "fp"), "classes")
    labelled = _labelled(prints, classes, _linked(classes.select("fp"), radius, bucket, lanes), "fp")
    rest = [c for c in prints.columns if c not in ("doc_id", "fp", "__row")]
    return labelled.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
        "kept", *[named(c) for c in rest])


def _linked(prints: DataFrame, radius: int, bucket: int, lanes: int) -> DataFrame:
    """``node`` and ``root`` of the distinct fingerprints ``fp`` that are linked to others."""
    found = (_buckets(prints, radius, bucket)
             .repartition(_parts(prints), "mask", "value").sortWithinPartitions("mask", "value")
             .select("mask", "value", "fp")
             .mapInArrow(_compare(radius, lanes), "a long, b long"))
    return stage(components(found), "roots")


def _parts(df: DataFrame) -> int:
    return max(df.sparkSession.sparkContext.defaultParallelism,
               int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _classes(prints: DataFrame, key: str, *same: str) -> DataFrame:
    """One row for all rows of a key, with the first of them; columns ``same`` are equal there."""
    size = [c for c in prints.columns if c == "__size"]
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "__row", *size)
    return prints.groupBy(key).agg(F.min(first).alias("first"),
                                   *[F.any_value(c).alias(c) for c in same])


def _labelled(prints: DataFrame, classes: DataFrame, roots: DataFrame, key: str) -> DataFrame:
    """``prints`` with ``component_id`` and ``kept``, from the components of keys."""
    roots = roots.withColumnRenamed("node", key)
    linked = classes.select(key, "first").join(roots, key)
    whole = linked.groupBy("root").agg(F.min("first").alias("least"))
    known = linked.select(key, "root").join(whole, "root").select(key, "least")
    # Written out, so that the last join has plain exchanges, which can be cut at copies.
    labels = stage(classes.select(key, "first").join(known, key, "left").select(
        key, F.coalesce("least", "first").alias("__least")), "labels")
    return prints.join(labels, key).withColumns({
        "component_id": F.col("__least.doc_id"),
        "kept": F.col("__row") == F.col("__least.__row")})


MINIMA = 128            # minima of a text's shingle hashes, a byte of each kept
ROWS = 4                # minima of a bucket's key
BANDS = 24              # keys of a text: at a similarity of 0.8, 3 pairs in a million share none
WEIGHT = 1 << 16        # bytes from which a text counts as several
CROWD = 512             # different texts of a bucket that are compared in one piece
WIDE = 20               # of 64 bits of minima; at 0.8 one in ten differs, so one pair in 10**6 is lost
SKETCHED = "struct<same: bigint, fp: bigint, keys: array<bigint>, sketch: binary>"


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """The distinct hashes of a text's shingles, in order."""
    return np.unique(np.concatenate([np.empty(0, np.uint64), *shingle_hashes(text, width)]))


def _sketch(text: bytes, width: int, a: np.ndarray,
            b: np.ndarray) -> tuple[int, int, list, bytes]:
    """A hash of the set of shingles, their SimHash, keys, and a byte of each minimum: all of
    the set alone, so that repeats count for nothing."""
    hashes, low = shingle_set(text, width), np.full(MINIMA, 2**32 - 1, np.uint32)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(short), 2048):
        part = short[start:start + 2048]
        np.minimum(low, (a[:, None] * part + b[:, None]).min(axis=1), out=low)
    # The lowest value of many is near zero in its high bits; mix them before a byte is taken.
    mixed = (low * np.uint32(0x9E3779B1)) >> np.uint32(24)
    keys = [xxhash.xxh64_intdigest(low[i * ROWS:(i + 1) * ROWS].tobytes(), i) for i in range(BANDS)]
    blocks = (hashes[k:k + SHINGLES_AT_ONCE] for k in range(0, len(hashes), SHINGLES_AT_ONCE))
    return (xxhash.xxh64_intdigest(hashes.tobytes(), SEED), _majority(blocks), keys,
            mixed.astype(np.uint8).tobytes())


def _bits(sketches: np.ndarray) -> np.ndarray:
    """A bit of each of the last 64 minima: two texts differ in half the share of unequal ones."""
    bits = np.ascontiguousarray(sketches[:, -BITS:] & 1)
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)[:, 0]


def _sketches(text: Column, width: int) -> Column:
    ship(SparkSession.active())
    rng = np.random.default_rng(SEED)
    a = rng.integers(0, 2**31, MINIMA, np.uint32) * np.uint32(2) + np.uint32(1)
    b = rng.integers(0, 2**32, MINIMA, np.uint32)

    @F.arrow_udf(SKETCHED)
    def run(texts: pa.Array) -> pa.Array:
        found = [_sketch(t.as_buffer().to_pybytes(), width, a, b) for t in texts]
        keys = np.array([x[2] for x in found], np.uint64).reshape(-1, BANDS).view(np.int64)
        return pa.StructArray.from_arrays([
            pa.array(np.array([x[0] for x in found], np.uint64).view(np.int64)),
            pa.array(np.array([x[1] for x in found], np.uint64).view(np.int64)),
            pa.array(list(keys), pa.list_(pa.int64())),
            pa.array([x[3] for x in found], pa.binary())], names=["same", "fp", "keys", "sketch"])

    return run(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def _by_key(edges: Callable[[pa.Table], pa.RecordBatch], lanes: int, most: int = 1 << 25):
    """``edges`` of rows sorted by key: of whole keys, ``lanes`` rows or ``most`` bytes at least."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, held, size = [], 0, 0
        for batch in batches:
            rest.append(pa.Table.from_batches([batch]))
            held, size = held + batch.num_rows, size + batch.nbytes
            if held >= lanes or size >= most:
                rows = pa.concat_tables(rest)
                keys = rows.column("key").to_numpy()
                ends = np.nonzero(keys[1:] != keys[:-1])[0] + 1
                step = max(1, min(lanes, most * held // max(1, size)))
                begin = 0
                for end in ends:
                    if end - begin >= step:
                        yield edges(rows.slice(begin, end - begin))
                        begin = end
                rest = [rows.slice(begin)]
                held, size = len(keys) - begin, rest[0].nbytes
        if held:
            yield edges(pa.concat_tables(rest))

    return run


def _candidates(rows: pa.Table, floor: float) -> tuple[np.ndarray, ...]:
    """The ids, the row of each, and pairs with a share of ``floor`` equal minima or more."""
    ids, first = np.unique(rows.column("id").to_numpy(), return_index=True)
    sketches = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint8)
    sketches = sketches.reshape(-1, MINIMA)[first]
    i, j = close_pairs(_bits(sketches), WIDE)
    keep = np.empty(len(i), bool)
    for k in range(0, len(i), 1 << 16):
        same = sketches[i[k:k + (1 << 16)]] == sketches[j[k:k + (1 << 16)]]
        keep[k:k + (1 << 16)] = same.mean(axis=1) >= floor
    return ids, first, i[keep], j[keep]


def _edges_of(ids: np.ndarray, root: np.ndarray) -> pa.RecordBatch:
    child = np.nonzero(root != np.arange(len(ids)))[0]
    return record_batch({"a": ids[child], "b": ids[root[child]]}, EDGES)


def _alike(floor: float):
    """Edges of the candidates among rows ``key, id, sketch``."""
    def edges(rows: pa.Table) -> pa.RecordBatch:
        ids, _, i, j = _candidates(rows, floor)
        return _edges_of(ids, forest(len(ids), i, j))

    return edges


def joined_sets(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray,
                similarity: float) -> np.ndarray:
    """The least member of each one's component, by the pairs of sets that have the similarity.

    Pairs that others have joined are not looked at again.
    """
    root, sizes = np.arange(len(sets)), np.array([len(x) for x in sets], np.int64)
    keep = np.minimum(sizes[i], sizes[j]) >= similarity * np.maximum(sizes[i], sizes[j]) - 1e-9
    i, j = i[keep], j[keep]
    if not len(i):
        return root
    order = np.argsort(i, kind="stable")
    i, j = i[order], j[order]
    used = np.unique(np.concatenate([i, j]))
    known, place = np.unique(np.concatenate([sets[k] for k in used]), return_inverse=True)
    own = dict(zip(used.tolist(), np.split(place, np.cumsum(sizes[used])[:-1]), strict=True))
    mark = np.zeros(len(known), bool)
    heads, starts = np.unique(i, return_index=True)
    for head, others in zip(heads.tolist(), np.split(j, starts[1:]), strict=True):
        others = others[root[others] != root[head]]
        mark[own[head]] = True
        shared = np.array([np.count_nonzero(mark[own[k]]) for k in others.tolist()], np.int64)
        mark[own[head]] = False
        near = others[shared >= similarity * (sizes[head] + sizes[others] - shared) - 1e-9]
        if len(near):
            one = np.unique(root[np.append(near, head)])
            root[np.isin(root, one)] = one[0]
    return root


def _verified(similarity: float, floor: float, width: int):
    """Edges of candidates among rows ``key, id, sketch, text`` whose sets of shingles are alike.

    Sets are made where they are compared: a text takes a fraction of its set's bytes on
    the way there.
    """
    def edges(rows: pa.Table) -> pa.RecordBatch:
        ids, first, i, j = _candidates(rows, floor)
        used, near = np.unique(np.concatenate([i, j]), return_inverse=True)
        texts = rows.column("text")
        sets = [shingle_set(texts[int(k)].as_buffer().to_pybytes(), width) for k in first[used]]
        part = joined_sets(sets, near[:len(i)], near[len(i):], similarity)
        root = np.arange(len(ids))
        root[used] = used[part]
        return _edges_of(ids, root)

    return edges


def _joined(rows: DataFrame, compared: Callable[[DataFrame], DataFrame], crowd: int) -> DataFrame:
    """``node, root`` of what ``compared`` links within the keys of rows ``key, id, n, ...``, where
    ``n`` is the number of a key's rows, or more for heavy ones. No pair of a key is left out.

    Keys of up to ``crowd`` rows are compared whole. Larger ones are first dealt at random into
    chunks of about ``crowd``, twice. What that joins needs no further comparison with each
    other; all other rows are compared with every row of their key, each pair of chunks under a
    key of its own.
    """
    hot = rows.where(F.col("n") > crowd)
    found = rows.where(F.col("n") <= crowd)

    def chunk(salt: int, total) -> Column:
        return F.pmod(F.xxhash64("id", "key", F.lit(salt)), F.ceil(total / crowd))

    if hot.isEmpty():
        return stage(components(compared(found)), "roots")
    for salt in (0, 1):
        found = found.union(hot.withColumn("key", F.xxhash64(
            "key", F.lit(salt), chunk(salt, F.col("n")))))
    roots = stage(components(compared(found)), "roots")
    rooted = stage(hot.select("key", "id", "n").join(
        roots.withColumnRenamed("node", "id"), "id", "left")
        .withColumn("root", F.coalesce("root", "id")), "rooted")
    sizes = rooted.groupBy("key", "root").count()
    left = stage(sizes.groupBy("key").agg(
        F.max_by("root", F.struct("count", "root")).alias("main"),
        (F.sum("count") - F.max("count")).alias("rest"), F.sum("count").alias("all"))
        .where("rest > 0"), "left")
    if left.isEmpty():
        return roots
    rest = F.col("rest") * F.col("n") / F.col("all")
    r, a = F.ceil(rest / crowd), F.ceil(F.col("n") / crowd)
    block = lambda i, j: F.xxhash64("key", F.lit(2), i, j)
    every = F.transform(F.sequence(F.lit(0), r - 1), lambda i: block(i, chunk(2, F.col("n"))))
    others = F.transform(F.sequence(F.lit(0), a - 1), lambda j: block(chunk(3, rest), j))
    blocks = stage(rooted.join(left, "key").select("key", "id", F.when(
        F.col("root") == F.col("main"), every).otherwise(F.array_union(every, others))
        .alias("blocks")), "blocks")
    pairs = (hot.join(blocks, ["key", "id"]).withColumn("key", F.explode("blocks"))
             .select(*rows.columns))
    return stage(components(compared(pairs).union(roots)), "roots")


def _print_edges(own: DataFrame, radius: int, bucket: int, lanes: int) -> DataFrame:
    """Edges ``a, b`` between ids of rows ``__print, __id`` whose fingerprints hang together."""
    roots = _linked(own.select(F.col("__print").alias("fp")).distinct(), radius, bucket, lanes)
    rooted = stage(own.join(roots.withColumnRenamed("node", "__print"), "__print", "left").select(
        "__id", F.coalesce("root", "__print").alias("root")), "rooted")
    least = stage(rooted.groupBy("root").agg(F.min("__id").alias("b")), "least")
    return rooted.join(least, "root").select(F.col("__id").alias("a"), "b").where("a != b")


def similar_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      *more: Column, width: int = 5, similarity: float = 0.8,
                      slack: float = 0.15, crowd: int = CROWD, lanes: int = LANES,
                      again: Column | None = None, radius: int | None = None,
                      print_width: int = 3, bucket: int = BUCKET) -> DataFrame:
    """Like ``near_duplicates``, for texts whose sets of shingles have a similarity (shared by
    all) of ``similarity`` or more: ``doc_id, fingerprint, component_id, kept`` and ``more``.

    Texts that share a key are candidates where the share of 128 equal minima is at most
    ``slack`` below the limit. The candidates that hang together are then compared by their
    whole sets of hashed shingles, made from their texts, which alone decides. Buckets, and groups of candidates, of
    more than ``crowd`` different texts are compared in chunks, each with every other one unless
    that can join nothing more (see ``_joined``). ``again`` tells where the text is among
    ``more``; otherwise it is written out besides. With a ``radius``, rows that ``near_duplicates`` links
    (of ``print_width``, ``radius`` and ``bucket``) hang together too, whatever their sets, and the
    fingerprint returned is that one. Texts without words are alike. Nulls,
    repeated rows, null ids and empty tables as in ``near_duplicates``.
    """
    spark = df.sparkSession
    kept_text = [] if again is not None else [named(text_col).alias("__text")]
    again = F.col("__text") if again is None else again
    texts = df.select(named(id_col).cast("long").alias("doc_id"),
                      _sketches(named(text_col), width).alias("__s"),
                      *([] if radius is None else [
                          fingerprint_column(named(text_col), print_width).alias("__print")]),
                      *kept_text, *more)
    prints = stage(texts.select(
        "*", F.col("__s.same").alias("__id"),
        F.monotonically_increasing_id().alias("__row")), "prints")
    slim = prints.select("doc_id", "__id", "__row", "__s.keys", "__s.sketch",
                         F.coalesce(F.octet_length(again.cast("string")), F.lit(0)).alias("__size"))
    classes = stage(_classes(slim, "__id", "keys", "sketch"), "classes")
    known = classes.withColumnRenamed("__id", "id")
    keyed = known.select(F.explode(F.array_distinct("keys")).alias("key"), "id")
    counts = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    floor = similarity - slack

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition(_parts(df), "key").sortWithinPartitions("key")

    def guessed(rows: DataFrame) -> DataFrame:
        rows = rows.select("key", "id").join(known.select("id", "sketch"), "id")
        return dealt(rows.select("key", "id", "sketch")).mapInArrow(
            _by_key(_alike(floor), lanes), "a long, b long")

    def checked(rows: DataFrame) -> DataFrame:
        return dealt(rows.select("key", "id", "sketch", "text")).mapInArrow(
            _by_key(_verified(similarity, floor, width), lanes), "a long, b long")

    groups = _joined(stage(keyed.join(counts, "key"), "shared"), guessed, crowd)
    release_shuffles(spark)
    wanted = stage(groups.join(known.select(
        F.col("id").alias("node"), "first.__row", "first.__size"), "node")
        .select("__row", F.col("root").alias("key"), F.col("node").alias("id"), "__size"), "wanted")
    # Long texts count for more than one, so that the bytes of a chunk are bounded too.
    weights = stage(wanted.groupBy("key").agg(F.greatest(
        F.count(F.lit(1)), F.ceil(F.sum("__size") / WEIGHT)).alias("n")), "weights")
    whole = F.coalesce(again.cast("string"), F.lit("")).cast("binary")
    rows = stage(prints.select("__row", "__s.sketch", whole.alias("text")).join(
        wanted.join(weights, "key").drop("__size"), "__row").drop("__row"), "texts",
        compression="zstd")
    release_shuffles(spark)
    roots = _joined(rows, checked, crowd)
    release_shuffles(spark)
    if radius is not None:
        own = stage(prints.select("__print", "__id").distinct(), "own")
        roots = stage(components(_print_edges(own, radius, bucket, lanes).union(roots)), "roots")
        release_shuffles(spark)
    labelled = _labelled(prints, classes, roots, "__id")
    rest = [c for c in prints.columns
            if c not in ("doc_id", "__s", "__print", "__id", "__row", "__text")]
    shown = F.col("__s.fp" if radius is None else "__print")
    return labelled.select(
        "doc_id", F.lpad(F.lower(F.hex(shown)), 16, "0").alias("fingerprint"), "component_id",
        "kept", *[named(c) for c in rest])
