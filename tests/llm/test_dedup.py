"""Exact and near duplicates, and document fingerprints."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from llm_helpers import EDGE_TEXTS, edges, nothing, rows_of  # noqa: F401
from tabloom.llm import imatch
from tabloom.llm.exact import exact_duplicates, text_digest
from tabloom.llm.graph import components
from tabloom.llm.simhash import (
    _joined, band_masks, close_pairs, finer_masks, forest, near_duplicates, similar_documents, simhash,
)


def slow_simhash(text, width=3):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    shingles = shingles if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [t or "" for t in EDGE_TEXTS])
def test_simhash(text):
    assert simhash(text.encode()) == slow_simhash(text)


@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 700])
@pytest.mark.parametrize("radius", [0, 1, 2, 5])
def test_close_pairs(n, radius):
    rng = np.random.default_rng(n)
    prints = rng.integers(0, 2**63, n, np.uint64)
    near = prints[: n // 2] ^ (np.uint64(1) << rng.integers(0, 64, n // 2).astype(np.uint64))
    prints = np.unique(np.concatenate([prints, near, near ^ np.uint64(8)]))
    want = {(i, j) for i in range(len(prints)) for j in range(i + 1, len(prints))
            if bin(int(prints[i] ^ prints[j])).count("1") <= radius}
    assert set(zip(*map(np.ndarray.tolist, close_pairs(prints, radius)), strict=True)) == want


def test_masks_lose_no_pair():
    rng = random.Random(1)
    for _ in range(300):
        change = sum({1 << rng.randrange(64) for _ in range(2)})
        agree = [m for m in band_masks(2) if not change & m % 2**64]
        assert agree
        for m in agree:
            assert any(not change & f % 2**64 for f in finer_masks(m, 2))


def test_forest_and_components(spark):
    rng = np.random.default_rng(2)
    i, j = rng.integers(0, 400, 330), rng.integers(0, 400, 330)
    root = forest(400, i, j)
    edges = spark.createDataFrame(list(zip(i.tolist(), j.tolist(), strict=True)), "a long, b long")
    found = {r["node"]: r["root"] for r in components(edges).collect()}
    for a, b in zip(i, j, strict=True):
        if a != b:
            assert found[a] == found[b] == root[a] == root[b]


def brute_components(rows, linked):
    """Smallest id of each row's component."""
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if linked(rows[a], rows[b]):
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    return [min((r[0] for r, m in zip(rows, label, strict=True) if m == k and r[0] is not None),
                default=None) for k in label]


@pytest.mark.parametrize("bucket", [2_048, 3])
def test_near_duplicates(spark, bucket):
    rng = random.Random(5)
    rows = []
    for base in range(12):
        words = [f"w{rng.randrange(3000)}" for _ in range(900)]
        for copy in range(6):
            rows.append((len(rows) * 7 % 101, " ".join(words)))
            words[rng.randrange(900)] = "changed"
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in near_duplicates(df, bucket=bucket, lanes=8).collect()}
    want = brute_components([(i, slow_simhash(t)) for i, t in rows],
                            lambda a, b: bin(a[1] ^ b[1]).count("1") <= 2)
    for (i, text), least in zip(rows, want, strict=True):
        assert found[i]["fingerprint"] == f"{slow_simhash(text):016x}"
        assert found[i]["component_id"] == least
        assert found[i]["kept"] == (i == least)


def test_near_duplicates_of_odd_rows(edges, nothing):
    assert near_duplicates(nothing).count() == 0
    found = near_duplicates(edges, "doc_id", "text", F.col("fp").alias("own")).collect()
    assert len(found) == edges.count()
    assert {r["own"] for r in found} == {1}
    zero = [r for r in found if r["fingerprint"] == "0" * 16]
    assert {r["doc_id"] for r in zero} == {3, 4, 5, None} and {r["component_id"] for r in zero} == {3}
    assert sum(r["kept"] for r in zero) == 1
    same = [r for r in found if r["component_id"] == 0]
    assert len(same) == 4 and sum(r["kept"] for r in same) == 1


def test_similar_documents(spark, edges, nothing):
    assert similar_documents(nothing).count() == 0
    found = similar_documents(edges).collect()
    assert len(found) == edges.count()
    assert [r["component_id"] for r in found if r["doc_id"] in (0, 1, 2)] == [0] * 4
    rng = random.Random(6)
    rows = []
    for base in range(30):
        words = [f"w{rng.randrange(5000)}" for _ in range(300)]
        rows.append((2 * base, " ".join(words)))
        for k in rng.sample(range(300), 4):
            words[k] = "changed"
        rows.append((2 * base + 1, " ".join(words)))
    got = similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: i // 2 * 2 for i, _ in rows}


def test_a_large_group_of_near_copies(spark):
    """Buckets are far beyond what is compared at once, and the group stays one group."""
    rng = random.Random(7)
    words, rows = [f"w{rng.randrange(5000)}" for _ in range(400)], []
    for i in range(300):
        own = list(words)
        for k in rng.sample(range(400), 3):
            own[k] = f"changed{rng.randrange(100)}"
        rows.append((i, " ".join(own)))
    rows += [(1000 + i, " ".join(f"w{rng.randrange(5000)}" for _ in range(200))) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in similar_documents(df, crowd=20).collect()}
    assert got == {i: 0 if i < 300 else i for i, _ in rows}


def test_pairs_of_a_crowded_bucket(spark):
    """All rows share one key, and each pair that is linked meets whichever chunks it is dealt to."""
    linked = {(k, k + 500) for k in range(500)} | {(2000 + k, 2001 + k) for k in range(300)}
    ids = [*range(1000), *range(2000, 2301)]
    rows = spark.createDataFrame([(7, i, len(ids)) for i in ids], "key long, id long, n long")
    links = spark.createDataFrame(sorted(linked), "a long, b long")

    def compared(rows):
        b = rows.select("key", F.col("id").alias("b"))
        return (rows.select("key", F.col("id").alias("a")).join(links, "a").join(b, ["key", "b"])
                .select("a", "b"))

    found = {r["node"]: r["root"] for r in _joined(rows, compared, crowd=40).collect()}
    assert found == {i: i % 500 if i < 1000 else 2000 for i in ids}


def test_repeats_count_for_nothing(spark):
    """Equal sets, and sets that hardly differ, with a line that comes twice or 101 times."""
    rng, rows = random.Random(8), []
    for base in range(20):
        words = [f"w{rng.randrange(50_000)}" for _ in range(1000)]
        line = [f"x{rng.randrange(50_000)}" for _ in range(12)]
        for copy, (repeats, end) in enumerate([(2, "end"), (101, "end"), (101, "other")]):
            rows.append((3 * base + copy, " ".join([*words, *line * repeats, end])))
    got = similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: i // 3 * 3 for i, _ in rows}


@pytest.mark.parametrize("crowd", [512, 40])
def test_sets_decide_at_the_limit(spark, crowd):
    """Lone pairs at 80 of 100 shingles go together, pairs at 79 of 100 do not."""
    rng, rows, want = random.Random(9), [], {}
    for base in range(0, 600, 2):
        kept, own = (80, 10) if base % 4 else (79, 10)
        words = [f"w{rng.randrange(50_000)}" for _ in range(kept + 4)]
        for i, more in ((base, own), (base + 1, 100 - kept - own)):
            rows.append((i, " ".join(words + [f"{i}x{k}" for k in range(more)])))
            want[i] = base if kept == 80 else i
    # A template: 78% of the shingles shared by all, which is 0.64 alike.
    words = [f"t{k}" for k in range(160)]
    for i in range(1000, 1100):
        rows.append((i, " ".join(words + [f"{i}y{k}" for k in range(44)])))
        want[i] = i
    for i in range(1100, 1150):
        rows.append((i, rows[-100][1].replace(f"{i - 100}y43", "other")))
        want[i] = i - 100
    got = similar_documents(spark.createDataFrame(rows, "doc_id long, text string"), crowd=crowd)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == want


def test_the_pipeline_links_by_simhash_too(spark):
    """Fingerprints link what sets do not, sets what fingerprints do not, and both make one group."""
    rng = random.Random(10)
    words = lambda n: [f"w{rng.randrange(50_000)}" for _ in range(n)]
    line, rows = words(13) * 200, {9: " ".join(words(300))}
    rows[1], rows[2] = (" ".join(line + words(30)) for _ in range(2))
    rows[3] = " ".join(line[13:13 * 90] + rows[2].split()[2600:] + ["end"])
    base = words(300)
    rows[5] = " ".join(base)
    rows[6] = " ".join(w if k % 50 else f"x{k}" for k, w in enumerate(base))

    def apart(a, b):
        return bin(slow_simhash(rows[a]) ^ slow_simhash(rows[b])).count("1")

    def alike(a, b):
        x, y = ({tuple(rows[i].split()[k:k + 5]) for k in range(len(rows[i].split()) - 4)} for i in (a, b))
        return len(x & y) / len(x | y)

    assert apart(1, 2) <= 2 and alike(1, 2) < 0.8
    assert apart(5, 6) > 2 and alike(5, 6) >= 0.8 and alike(2, 3) >= 0.8
    df = spark.createDataFrame([(i, t) for i, t in rows.items()], "doc_id long, text string")
    left = corpus_pipeline.drop_near_copies(spark, df, "")
    assert {r["doc_id"]: r["text"] for r in left.collect()} == {i: rows[i] for i in (1, 5, 9)}
    found = {r["doc_id"]: r for r in similar_documents(df, radius=2, bucket=1, lanes=2).collect()}
    assert {i: r["component_id"] for i, r in found.items()} == {1: 1, 2: 1, 3: 1, 5: 5, 6: 5, 9: 9}
    assert all(r["fingerprint"] == f"{slow_simhash(rows[i]):016x}" for i, r in found.items())
    # Without the fingerprints, or without the sets, a pair stays apart.
    assert {r["component_id"] for r in similar_documents(df).collect()} == {1, 2, 5, 9}


def test_the_pipeline_on_odd_rows(edges, nothing, spark):
    assert similar_documents(nothing, radius=2).count() == 0
    found = similar_documents(edges, radius=2).collect()
    assert len(found) == edges.count()
    assert sum(r["kept"] for r in found) == len({r["component_id"] for r in found})


def test_exact_duplicates(edges, nothing):
    assert exact_duplicates(nothing).count() == 0
    found = rows_of(exact_duplicates(edges, "doc_id", "text", F.col("kept").alias("own"),
                                     text_digest(F.coalesce("text", F.lit(""))).alias("digest")),
                    "doc_id", "digest")
    rows = [(r["doc_id"], (r["text"] or "")) for r in edges.collect()]
    fold = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    groups = {}
    for i, t in rows:
        groups.setdefault(hashlib.sha256(fold(t).encode()).hexdigest(), []).append(i)
    assert len(found) == len(rows)
    for r in found:
        ids = groups[r["digest"]]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == max((i for i in ids if i is not None), default=None)
        assert r["own"] is False
    assert sum(r["kept"] for r in found) == len(groups)


def test_edited_likeness(spark, edges, nothing):
    assert imatch.edited_likeness(nothing, ranges=3).count() == 0
    rows = [(r["doc_id"], r["text"] or "") for r in edges.collect()]
    order = sorted(rows, key=lambda r: ((-1 if r[0] is None else r[0]), r[1].encode()), reverse=True)
    want = []
    for k, (i, t) in enumerate(order):
        after, cut = order[(k + 1) % len(order)][1], len(t) // 3
        edited = t[:len(t) - cut] + after[:cut]
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    for ranges in (1, 4):
        got = imatch.edited_likeness(edges, ranges=ranges).collect()
        assert sorted(((r[0], r[1], r[2]) for r in got), key=str) == sorted(want, key=str)
        for r in got:
            assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
            if r["fingerprint"] == r["edited_fingerprint"]:
                assert r["near_edited"] == 1
        prints = {}
        for r in got:
            prints.setdefault(r["doc_id"], set()).add(r["fingerprint"])
        assert prints[0] == prints[1] and prints[3] == prints[4]


def spark_hash(values):
    """Spark's 32-bit Murmur3 hash of an array of longs, written plainly."""
    m = 2**32 - 1
    turn = lambda x, r: (x << r | x >> (32 - r)) & m
    h = 42
    for value in values:
        for k in (value & m, value >> 32 & m):
            h ^= turn(k * 0xcc9e2d51 & m, 15) * 0x1b873593 & m
            h = (turn(h, 13) * 5 + 0xe6546b64) & m
        h ^= 8
        h = (h ^ h >> 16) * 0x85ebca6b & m
        h = (h ^ h >> 13) * 0xc2b2ae35 & m
        h ^= h >> 16
    return h


def slow_prints(texts, of, low=0.7, high=10.0):
    """Fingerprints of the texts ``of``, with the lexicon of ``texts``."""
    def words(text):
        return {xxhash.xxh64_intdigest(w.encode(), 42)
                for w in re.split("[ \t-\r]+", text.lower()) if w}
    counts = Counter(w for t in texts for w in words(t))
    known = {w for w, n in counts.items()
             if len(texts) / math.exp(high) <= n <= len(texts) / math.exp(low)}
    bits = 1 << max(16, math.ceil(math.log2(max(1, 32 * len(known)))))
    places = lambda w: {w % bits, (w >> 32) % bits}
    marked = {p for w in known for p in places(w)}
    for text in of:
        # The order of signed numbers.
        own = sorted((w for w in words(text) if places(w) <= marked), key=lambda w: w ^ 1 << 63)
        hashes = []
        for k in range(32):
            for level in range(4):
                inside = [w for w in own if w >> 59 == k and
                          (w >> (59 - 2 * level)) % 4**level == 0]
                hashes.append("%08X" % spark_hash(inside) if inside else "")
        whole = "" if own else "%X" % xxhash.xxh64_intdigest(text.lower().encode(), 42)
        yield hashes, whole


def slow_likeness(a, b):
    pairs = [(x, y) for x, y in zip(a[0], b[0], strict=True) if x or y]
    if pairs:
        return sum(x == y for x, y in pairs) / len(pairs)
    return float(a[1] == b[1])


@pytest.mark.parametrize("which", ["edges", "documents"])
def test_fingerprints_by_brute_force(request, table, which):
    df = table("documents") if which == "documents" else request.getfixturevalue("edges")
    rows = [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]
    rows.sort(key=lambda r: (-2**63 if r[0] is None else r[0], r[1].encode()), reverse=True)
    texts = [t for _, t in rows]
    edited = [t[:len(t) - len(t) // 3] + after[:len(t) // 3]
              for t, after in zip(texts, texts[1:] + texts[:1], strict=True)]
    own, new = list(slow_prints(texts, texts)), list(slow_prints(texts, edited))
    as_text = lambda p: ",".join(p[0]) + ":" + p[1]
    want = [(i, as_text(a), as_text(b), slow_likeness(a, b), slow_likeness(a, after))
            for (i, _), a, b, after in zip(rows, own, new, own[1:] + own[:1], strict=True)]
    found = imatch.edited_likeness(df).select(
        "doc_id", "fingerprint", "edited_fingerprint", "near_edited", "near_next").collect()
    key = lambda r: (str(r[0]), *r[1:])
    for got, expected in zip(sorted(map(tuple, found), key=key), sorted(want, key=key), strict=True):
        assert got[:3] == expected[:3] and got[3:] == pytest.approx(expected[3:])


def test_one_changed_term_of_a_long_text_is_seen(spark):
    long = " ".join(f"w{k}" for k in range(5_000))
    texts = [long, long.replace("w77 ", "x77 "), long, *(f"other {k}" for k in range(9))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["fingerprint"] for r in imatch.fingerprints(df).collect()}
    assert found[0] == found[2] != found[1]
    one, other = (f.split(":")[0].split(",") for f in (found[0], found[1]))
    assert 0.9 < sum(a == b for a, b in zip(one, other, strict=True)) / 128 < 1
