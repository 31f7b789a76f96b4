"""Shards and the Merkle manifest against plain versions."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import DATA
from llm_helpers import edges, nothing  # noqa: F401
from tabloom.functions.checkpoints import scratch_path
from tabloom.llm.merkle import document_manifest, leaf_digest, merkle_manifest
from tabloom.llm.queries import QUERIES
from tabloom.llm.ranks import ranked
from tabloom.llm.sharding import read_shard, shard_rows, write_shards


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(digests):
    """The root, and for each leaf its path: (siblings before, siblings after) per level."""
    paths = [[] for _ in digests]
    owners = [[i] for i in range(len(digests))]
    while len(digests) > 1:
        above, above_owners = [], []
        for start in range(0, len(digests), 8):
            run = digests[start:start + 8]
            for k, owned in enumerate(owners[start:start + 8]):
                for i in owned:
                    paths[i].append((run[:k], run[k + 1:]))
            above.append(h("".join(run)))
            above_owners.append([i for owned in owners[start:start + 8] for i in owned])
        digests, owners = above, above_owners
    return digests[0], paths


def slow_manifest(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), r))
    names = sorted(groups, key=lambda n: (n is not None, (n or "").encode()))
    subs = {n: tree([x[2] for x in sorted(groups[n], key=lambda x: x[:3])]) for n in names}
    root, upper = tree([subs[n][0] for n in names])
    out = []
    for n, above in zip(names, upper, strict=True):
        for (_, _, own, r), path in zip(sorted(groups[n], key=lambda x: x[:3]), subs[n][1],
                                        strict=True):
            path = path + above
            proof = h("".join(s for before, after in path for s in (*before, *after)))
            i = r["doc_id"]
            at = own
            if i is not None and zlib.crc32(str(i).encode()) % 3 == 0 and r["text"] is not None:
                at = leaf(r, lowered(r["text"]))
            for before, after in path:
                at = h("".join([*before, at, *after]))
            out.append((i, own, subs[n][0], root, proof, at, at == root))
    return Counter(out)


MANIFEST = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def told(df):
    return Counter(tuple(r[c] for c in MANIFEST) for r in df.collect())


def test_manifest_query(spark, table):
    want = slow_manifest(table("documents").collect())
    assert told(QUERIES["op13_merkle"](spark, DATA)) == want
    assert {v for *_, v in want} == {True, False}


@pytest.mark.parametrize("n", [1, 7, 8, 9, 65])
def test_manifest_of_few_rows(spark, table, n):
    rows = table("documents").orderBy("doc_id").limit(n).withColumn(
        "lang", F.when(F.col("doc_id") < 3, F.col("lang")).when(F.col("doc_id") < 5, F.lit("zh")))
    assert told(document_manifest(rows)) == slow_manifest(rows.collect())
    one = rows.withColumn("lang", F.lit("en"))
    assert told(document_manifest(one)) == slow_manifest(one.collect())


def test_manifest_of_many_groups(spark):
    rows = spark.range(300).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("T"), "id").alias("text"),
        F.concat(F.lit("l"), F.col("id") % 130).alias("lang"), F.lit(None).cast("string").alias(
            "source"), F.lit(3).alias("n_chars"))
    assert told(document_manifest(rows)) == slow_manifest(rows.collect())


def test_manifest_edges(spark, edges, nothing):
    assert told(document_manifest(edges)) == slow_manifest(edges.collect())
    assert document_manifest(nothing).count() == 0
    odd = edges.withColumn("lang", F.when(F.length("text") > 20, F.lit("é")).when(
        F.length("text") > 3, F.lit("z")))
    assert told(document_manifest(odd)) == slow_manifest(odd.collect())


def test_manifest_of_other_tables(spark, table):
    found = merkle_manifest(table("nation"), "n_regionkey", "n_nationkey",
                            leaf_digest(F.col("n_nationkey"), F.col("n_name")), None,
                            F.col("n_name"), F.lit(1).alias("one"))
    rows = found.collect()
    assert len(rows) == 25 and all(r["verified"] and r["one"] == 1 for r in rows)
    assert {r["n_name"] for r in rows} == {r["n_name"] for r in table("nation").collect()}


def shard_counts(rows, shards):
    held = defaultdict(list)
    for r in rows:
        held[r["shard"]].append(r["slot"])
    for slots in held.values():
        assert sorted(slots) == list(range(len(slots)))
    sizes = [len(held[k]) for k in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and set(held) <= set(range(shards))


def slow_shards(rows, shards, seed):
    """Shards by the definition: shuffled ranks within each source, as fractions."""
    def shuffled(r):
        return hashlib.md5(f"{seed}:{'' if r['doc_id'] is None else r['doc_id']}".encode()).hexdigest()

    sources = defaultdict(list)
    for r in rows:
        sources[r["source"]].append(r)
    order = []
    for own in sources.values():
        own.sort(key=shuffled)
        order += [((k + 0.5) / len(own), shuffled(r), r) for k, r in enumerate(own)]
    order.sort(key=lambda x: x[:2])
    return {r["doc_id"]: k * shards // len(order) for k, (_, _, r) in enumerate(order)}


def test_shards_query(spark, table):
    docs = {r["doc_id"]: r for r in table("documents").collect()}
    rows = QUERIES["op12_sharding"](spark, DATA).collect()
    assert len(rows) == len(docs)
    shard_counts(rows, 40)
    assert {r["doc_id"]: r["shard"] for r in rows} == slow_shards(
        [r.asDict() for r in docs.values()], 40, "shuffle-1")
    for r in rows:
        text = (docs[r["doc_id"]]["text"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(text) + 16, zlib.crc32(text))
        assert r["law"] == "rows" and r["grown_shard"] is None


def test_every_shard_holds_the_mixture(spark):
    rows = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.expr(
            "CASE WHEN id % 10 < 6 THEN 'hot' WHEN id % 10 < 9 THEN 'some' END").alias("source"))
    found = shard_rows(rows, 16).join(rows, "doc_id").groupBy("shard", "source").count().collect()
    share = {"hot": 0.6, "some": 0.3, None: 0.1}
    assert len(found) == 48
    assert all(abs(r["count"] - share[r["source"]] * 1_250) <= 3 for r in found)


def test_shards_edges(spark, edges, nothing):
    for shards in (1, 3, 40):
        rows = shard_rows(edges, shards).collect()
        assert len(rows) == edges.count()
        shard_counts(rows, shards)
    assert shard_rows(nothing).count() == 0
    with pytest.raises(ValueError):
        shard_rows(edges, 0)
    same = edges.select("doc_id", "source", "text").withColumn("doc_id", F.lit(7))
    shard_counts(shard_rows(same, 5).collect(), 5)


def test_written_shards(spark, table):
    docs = table("documents")
    folder = scratch_path(spark, "shards")
    write_shards(docs, folder, 7)
    want = sorted((r["shard"], r["slot"], r["doc_id"]) for r in shard_rows(docs, 7).collect())
    found = []
    for k in range(7):
        rows = read_shard(spark, folder, k)
        assert rows.columns == docs.columns
        found += [(k, slot, r["doc_id"]) for slot, r in enumerate(rows.collect())]
    assert found == want
    clash = scratch_path(spark, "shards")
    write_shards(docs.withColumn("shard", F.lit("mine")), clash, 3)
    assert {r["shard"] for r in read_shard(spark, clash, 1).collect()} == {"mine"}


def test_ranks(spark):
    rows = spark.range(5_000).select(F.when(F.col("id") % 3 > 0, F.lit("a")).alias("g"),
                                     (F.col("id") % 50).alias("v"), F.col("id").alias("row"))
    found, groups = ranked(rows, ["g"], ["v", "row"])
    own = defaultdict(list)
    for r in rows.collect():
        own[r["g"]].append((r["v"], r["row"]))
    want = {(g, *x): (k, len(xs)) for g, xs in own.items() for k, x in enumerate(sorted(xs))}
    assert {(r["g"], r["v"], r["row"]): (r["place"], r["size"]) for r in found.collect()} == want
    assert {r["g"]: r["size"] for r in groups.collect()} == {g: len(x) for g, x in own.items()}
