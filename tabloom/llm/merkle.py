"""A Merkle manifest of a table: one hash for all rows, and a proof for each.

The rows of a group (a language) are the leaves of a tree of hashes, and the groups' roots the
leaves of one more tree. A proof of a row is what its siblings, its parent's siblings and so on
up to the root hash to; with it, one row can be checked against the root alone.

Proofs are found by pointer jumping: each inner node holds the sibling segment of one level and
a pointer to its parent; joining the nodes with themselves puts the ancestor's segment behind
a node's own and doubles the distance of its pointer, so that log2(height) joins bring
every node to the root. The leaves, which are most of the nodes, wait in the rows of their
parents and take the last jump from there. Digests travel as bytes and are written as
hexadecimal text where they are hashed.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.checkpoints import stage
from tabloom.llm.common import named
from tabloom.llm.ranks import ranked

WIDTH = 8       # children of a node
TOP = -1        # the tree over the trees

EMPTY = "array<struct<left: binary, right: binary>>"


def _hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _joined(digests: Column) -> Column:
    """The digests of an array one after the other, as bytes."""
    return F.aggregate(digests, F.lit(b""), lambda a, d: F.concat(a, d))


def _node(digests: Column) -> Column:
    """The digest of a node over its children's."""
    return F.unhex(F.sha2(_hex(_joined(digests)), 256))


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    """The digest of a row, as bytes: every value as its number of UTF-8 bytes, a colon and
    itself, or as ``-`` where it is null."""
    return F.unhex(F.sha2(F.concat(*[_field(v) for v in values]), 256))


def _step(children: Column, at: Column) -> Column:
    """What lies on both sides of the child at ``at`` (from 0)."""
    return F.struct(
        _joined(F.slice(children, F.lit(1), at)).alias("left"),
        _joined(F.slice(children, at + F.lit(2), F.greatest(
            F.size(children) - at - F.lit(1), F.lit(0)))).alias("right"))


def folded_up(digest: Column, steps: Column) -> Column:
    """The root that a leaf and its sibling segments lead to."""
    return F.aggregate(steps, digest, lambda d, s: F.unhex(F.sha2(
        _hex(F.concat(s["left"], d, s["right"])), 256)))


def _by_place(of: Column) -> Column:
    """The structs of an array in the order of their places."""
    return F.array_sort(of, lambda a, b: (a["place"] - b["place"]).cast("int"))


def _key(tree: Column, level: Column, place: Column) -> Column:
    return F.concat_ws("/", tree.cast("string"), level.cast("string"), place.cast("string"))


def _grown(nodes: DataFrame, level: int) -> tuple[list[DataFrame], DataFrame, int]:
    """Builds trees to their tops, all trees a level at a time.

    ``nodes`` are ``tree, place, count`` (nodes of the tree on this level), ``node, level``
    and ``digest``. Gives the links from nodes to their parents, the tops, and the last level.
    """
    links, tops = [], [nodes.where("count = 1")]
    nodes = nodes.where("count > 1")
    while not nodes.isEmpty():
        parent = F.floor(F.col("place") / WIDTH)
        runs = stage(nodes.groupBy("tree", parent.alias("up_place"), "count").agg(_by_place(
            F.collect_list(F.struct("place", "node", "level", "digest"))).alias("children")), "runs")
        runs = runs.withColumn("up", _key(F.col("tree"), F.lit(level + 1), F.col("up_place")))
        links.append(
            runs.select("up", "children", F.posexplode("children").alias("at", "child")).select(
                "child.node", "child.level", "up",
                F.array(_step(F.col("children.digest"), F.col("at"))).alias("steps")))
        level += 1
        nodes = runs.select(
            "tree", F.col("up_place").alias("place"),
            F.ceil(F.col("count") / WIDTH).alias("count"), F.col("up").alias("node"),
            F.lit(level).alias("level"), _node(F.col("children.digest")).alias("digest"))
        tops.append(nodes.where("count = 1"))
        nodes = nodes.where("count > 1")
    found = tops[0]
    for more in tops[1:]:
        found = found.unionByName(more)
    return links, found, level


def _to_the_root(links: DataFrame) -> DataFrame:
    """``node`` and its ``steps`` to the root, by pointer jumping."""
    reach = 1
    links = stage(links, "links")
    done = links.where("up IS NULL")
    while not (open_ := links.where("up IS NOT NULL")).isEmpty():
        # A pointer of this reach leads at least so many levels up: most nodes are no target.
        ahead = links.where(F.col("level") > reach).select(
            F.col("node").alias("__node"), F.col("up").alias("__up"), F.col("steps").alias("__steps"))
        links = stage(open_.join(ahead, F.col("up") == F.col("__node"), "left").select(
            "node", "level", F.col("__up").alias("up"),
            F.concat("steps", F.coalesce("__steps", F.array().cast(EMPTY))).alias("steps"))
            .unionByName(done), "links")
        done = links.where("up IS NULL")
        reach *= 2
    return links.select("node", "steps")


def merkle_manifest(df: DataFrame, group_col: str, order_col: str, leaf: Column,
                    altered: Column | None = None, *more: Column) -> DataFrame:
    """``leaf, subroot, root`` (hexadecimal), ``steps`` (sibling segments as bytes, level by
    level), ``folded_root`` and ``verified`` of every row, with the group and order column and
    ``more``.

    ``leaf`` is a row's digest as bytes, ``altered`` the one to be checked by the row's proof (the
    same if not given): ``folded_root`` is the root it leads to, ``verified`` tells
    whether that is the true one. In a group leaves ascend by the order column, null first,
    rows with equal values by their digest; groups ascend by name, null first. Repeated rows are
    leaves each. A single leaf is its group's root, a single group's root is the root, and their
    proofs are empty. An empty table gives no rows. Text columns may be of any length: only
    digests are moved. Columns not named are not read.
    """
    rows = stage(df.select(
        named(group_col).alias("__group"), named(order_col).alias("__order"), leaf.alias("__leaf"),
        (leaf if altered is None else altered).alias("__altered"), F.struct(
            F.lit(0).alias("_"), *more).alias("__more")), "leaves")
    rows = rows.withColumn("__row", F.monotonically_increasing_id())
    placed, groups = ranked(rows, ["__group"], ["__order", "__leaf", "__row"], "place", "count")
    trees, _ = ranked(groups, [], ["__group"], "tree", "trees")
    trees = stage(trees, "trees")
    if trees.isEmpty():
        return _told(rows.select(
            "*", F.lit(b"").alias("subroot"), F.array().cast(EMPTY).alias("steps")),
            F.lit(b""), group_col, order_col, more)
    named_trees = trees.select(F.col("__group").alias("__name"), "tree")
    first = placed.join(named_trees, F.col("__group").eqNullSafe(F.col("__name"))).groupBy(
        "tree", F.floor(F.col("place") / WIDTH).alias("place"), "count").agg(_by_place(
            F.collect_list(F.struct("place", "__leaf", "__altered", "__group", "__order", "__more")))
            .alias("leaves"))
    runs = stage(first.withColumn("node", _key(F.col("tree"), F.lit(1), F.col("place"))), "leaf-runs")
    nodes = runs.select(
        "tree", "place", F.ceil(F.col("count") / WIDTH).alias("count"), "node",
        F.lit(1).alias("level"), F.when(F.col("count") == 1, F.col("leaves.__leaf")[0]).otherwise(
            _node(F.col("leaves.__leaf"))).alias("digest"))
    links, tops, level = _grown(nodes, 1)
    tops = stage(tops, "tops")
    above = tops.join(trees.select("tree", F.col("trees").alias("all")), "tree").select(
        F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("place"),
        F.col("all").alias("count"), "node", "level", "digest")
    over, root, _ = _grown(above, level)
    top = root.first()      # one row
    ends = root.select("node", "level", F.lit(None).cast("string").alias("up"),
                       F.array().cast(EMPTY).alias("steps"))
    for more_links in (*links, *over):
        ends = ends.unionByName(more_links)
    paths = _to_the_root(ends)
    found = runs.join(paths, "node").join(
        tops.select("tree", F.col("digest").alias("subroot")), "tree")
    own = F.when(F.col("count") == 1, F.array().cast(EMPTY)).otherwise(
        F.array(_step(F.col("leaves.__leaf"), F.col("at"))))
    rows = found.select("*", F.posexplode("leaves").alias("at", "own")).select(
        "own.*", "subroot", F.concat(own, F.col("steps")).alias("steps"))
    return _told(rows, F.lit(bytes(top["digest"])), group_col, order_col, more)


def _told(rows: DataFrame, root: Column, group_col: str, order_col: str,
          more: tuple[Column, ...]) -> DataFrame:
    """The columns of the manifest."""
    inner = rows.schema["__more"].dataType.names[1:]
    ahead = rows.withColumn("__folded", folded_up(F.col("__altered"), F.col("steps")))
    return ahead.select(
        F.col("__group").alias(group_col), F.col("__order").alias(order_col),
        *[F.col("__more")[n].alias(n) for n in inner],
        _hex(F.col("__leaf")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"),
        _hex(root).alias("root"), "steps", _hex(F.col("__folded")).alias("folded_root"),
        (F.col("__folded") == root).alias("verified"))


def proof_digest(steps: Column) -> Column:
    """The hash of all siblings of a proof, from the leaf to the root and left to right."""
    whole = F.aggregate(steps, F.lit(b""), lambda a, s: F.concat(a, s["left"], s["right"]))
    return F.sha2(_hex(whole), 256)


def document_manifest(df: DataFrame) -> DataFrame:
    """The manifest of a documents table by language, with a third of the rows tampered with.

    Where 3 divides crc32 of the id as text, the altered leaf is that of the row with A-Z of its
    text in lower case; a row with a null id is never altered.
    """
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0,
                        F.lit(False))
    values = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaf = leaf_digest(*values, F.col("text"))
    altered = F.when(chosen, leaf_digest(*values, lower)).otherwise(leaf)
    found = merkle_manifest(df, "lang", "doc_id", leaf, altered)
    return found.select("doc_id", "lang", "leaf", "subroot", "root",
                        proof_digest(F.col("steps")).alias("proof_sha256"), "folded_root", "verified")
