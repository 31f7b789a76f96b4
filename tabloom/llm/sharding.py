"""Shards that all hold the same mixture of sources, by stratified interleaving.

The rows of each source are shuffled by a seeded hash and ranked; a row's rank as a fraction of
its source tells where it stands in the whole, whatever the source's size. Sorted by
that fraction, any stretch of rows holds every source in its share, and cutting the order into
stretches of equal length gives shards whose row counts differ by one at most.

Both rankings cut their rows into ranges (``ranks``), so that a source with most of the rows
is spread like any other, and only ids, sizes and hashes are moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.functions.checkpoints import stage
from tabloom.llm.common import named, whole_text
from tabloom.llm.ranks import ranked

SEED = "shuffle-1"
OVERHEAD = 16       # bytes of a row besides its text


def interleaved(rows: DataFrame, source: str, shuffle: Column, shards: int) -> DataFrame:
    """``rows`` (written out, so that they have the same order each time) with ``shard`` and
    ``slot``.

    Rows of a source go in the order of ``shuffle``; those with equal values, in the order
    they were read. All columns of ``rows`` are moved twice.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    numbered = rows.withColumns({"__shuffle": shuffle, "__row": F.monotonically_increasing_id()})
    inner, _ = ranked(numbered, [source], ["__shuffle", "__row"], "__rank", "__of")
    fraction = (F.col("__rank") + F.lit(0.5)) / F.col("__of")
    spread, _ = ranked(inner.withColumn("__fraction", fraction), [],
                       ["__fraction", "__shuffle", "__row"], "__at", "__all")
    shard = F.expr(f"__at * {shards}L div __all")
    first = F.expr(f"(shard * __all + {shards - 1}L) div {shards}L")
    return (spread.withColumn("shard", shard).withColumn("slot", F.col("__at") - first)
            .withColumn("shard", F.col("shard").cast("int"))
            .drop("__shuffle", "__row", "__rank", "__of", "__fraction", "__at", "__all"))


def _shuffled(seed: str, id_col: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(named(id_col).cast("string"), F.lit("")))
                 .cast("binary"))


def shard_rows(df: DataFrame, shards: int = 40, seed: str = SEED, id_col: str = "doc_id",
               text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row.

    ``size`` is the UTF-8 bytes of the text and ``OVERHEAD``, ``law`` is ``rows``: shards differ
    by one row at most, hold each source in its share of the table, and slots count up from 0.
    ``grown_shard`` is null, as this law says nothing of one shard more. The
    same table and seed give the same shards. A null text has no bytes; a null source is a
    source; null ids and repeated rows are placed each; texts of any length are read once and
    not moved. With fewer rows than shards, some shards are empty; an empty table gives no
    rows. Other columns are not read.
    """
    text = whole_text(text_col).cast("binary")
    slim = stage(df.select(
        named(id_col).alias("doc_id"), named(source_col).alias("source"),
        (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32")), "sharding")
    placed = interleaved(slim, "source", _shuffled(seed, "doc_id"), shards)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                         "slot", F.lit(None).cast("int").alias("grown_shard"))


def write_shards(df: DataFrame, folder: str, shards: int = 40, seed: str = SEED,
                 id_col: str = "doc_id", source_col: str = "source") -> None:
    """The rows of ``df`` as Parquet below ``folder``, one subfolder ``shard=k`` for each shard.

    Files of a shard follow each other by ``__slot``, which is kept as a column, and so are the
    rows in a file. Whole rows are written out once and moved once, to where
    they are written; a shard of any size is written by several tasks. An empty
    table writes no shard.
    """
    whole = stage(df.select(F.struct(*[named(c) for c in df.columns]).alias("__whole")), "rows")
    whole = whole.withColumn("__number", F.monotonically_increasing_id())
    slim = stage(whole.select(
        F.col("__number").alias("number"), F.col("__whole")[source_col].alias("source"),
        F.col("__whole")[id_col].alias("id")), "sharding")
    placed = interleaved(slim, "source", _shuffled(seed, "id"), shards).select(
        "number", "shard", F.col("slot").alias("__slot"))
    joined = whole.join(placed, F.col("__number") == F.col("number"))
    (joined.select("__whole.*", "__slot", F.col("shard").alias("__shard"))
     .repartitionByRange("__shard", "__slot").sortWithinPartitions("__shard", "__slot")
     .withColumnRenamed("__shard", "shard" if "shard" not in df.columns else "__shard")
     .write.mode("errorifexists")
     .partitionBy("shard" if "shard" not in df.columns else "__shard").parquet(folder))


def read_shard(spark: SparkSession, folder: str, shard: int) -> DataFrame:
    """The rows of one shard in their order."""
    found = spark.read.parquet(folder)
    name = "__shard" if "__shard" in found.columns else "shard"
    return found.where(F.col(name) == shard).orderBy("__slot").drop(name, "__slot")
