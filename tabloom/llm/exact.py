"""Exact duplicates by progressive refinement.

Texts are equal when identical after lower-casing A-Z. Rows are grouped by length, and
within a length by a hash of their beginning; only rows of groups with two members or more
are read to the end and hashed in full, and only those hashes are shuffled. Which groups
have two members is known to every task as a bitmap of fixed size: a group that is not in it
has one member for certain, and one that is in it by chance only costs a hash more.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.checkpoints import stage
from tabloom.llm.common import named, whole_text

PREFIX = 256            # characters that the first hash covers
WORDS = 1 << 16         # longs of the bitmap: 4 million groups, half a megabyte
BITS = 64


def folded(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def text_digest(text: Column) -> Column:
    return F.sha2(folded(text), 256)


def _slot(size: Column, start: Column) -> Column:
    return F.pmod(F.xxhash64(size, start), F.lit(WORDS * BITS))


def bitmap(slots: DataFrame, column: str) -> Column:
    """A constant array of ``WORDS`` longs in which the slots' bits are set."""
    words = (slots.groupBy((F.col(column) % WORDS).alias("word"))
             .agg(F.expr(f"bit_or(shiftleft(1L, cast({column} div {WORDS} AS int)))").alias("bits")))
    # At most `WORDS` rows of two numbers.
    values = ["0"] * WORDS
    for word, bits in words.collect():
        values[word] = str(bits)
    return F.from_json(F.lit("[" + ",".join(values) + "]"), "array<bigint>")


def contains(bits: Column, slot: Column) -> Column:
    word = F.element_at(bits, (slot % WORDS + 1).cast("int"))
    return F.getbit(word, F.floor(slot / WORDS).cast("int")) == 1


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     *more: Column) -> DataFrame:
    """``doc_id, keep_id, group_size, kept`` of every row, and ``more`` columns.

    Of equal texts the row with the largest id stays; of rows with that id and text, one
    stays. A null text is the empty text. A null id is smaller than any other; where all ids
    of a group are null, ``keep_id`` is null. An empty table gives no rows. Other columns are
    only read for ``more``.
    """
    texts = df.select(named(id_col).alias("doc_id"), whole_text(text_col).alias("__text"), *more)
    sized = texts.withColumns({
        "__size": F.octet_length("__text"),
        "__start": F.xxhash64(folded(F.substring("__text", 1, PREFIX)))})
    # By length and beginning at once: both come from one reading.
    groups = sized.groupBy("__size", "__start").count().where(F.col("count") > 1)
    several = bitmap(groups.select(_slot(F.col("__size"), F.col("__start")).alias("slot")).distinct(),
                     "slot")
    marked = sized.withColumn("__several", contains(several, _slot(F.col("__size"), F.col("__start"))))
    names = [c for c in texts.columns if c != "__text"]
    rows = stage(
        marked.withColumn("__whole", F.when(F.col("__several"), text_digest(F.col("__text"))))
        .select(*[named(n) for n in names], "__size", "__whole",
                F.monotonically_increasing_id().alias("__row")), "exact")
    alone = rows.where("__whole IS NULL").select(
        *[named(n) for n in names], F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    shared = rows.where("__whole IS NOT NULL")
    # Written out, so that the join has plain exchanges, which can be cut at copies.
    best = stage(shared.groupBy("__whole", "__size").agg(
        F.max(F.struct("doc_id", "__row")).alias("__best"),
        F.count(F.lit(1)).alias("group_size")), "exact")
    joined = shared.join(best, ["__whole", "__size"]).select(
        *[named(n) for n in names], F.col("__best.doc_id").alias("keep_id"), "group_size",
        (F.col("__row") == F.col("__best.__row")).alias("kept"))
    return alone.unionByName(joined)
