"""Document fingerprints by I-Match over randomised lexicon subsets.

The lexicon is the terms whose inverse document frequency lies in a band. It is cut at random
into ``SUBSETS`` large subsets that together hold all of it; of each there are thinner ones, with a
random quarter of its terms, a quarter of those, and so on, ``LEVELS`` in all. A fingerprint is one
hash for each subset and level: of the document's distinct terms in it, sorted. The large
subsets rest on every term of the band, so that one changed term changes a hash; the thin ones
are what long texts still have in common after an edit. Subsets are the same for all documents.

Document frequencies are counted for all documents, by 64-bit hashes of the terms. The lexicon is
then marked in a bitmap, two bits for a term. It is bounded by the band, whatever the number of
documents: a term with an inverse document frequency of 10 or less is in one of e^10 documents,
so that there are at most e^10 times as many as a document has distinct terms on average.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabloom.functions.checkpoints import stage
from tabloom.llm.common import named, whole_text

SUBSETS = 32            # as many as five bits of a term's hash tell apart
LEVELS = 4              # each with a quarter of the terms of the one before
BAND = (0.7, 10.0)      # inverse document frequencies (natural logarithms) of the lexicon
ROOM = 32               # bits of the bitmap for a term at least: 0.4 % of other terms are taken in
RANGE_ROWS = 50_000     # rows of a range of ids, about
NOTHING = 42            # Spark's hash of an empty array
WHITE = "[ \\t-\\r]+"


def terms(text: Column) -> Column:
    """Hashes of the distinct lower-cased words."""
    hashed = F.transform(F.split(F.lower(text), WHITE), lambda w: F.xxhash64(w))
    return F.array_remove(F.array_distinct(hashed), F.xxhash64(F.lit("")))


class Lexicon:
    """A set of hashed terms, as a constant bitmap.

    A term that was not marked is taken for one with a chance of 0.4 %, in all documents alike.
    """

    def __init__(self, marked: DataFrame):
        size = marked.count()
        self.bits = 1 << max(16, math.ceil(math.log2(max(1, size * ROOM))))
        places = marked.select(F.explode(F.array(*self.places(F.col("term")))).alias("place"))
        set_ = places.select(F.shiftrightunsigned("place", 6).alias("word"),
                             F.expr("shiftleft(1L, cast(place & 63 AS int))").alias("bits"))
        empty = marked.sparkSession.range(self.bits // 64).select(
            F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits"))
        words = stage(set_.union(empty).groupBy("word").agg(F.bit_or("bits").alias("bits")), "words")
        # One long for each term of the lexicon at most, which the band bounds.
        listed = words.agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("w"))
        self.words = F.from_json(F.lit(listed.select(F.to_json("w.bits")).first()[0]), "array<bigint>")

    def places(self, term: Column) -> list[Column]:
        return [x.bitwiseAND(F.lit(self.bits - 1).cast("bigint"))
                for x in (term, F.shiftrightunsigned(term, 32))]

    def among(self, *found: Column) -> Column:
        """The terms of each of the arrays that are marked."""
        def marked(words: Column, place: Column) -> Column:
            word = F.get(words, F.shiftrightunsigned(place, 6).cast("int"))
            return F.getbit(word, place.bitwiseAND(F.lit(63).cast("bigint")).cast("int")) == 1

        def kept(words: Column) -> Column:
            return F.transform(F.array(*found), lambda own: F.filter(own, lambda t: reduce(
                and_, [marked(words, place) for place in self.places(t)])))

        # As an argument, the bitmap is in the plan once, however often it is used.
        return F.get(F.transform(F.array(self.words), kept), 0)


def lexicon(df: DataFrame, text_col: str, band: tuple[float, float] = BAND) -> Lexicon:
    """The terms in the band."""
    docs = df.select(whole_text(text_col).alias("text"))
    low, high = (docs.count() / math.exp(b) for b in reversed(band))
    counted = (docs.select(F.explode(terms(F.col("text"))).alias("term"))
               .groupBy("term").count())
    return Lexicon(stage(counted.where(F.col("count").between(low, high)).select("term"), "lexicon"))


def _bits(term: Column, place: int, width: int) -> Column:
    """``width`` bits of a term's hash below the topmost ``place`` ones."""
    return F.shiftrightunsigned(term, 64 - place - width).bitwiseAND(
        F.lit((1 << width) - 1).cast("bigint"))


def with_fingerprints(df: DataFrame, names: dict[str, str], known: Lexicon) -> DataFrame:
    """Adds a struct for each name and text column: ``hashes`` (``LEVELS`` for each subset, null
    where the document has no term in it), and ``whole`` where it has no term of the lexicon."""
    df = df.withColumn("__all", known.among(*[terms(F.col(text)) for text in names.values()]))
    for i, (name, text) in enumerate(names.items()):
        df = _with_fingerprint(df.withColumn("__terms", F.array_sort(F.get("__all", F.lit(i)))),
                               text, name)
    return df.drop("__all")


def _with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    def cut(own: Column, place: int, width: int) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit((1 << width) - 1)),
                           lambda k: F.filter(own, lambda t: _bits(t, place, width) == k))

    def thinned(own: Column, n: int) -> Column:
        return F.filter(own, lambda t: _bits(t, 5, 2 * n) == 0)

    def levels(own: Column) -> Column:
        return F.array(F.hash(own), *[F.hash(thinned(own, n)) for n in range(1, LEVELS)])

    # In two steps, by three bits and by two, each term is looked at 12 times rather than 32.
    subsets = F.flatten(F.transform(cut(F.col("__terms"), 0, 3), lambda own: cut(own, 3, 2)))
    hashes = F.transform(F.flatten(F.transform(subsets, levels)),
                         lambda h: F.when(h != NOTHING, h))
    # Without any term in the lexicon, the text stands for itself.
    return df.withColumn(name, F.struct(
        hashes.alias("hashes"),
        F.when(F.size("__terms") == 0, F.xxhash64(F.lower(text))).alias("whole"),
    )).drop("__terms")


def as_text(print_: Column) -> Column:
    """A fingerprint as text: equal texts have equal ones."""
    hexes = F.transform(print_["hashes"], lambda h: F.when(h.isNull(), "").otherwise(
        F.lpad(F.substring(F.hex(h), -8, 8), 8, "0")))
    return F.concat(F.concat_ws(",", hexes), F.lit(":"),
                    F.coalesce(F.hex(print_["whole"]), F.lit("")))


def likeness(a: Column, b: Column) -> Column:
    """The share of equal hashes among the subsets in which either document has a term."""
    pairs = F.zip_with(a["hashes"], b["hashes"], lambda p, q: F.when(
        p.isNotNull() | q.isNotNull(), F.coalesce((p == q).cast("int"), F.lit(0))))
    told = F.filter(pairs, lambda p: p.isNotNull())
    same = F.when(F.size(told) > 0, F.aggregate(told, F.lit(0), lambda s, p: s + p) / F.size(told))
    return F.coalesce(same, (a["whole"] == b["whole"]).cast("double"), F.lit(0.0))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 band: tuple[float, float] = BAND) -> DataFrame:
    """``doc_id`` and ``fingerprint`` of every row. Null and empty texts have one fingerprint;
    texts of any length are read whole; repeated rows are returned each; an empty table gives no
    rows. Further columns are not read."""
    docs = df.select(named(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    known = lexicon(df, text_col, band)
    return with_fingerprints(docs, {"print": "text"}, known).select(
        "doc_id", as_text(F.col("print")).alias("fingerprint"))


def _range_of(order: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are smaller, looked up in two steps."""
    step = max(1, math.isqrt(len(bounds)))
    as_array = lambda values: F.from_json(
        F.lit("[" + ",".join(map(str, values)) + "]"), "array<bigint>")
    blocks = F.size(F.filter(as_array(bounds[::step]), lambda b: b < order))
    start = F.greatest(blocks - 1, F.lit(0)) * step
    rest = F.slice(as_array(bounds), start + 1, F.lit(step))
    return start + F.size(F.filter(rest, lambda b: b < order))


def beside_next(df: DataFrame, id_col: str, text_col: str, ranges: int) -> DataFrame:
    """``part, place, extra, doc_id, text, next_text`` in descending order of ids.

    Rows are dealt to ranges of ids whose upper bounds are ids that occur; the rows of a
    range's upper bound are also given to the range above it (and those of the last one to the
    first), as ``extra`` rows after its own, so that each row finds the next one in its range.
    Ties are ordered by text; a null id comes last.
    """
    docs = df.select(named(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    order = F.coalesce("doc_id", F.lit(-2**63).cast("long"))
    shares = [(k + 1) / ranges for k in range(ranges)]
    # As many numbers as there are partitions.
    found = docs.select(order.alias("k")).agg(F.percentile_approx("k", shares, 100_000)).first()[0]
    bounds = sorted(set(found or [0]))
    last = len(bounds)
    part = _range_of(order, bounds)
    placed = docs.withColumn("__order", order).withColumn("__part", part)
    is_bound = F.array_contains(F.slice(F.from_json(F.lit(
        "[" + ",".join(map(str, bounds)) + "]"), "array<bigint>"), F.col("__part") + 1, F.lit(1)),
        F.col("__order"))
    targets = F.when(is_bound, F.array(
        F.struct(F.col("__part").alias("part"), F.lit(False).alias("extra")),
        F.struct(((F.col("__part") + 1) % last).alias("part"), F.lit(True).alias("extra")),
    )).otherwise(F.array(F.struct(F.col("__part").alias("part"), F.lit(False).alias("extra"))))
    dealt = placed.select("doc_id", "__order", "text", F.explode(targets).alias("t")).select(
        "doc_id", "__order", "text", "t.part", "t.extra")
    line = W.partitionBy("part").orderBy("extra", F.desc("__order"), F.desc("text"))
    return dealt.select("part", "extra", "doc_id", "text", F.row_number().over(line).alias("place"),
                        F.lead("text").over(line).alias("next_text"))


def edited_likeness(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    band: tuple[float, float] = BAND, ranges: int | None = None) -> DataFrame:
    """How a fingerprint stands an edit: ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next`` of every row.

    The last third of a text is replaced by the beginning of the next document's, in
    descending order of ids, the first document after the last. Null counts as the empty text;
    texts of any length are taken whole. A single row is its own next one. Repeated rows follow
    each other; an empty table gives no rows. The number of ``ranges`` of ids follows that of rows.
    """
    ranges = ranges or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                           -(-df.count() // RANGE_ROWS))
    known = lexicon(df, text_col, band)
    rows = beside_next(df, id_col, text_col, ranges).withColumn("n_chars", F.length("text"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    rows = rows.withColumn("edited", F.when(F.col("extra"), F.lit("")).otherwise(F.concat(
        F.substring("text", F.lit(1), F.col("n_chars") - third),
        F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), third)))).drop("next_text")
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256))
    rows = with_fingerprints(rows, {"print": "text", "edited_print": "edited"}, known).drop(
        "text", "edited")
    line = W.partitionBy("part").orderBy("place")
    rows = rows.withColumn("next_print", F.lead("print").over(line)).where(~F.col("extra"))
    return rows.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256",
        as_text(F.col("print")).alias("fingerprint"),
        as_text(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"))
