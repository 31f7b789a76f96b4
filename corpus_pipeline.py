"""A training corpus from the documents table, stage by stage.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the one before kept.
All but the last return the columns of the documents table. What a stage returns must be
written before the next one begins, which removes the scratch tables of the one before.
"""

from __future__ import annotations

from public_tokenizers import path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.functions.checkpoints import phase, stage
from tabloom.llm.common import named
from tabloom.llm.exact import exact_duplicates
from tabloom.llm.packing import pack
from tabloom.llm.quality import learned, score_column
from tabloom.llm.simhash import similar_documents

#: From this score on a document counts as good.
GOOD = 0.7

#: So many bits may two SimHash fingerprints of near duplicates differ by.
RADIUS = 2

#: SQL can't express a trained classifier, XXH64 or a tokenizer's merges.
ORACLE_SQL = None


def _whole_rows(docs: DataFrame):
    """All columns as one, so that no name can clash with an operator's own."""
    return F.struct(*[named(c) for c in docs.columns]).alias("__document")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    Null and empty texts are scored like any other; repeated rows stay or go together; an empty
    table stays empty. Without labels of any kind every score is 0.5, and nothing stays.
    """
    with phase(spark, "quality"):
        weights = learned(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(score_column(spark, F.col("text"), weights) >= GOOD)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id.

    Null and empty texts are equal; of repeated rows one stays; a null id is the smallest; an empty
    table stays empty.
    """
    with phase(spark, "exact_dedup"):
        found = exact_duplicates(docs, "doc_id", "text", _whole_rows(docs))
    return found.where("kept").select("__document.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates the one with the smallest id: of texts that op1_simhash links (SimHash
    fingerprints of three-word shingles, ``RADIUS`` differing bits or fewer), or whose sets of five-word
    shingles have a similarity of 0.8 or more, be it through others.

    Texts without words, null ones too, are alike; of repeated rows one stays; a null id is the
    largest; texts of any length are compared whole; an empty table stays empty.
    """
    with phase(spark, "near_dedup"):
        found = similar_documents(docs, "doc_id", "text", _whole_rows(docs),
                                  again=F.col("__document.text"), radius=RADIUS)
    return found.where("kept").select("__document.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes in sequences of 2048 tokens.

    Null and empty texts are pieces of the end id alone; repeated rows are packed each; an empty
    table gives no rows.
    """
    with phase(spark, "packing"):
        return pack(docs, path("word_bpe_49k.json"))


STAGES = [
    ("quality", keep_good),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage is written out before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
