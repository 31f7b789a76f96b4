"""The operators of this subpackage as queries on the given tables."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from public_tokenizers import PATTERN, path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.functions.checkpoints import scratch_path
from tabloom.llm.alignment import align_tokenizers
from tabloom.llm.byte_pairs import decode, encode
from tabloom.llm.exact import exact_duplicates, text_digest
from tabloom.llm.html_text import extract_text
from tabloom.llm.imatch import edited_likeness
from tabloom.llm.language_model import model_scores
from tabloom.llm.merkle import document_manifest
from tabloom.llm.packing import pack
from tabloom.llm.quality import quality_scores
from tabloom.llm.sharding import shard_rows
from tabloom.llm.simhash import near_duplicates
from tabloom.llm.token_counts import token_counts
from tabloom.llm.token_files import read_index, write_token_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _query(run: Callable[[SparkSession, str], DataFrame]) -> Callable:
    QUERIES[run.__name__] = run
    return run


@_query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


@_query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    write_token_files(_table(spark, sf_dir, "documents"), folder, path("byte_bpe_50k.json"))
    return read_index(spark, folder)


@_query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"), path("word_bpe_49k.json"))


@_query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"))


@_query
def op8_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = path("byte_bpe_multi_50k.tiktoken")
    ids = encode(_table(spark, sf_dir, "documents"), ranks, PATTERN)
    return decode(ids, ranks, PATTERN).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@_query
def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(_table(spark, sf_dir, "pages"))


@_query
def op5_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_likeness(_table(spark, sf_dir, "documents"))


@_query
def op7_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(
        _table(spark, sf_dir, "documents"), "doc_id", "text",
        text_digest(F.coalesce("text", F.lit(""))).alias("text_sha256"))


ORACLE["op7_exact"] = f"""
WITH folded AS (
    SELECT doc_id, translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}') AS t
    FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM folded"""


@_query
def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_scores(_table(spark, sf_dir, "documents"))


@_query
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(_table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"),
                            path("piece_bpe_32k.model"))


@_query
def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(_table(spark, sf_dir, "documents"), 40)


@_query
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_manifest(_table(spark, sf_dir, "documents"))
