"""Documents to packed training sequences, stage by stage.

Each stage takes the rows its predecessor kept and returns the columns of documents, but for the last one, which
returns the packed pieces. ``run`` writes every stage to the shared folder and reads it again.

* ``language_id``: learns from the labelled documents that ``op4`` learns from too, and drops documents
  without a language (no text or no letter in it).
* ``exact_dedup``: of equal texts the longest row stays, of those the smallest id.
* ``near_dedup``: of near duplicates the row with the smallest id stays.
* ``secret_scan``: secrets in the text are replaced by a mark; no document is dropped. ``n_chars`` follows the text.
* ``packing``: the texts' tokens in sequences of 2048, each piece with its ``token_ids`` (little-endian unsigned 32-bit).

Rows are handled as the operators state: a null id is an id of its own, a document without a text goes in the first stage,
and an empty table gives empty stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillgauge.llm import exact, langid, ordermin, packing, secrets
from rillgauge.llm.common import SCHEMAS, ready
from rillgauge.llm.queries import BYTE_BPE, BYTE_RANKS
from rillgauge.session import materialised

# The decisions are made by programs (suffix automata, alignments, encoders) that plain SQL cannot state.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))))
    return langid.recognised(docs, model)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.drop_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ordermin.drop_near_duplicates(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.redact(docs, BYTE_RANKS, public_tokenizers.PATTERN)
    return clean.withColumn("n_chars", F.char_length("text").cast("bigint")) if "n_chars" in docs.columns else clean


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.cut(docs, BYTE_BPE, BYTE_RANKS, public_tokenizers.PATTERN)
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("token_ids")))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of a folder."""
    ready(spark)
    docs = spark.read.schema(SCHEMAS["documents"]).parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialised(stage(spark, docs, sf_dir), name)
    return docs
