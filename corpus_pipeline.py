"""A corpus pipeline from the operators of ``boardlake.llm``.

Stages, in order: language ID (documents without an identified language go),
exact dedup, SimHash near-dedup (one document of each group stays), mixing of
sources to target weights, and sampled SentencePiece segmentation.  Each stage
gets all documents that the one before it kept, as a Parquet table; all but
the last return the columns of ``documents``.

Defined results: a null or empty text, and one without letters, has no
language and goes in the first stage; rows without an id or with one that
repeats pass as rows of their own until a dedup stage finds their text again,
where the row with the smallest id stays (the longest original in exact dedup
before that), then the one with the smallest text hash; very long texts are
worked on whole; an empty table passes all stages empty; further columns, also
ones named like a stage's own, are kept, and the last stage's two get a free name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from boardlake.llm.chunk_dedup import keep_first
from boardlake.llm.common import free_name, scratch_path
from boardlake.llm.langid import keep_identified
from boardlake.llm.mixing import SHARE, mix
from boardlake.llm.queries import tokenizer_path
from boardlake.llm.sampling import sample_pieces
from boardlake.llm.simhash import simhash_dedup

PIECE_MODEL = "piece_bpe_32k.model"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified."""
    return keep_identified(docs, tokenizer_path(PIECE_MODEL))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of documents with equal text."""
    return keep_first(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group."""
    return simhash_dedup(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SHARE of the tokens in raked shares of sources, languages and topics; scarce cells whole, no document twice."""
    return mix(docs, share=SHARE, repeats=False)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with sampled piece ids, and whether these decode to the text."""
    return sample_pieces(docs, tokenizer_path(PIECE_MODEL), out=free_name(docs, "piece_ids"), check=free_name(docs, "lossless"))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("mixing", mixing),
    ("sentencepiece", sentencepiece),
]

#: SQL expresses neither the language scores nor the sampled pieces.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
