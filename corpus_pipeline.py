"""The corpus pipeline: five stages from raw documents to token pieces.

1. *toxicity*: documents at or above the threshold go.
2. *near duplicates*: one document of each group of near copies stays (five
   words, similarity 0.8), the one with the smallest doc_id.
3. *secrets*: spans of secrets become ``[SECRET]``; every document stays.
4. *mixing*: sources are mixed to their target weights; a document that is
   taken twice is two rows, one that is taken in part holds the taken words.
5. *pieces*: the ids of the four best SentencePiece segmentations, each decoded
   and checked.

Each stage takes (spark, docs, sf_dir); all but the last return the columns of
documents.  ``run`` writes each stage's result as Parquet under the shared
checkpoint folder and reads it again for the next.  SQL can't express the
learnt stages, so there is no ORACLE_SQL; tests/llm holds every stage against
a brute-force version.

Nulls: a null text is clean, in no group, without secrets, and not in the mix;
a null doc_id passes the first three stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowline.llm import hyperminhash, mixing, nbest, secrets, toxicity
from flowline.llm.common import staged, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return hyperminhash.deduplicated(docs, size=5, percent=80)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return nbest.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
    ("pieces", pieces_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
