"""From documents to token ids: five stages, each written as Parquet and read again by the next.

1. quality: documents that the classifier (fitted on ``labels``) rejects go.
2. near_duplicates: of documents linked by five-word shingles (Jaccard 0.8 or more) that with the least doc_id stays.
3. personal_data: personal data become placeholders; n_chars follows the new text.
4. mixing: sources are mixed to their target weights, documents repeated or left out as a whole.
5. token_ids: doc_id, n_tokens and ids of every document of the mix.

Null texts count as empty and stay null until they are encoded; an empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termfold.llm import bpe_tree, jaccard, mixing, pii, quality
from termfold.llm.shared import table
from termfold.operators.staging import mark, release, staged


#: Words that a worker keeps encoded until a task's end; few, since workers live on beside later stages.
KEPT_WORDS = 75_000
#: New words, and bytes of text, that a worker holds as Python objects at a time.
LEARNED_WORDS, SPLIT_BYTES = 16_384, 1_000_000


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted_documents(docs, table(spark, sf_dir, "labels"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.distinct_documents(docs, n=5, percent=80)


def masked_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.masked(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ids = bpe_tree.encode(docs, public_tokenizers.path("word_bpe_49k.json"), kept=KEPT_WORDS, forget=True,
                          learned=LEARNED_WORDS, split=SPLIT_BYTES)
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality", good_documents),
    ("near_duplicates", distinct_documents),
    ("personal_data", masked_documents),
    ("mixing", mixed_documents),
    ("token_ids", token_ids),
]

#: SQL can express neither the classifier nor the encoder; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, since = table(spark, sf_dir, "documents"), mark()
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
        # The stage's own tables and the stage before's result are not read again.
        release(spark, since, keep=(docs,))
    return STAGES[-1][1](spark, docs, sf_dir)
