"""From raw documents to coded token ids: the training-data stages in order.

Each stage is ``function(spark, docs, sf_dir)``; its result is written as Parquet and read again as the next one's
``docs``. All but the last return the columns of ``docs``, whatever they are. Null texts count as empty ones; an empty
table passes through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deckmill.llm import hamming, huffman, latent, mixing, pairwise
from deckmill.llm.common import stored, table

# No SQL: the stages fit models, link by signatures and tokenize. Tests hold them against brute force instead.
ORACLE_SQL = None
TOKENIZER = "word_bpe_49k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a pairwise quality score of 0.3 or more; learned from four fifths of the labelled ids."""
    labels = table(spark, sf_dir, "labels").where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    ranking = pairwise.train(docs, labels, most_labelled=20_000, threshold=0.3)
    return docs.where(pairwise.score(docs["text"], ranking) >= 0.3)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group linked at similarity 0.75."""
    return hamming.without_near_duplicates(docs, percent=75)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, copied or reworded."""
    return latent.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by weights 5, 2, 1 in turn, none above three times its size: each document as often as the mix takes it."""
    return mixing.mixed(docs, (5, 2, 1), 3.0)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every text as ids in an id file: doc_id, start, n_tokens, ids_crc32."""
    return huffman.token_table(docs, public_tokenizers.path(TOKENIZER), end_id=1)


STAGES = [
    ("quality classifier", quality),
    ("near-duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing", mixture),
    ("token ids", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
