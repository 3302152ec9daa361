"""From raw documents to token ids: the stages of one training corpus, each over all that the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skuweave.llm import mixing, ngram_join, personal_data, pieces, toxicity
from skuweave.llm.common import table, written
from skuweave.llm.queries import vocabulary

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the noisy-or model does not reject; it learns from the labels outside the held-out fold."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents: the one of the smallest id. Empty documents stay."""
    return ngram_join.keep_first(docs).select(*COLUMNS)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its personal data replaced by the kind's name; n_chars is that of the new text."""
    return personal_data.redact_documents(docs).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by Poisson counts towards the sources' target weights, in shuffled order."""
    return mixing.poisson_mix(docs, mixing.QUERY_WEIGHTS).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row: doc_id, n_tokens, ids."""
    return pieces.encode_texts(docs, vocabulary("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

#: Learned scores and token ids cannot be written in SQL; tests compare the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
