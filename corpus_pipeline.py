"""A training-data pipeline over documents, of five of the operators in siltstone.llm.

Each stage takes what its predecessor kept, as (spark, docs, sf_dir); all but the last return the columns of documents.
Empty and null texts, null ids, repeated rows and extra columns are as the operators state them: no stage
drops a document that its operator doesn't find fault with.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from siltstone.llm import decontamination, jaccard, packing, pii, toxicity
from siltstone.llm.columns import bound_batches, table
from siltstone.llm.queries import tokenizer_json
from siltstone.plans.staging import recorded, release, stage

#: What the last stage has staged; its result is written when the next one begins.
_left: list[str] = []


def _step(function):
    """A stage that first deletes what the stage before it has staged."""

    @wraps(function)
    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, _left)
        bound_batches(spark)
        with recorded() as paths:
            out = function(spark, docs, sf_dir)
        _left.extend(paths)
        return out

    return run_step


@_step
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learned from all labels of documents, scores below its threshold."""
    return toxicity.reject(docs, table(spark, sf_dir, "labels"))


@_step
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of 5-word shingle sets with a Jaccard similarity of 0.8 or more."""
    return jaccard.deduplicate(docs)


@_step
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


@_step
def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows the text."""
    return pii.redact(docs)


@_step
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 tokens."""
    return packing.query(docs, tokenizer_json())


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal data", mask_personal_data),
    ("packing", pack_sequences),
]

#: Trees, components and random fields are beyond SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
