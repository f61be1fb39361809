"""A training corpus from ``documents``: toxicity, near duplicates, personal data, mix, packing.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and
returns a DataFrame, which ``run`` writes as Parquet and rereads for the next one.
All stages but the last return the columns of ``documents``.  Every stage gives no rows for an
empty table and keeps further columns whose names do not begin with two underscores; what
nulls and repeated rows mean stands at each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.llm import jaccard, mixing, packing, pii, toxicity
from podium.llm.common import materialise, table
from podium.llm.queries import MIX_EPOCHS, MIX_WEIGHTS, held_out, mix_levels

#: A document goes if it is at least so likely to be toxic.
TOXIC = 0.3
#: The mix asks for as many tokens as there are, dealt by the target weights.
BUDGET = (1, 1)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the training fold of the labels, does not reject.

    A null or empty text is scored as empty; repeated rows and rows without an id are scored
    each by its text.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out())
    return toxicity.reject(docs, model, TOXIC)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of links: the smallest id, one row of it.

    Documents without an id stay, each different text once.
    """
    near = jaccard.near_duplicates(docs)
    kept = near.filter("doc_id = component_id").select(F.col("doc_id").alias("__kept")).distinct()
    return docs.join(kept, docs["doc_id"] == kept["__kept"], "left") \
        .filter("__kept IS NOT NULL OR doc_id IS NULL").drop("__kept") \
        .withColumn("__text", F.xxhash64("text")).dropDuplicates(["doc_id", "__text"]).drop("__text")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind in brackets; n_chars follows.

    Rows without personal data, null texts included, stay as they are; repeated rows are masked alike.
    """
    return pii.mask(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the target weights of domain, language and source; a second epoch repeats rows.

    A null language or source is a leaf of its own, a null text counts as one token, rows of one id come together.
    """
    return mixing.mix(docs, mix_levels(), MIX_WEIGHTS, BUDGET, MIX_EPOCHS, epoch_col="__epoch").drop("__epoch")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens; a null text is the end token alone, repeated rows are packed each."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: The classifier, the links and the packing have no SQL form; tests/llm/test_pipeline.py holds the stages against plain
#: Python and the run against its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
