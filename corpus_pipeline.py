"""The corpus pipeline: documents without toxic ones, one of each group of near copies, secrets masked, sources mixed, packed.

Every stage works on all that its predecessor kept, which lies as Parquet in
the shared folder between two stages. All stages but the last return the
columns of documents; nulls, empty texts, repeated rows and empty tables are
handled as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import free_name, query, table
from ledgerloom.llm.mixing import mixed_copies
from ledgerloom.llm.packing import pack_documents
from ledgerloom.llm.secrets import mask_secrets
from ledgerloom.llm.simhash import near_dedup
from ledgerloom.llm.tokens import vocabulary_path
from ledgerloom.llm.toxicity import toxicity
from ledgerloom.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network, learned from the labels, does not call toxic; the cut is the operator's own."""
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    names = tuple(free_name(c, docs.columns) for c in ("held_out", "toxicity", "toxic"))
    scored = toxicity(docs, labels, names=names)
    return scored.filter(F.col(names[2]) == 0).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies, by fingerprints of five-word shingles."""
    return near_dedup(docs)


def mask(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with found secrets starred out."""
    return mask_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that the sources meet their targets."""
    return mixed_copies(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences."""
    return pack_documents(docs, vocabulary_path("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("near copies", drop_near_copies), ("secrets", mask), ("mixing", mix), ("packing", pack)]
ORACLE_SQL = None  # no SQL trains the network; tests hold each stage against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


query("pipeline")(run)
