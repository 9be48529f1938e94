"""From raw documents to packed training sequences: five stages, each a table of its own.

Each stage takes the documents that its predecessor kept and returns documents with the same columns, the
last one the pieces of the packed sequences. ``run`` writes every stage as Parquet to the shared folder and
reads it again, so a lost executor costs at most the stage at work.

SQL cannot express the learned lexicon, the tokenizer or the packing search, so ``ORACLE_SQL`` is None;
``tests/llm/test_pipeline.py`` holds the rows of every stage against brute-force versions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dispatchlake.llm import jaccard, mixing, packing, secrets, toxicity
from dispatchlake.session import configure, settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
TARGETS = {"src0": 0.2, "src1": 0.1}  # shares of the mix: the largest source is held down
TEMPER = mixing.TEMPER  # sources without target divide the rest by their bytes to this power
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, labels)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the least id."""
    return jaccard.without_copies(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked: base spans, and random tokens that one owner holds."""
    return secrets.masked(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix: files and rows follow the schedule."""
    return mixing.mixed(docs, targets=TARGETS, temper=TEMPER)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences, which follow the order of the mix."""
    return packing.pack_in_order(docs)


def stage(name: str, work: Stage) -> tuple[str, Stage]:
    """A named stage that brings the session's settings with it, also when it is called by itself."""
    return name, lambda spark, docs, sf_dir: work(configure(spark), docs, sf_dir)


STAGES: list[tuple[str, Stage]] = [
    stage("toxicity", drop_toxic),
    stage("near_copies", drop_near_copies),
    stage("secrets", mask_secrets),
    stage("mixing", mix_sources),
    stage("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*[F.col(c) for c in COLUMNS])
    for name, work in STAGES:
        docs = settle(work(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
