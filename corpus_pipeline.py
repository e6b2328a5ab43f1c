"""The corpus pipeline: quality, exact copies, near copies, mixing, packing.

Each stage takes what the one before kept, and all but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sondeo.llm import exact_dedup, mixing, near_dedup, packing, quality
from sondeo.llm.common import materialize, semi_join, table, tidied
from sondeo.llm.queries import GOOD, vocabulary


#: Target weights of the sources in the mix; None: those that mixing.mix() derives from their numbers of documents.
WEIGHTS: dict[str, float] | None = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores GOOD or better. It learns from all labelled rows of docs that are not held out."""
    labels = quality.one_label(table(spark, sf_dir, "labels").where(~quality.held_out()))
    labelled = semi_join(docs.select("doc_id", "text"), labels.select("doc_id"), "doc_id")
    stats = materialize(quality.with_statistics(labelled).select("doc_id", "_stats"), "stats")
    model = quality.fit(stats.join(labels, "doc_id"))
    name = "_quality"
    while name in docs.columns:
        name += "_"
    scored = quality.with_scores(quality.with_statistics(docs, name=f"{name}_stats"), model, stats=f"{name}_stats", name=name)
    return scored.where(F.col(name) >= GOOD).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal normalised texts, the one with the smallest id."""
    return exact_dedup.drop_exact_copies(docs).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates, the document with the smallest id."""
    return near_dedup.drop_near_copies(docs).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order in which the schedule of the sources reads them."""
    return mixing.in_mixed_order(docs, WEIGHTS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and offset; sequences are filled and numbered in the order of the mix.

    A table has no order that Parquet keeps, so the schedule gives each document its place again from (doc_id, source).
    """
    return packing.pack(docs.select("doc_id", "text"), vocabulary(), order=mixing.positions(docs.select("doc_id", "source"), WEIGHTS))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", keep_good),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: A trained classifier and trained vocabulary stand in the way of SQL; tests compare each stage with a brute-force version.
ORACLE_SQL = None


@tidied
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES over documents; each result is written as Parquet to the shared folder and read again. What a stage wrote for itself goes with it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = tidied(lambda spark, docs, name=name, stage=stage: materialize(stage(spark, docs, sf_dir), name))(spark, docs)
    return STAGES[-1][1](spark, docs, sf_dir)
