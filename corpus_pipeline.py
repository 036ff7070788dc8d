"""The corpus pipeline: toxicity, quality, near copies, benchmark passages, packing.

Filtering stages return the rows they keep as they are, columns of any names included; null, empty and repeated texts are
judged like others, rows with a null id too, and an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from headwater.llm import decontaminate, jaccard, packing, quality, toxicity
from headwater.llm.tables import fold, table
from headwater.session import cut_lineage

#: Columns that a stage adds for itself, so that those of the documents stay as they are.
VERDICT = ("__score", "__predicted")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity lexicon does not reject; it is learned from labelled documents of this stage's input."""
    lexicon = toxicity.train(docs, table(spark, sf_dir, "labels"), fold("doc_id", 4) != 2)
    return toxicity.score(docs, lexicon, names=VERDICT).where(f"{VERDICT[1]} = 0").drop(*VERDICT)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it is learned from labelled documents of this stage's input."""
    model = quality.train(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return quality.classify(docs, model, names=VERDICT).where(f"{VERDICT[1]} = 1").drop(*VERDICT)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near copies."""
    return jaccard.one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark passages do not contaminate."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The bin and place of every piece of the documents that are left."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_copies", drop_copies),
    ("decontamination", drop_benchmark),
    ("packing", pack_bins),
]
#: Learned scores and packing are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
