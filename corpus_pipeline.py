"""From raw documents to a training mix: quality, exact and near dedup, decontamination, mixing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.llm import decontamination, exact_dedup, mixing, quality, simhash
from corpusloom.plans.keys import hidden
from corpusloom.plans.shared import save, spread


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier, fitted on the labels, doesn't reject."""
    model = quality.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    own, named, back = hidden(docs)
    return back(quality.score_quality(own, model, named["text"], "_score").filter(F.col("_score") >= quality.THRESHOLD))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest id."""
    return exact_dedup.drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their SimHash, the one with the smallest id."""
    return simhash.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.drop_leaking(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, numbered by ``mix_copy``; those it doesn't take are gone."""
    mixed = mixing.mix(docs).filter("mix_copies > 0")
    return mixed.withColumn("mix_copy", F.explode(F.sequence(F.lit(1), "mix_copies"))).drop("mix_source_size", "mix_copies")


STAGES = [
    ("quality", keep_quality),
    ("exact dedup", exact),
    ("near dedup", near),
    ("decontamination", decontaminate),
    ("mixing", mix),
]

#: SQL can't express the classifier's compressed sizes.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again, over ``documents``."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
