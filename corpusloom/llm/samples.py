"""Bounded labelled samples, and models fitted on one in a single task of an executor."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.plans.shared import ship


def held_out(id_col: str) -> Column:
    """The fifth of all ids that no model of this subpackage learns from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(k, text, label): at most ``max_rows`` labelled documents that aren't held out, the first in a hashed order of ids.

    Only ids and labels are sorted; the sample's ids, at most ``max_rows``, are broadcast to the documents.
    Labels that are null or neither 0 nor 1 don't count; of several labels of an id the larger does.
    """
    given = labels.select(F.col(id_col).alias("k"), F.col(label).cast("int").alias("label"))
    given = given.filter(F.col("k").isNotNull() & F.col("label").isin(0, 1) & ~held_out("k"))
    given = given.groupBy("k").agg(F.max("label").alias("label"))
    given = given.orderBy(F.crc32(F.concat(F.lit("sample:"), F.col("k").cast("string"))), "k").limit(max_rows)
    texts = docs.select(F.col(id_col).alias("k"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.join(F.broadcast(given), "k")


def fit(sample: DataFrame, train: Callable[[Iterator[tuple[str, int]]], bytes]) -> bytes:
    """Run ``train`` over the sample's (text, label) in a fixed order, in one task; its bytes come back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for b in batches:
                yield from zip(b.column("text").to_pylist(), b.column("label").to_pylist())

        yield pa.RecordBatch.from_pydict({"model": pa.array([train(rows())], pa.binary())})

    ship(sample.sparkSession)
    order = F.crc32(F.concat(F.lit("order:"), F.col("k").cast("string")))
    one = sample.repartition(1).sortWithinPartitions(order, "k", "text").select("text", "label")
    made = one.mapInArrow(run, "model binary").collect()
    # Of an empty sample Spark may leave no task at all.
    return bytes(made[0]["model"]) if made else train(iter(()))
