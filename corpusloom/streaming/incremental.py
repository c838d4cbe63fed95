"""The row-local operators on streams: they keep no state, so a stream is cleaned as a table is."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from corpusloom.functions.profiles import ARABIC, Profile
from corpusloom.operators.clean import clean_documents, kept


def read_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Parquet files as they come; the schema is that of the files there are."""
    return spark.readStream.schema(spark.read.parquet(folder).schema).parquet(folder)


def clean_stream(docs: DataFrame, profile: Profile = ARABIC) -> DataFrame:
    return kept(clean_documents(docs, profile))


def start(out: DataFrame, path: str, checkpoint: str, each: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Write what there is and stop; rerun for what has come since, each row once."""
    writer = out.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint)
    return writer.foreachBatch(each).start() if each else writer.format("parquet").option("path", path).start()
