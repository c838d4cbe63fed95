"""Exact dedup against a persistent digest index, bucketed and sorted by hash.

Texts are equal when identical after each run of white space is replaced by one space. Only
DataFrame functions are used. Of equal texts the row with the smallest id stays; of rows
with the same id and text exactly one does.

Cases: null text counts as empty; a null id comes after all others; an empty table gives no rows
and leaves the index as it was; very long texts are hashed whole, like others; further columns pass through
``drop_duplicates`` untouched and have no part in ``dedup_batch``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusloom.plans.keys import hidden, join_per_key, row_key, without
from corpusloom.plans.shared import save, spread

SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text in UTF-8, as 32 bytes."""
    return F.unhex(F.sha2(normalised(text), 256))


class DigestIndex:
    """A table (digest, keep_id, group_size, batch) in the session's warehouse, bucketed and sorted by digest.

    The index is never shuffled: new digests are brought to its buckets, sort-merge anti-joined
    against it and appended. ``group_size`` is that of the batch that brought the digest.
    """

    def __init__(self, spark: SparkSession, table: str, buckets: int = 64, id_type: str = "bigint"):
        self.spark, self.table, self.buckets = spark, table, buckets
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} (digest BINARY, keep_id {id_type}, group_size BIGINT, batch STRING) "
            f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS"
        )

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def unseen(self, groups: DataFrame) -> DataFrame:
        """Those rows of ``groups`` whose digest the index doesn't hold."""
        return self._dealt(groups).join(self.read().select("digest").hint("merge"), "digest", "left_anti")

    def _dealt(self, groups: DataFrame) -> DataFrame:
        """Dealt as the index is, or the planner might rather shuffle an index of few buckets. No join is moved below an observation."""
        return groups.repartition(self.buckets, "digest").observe("dealt", F.count("*").alias("groups"))

    def append(self, groups: DataFrame, batch: str) -> None:
        """Add ``groups`` (digest, keep_id, group_size), one file per bucket and batch."""
        (groups.select("digest", "keep_id", "group_size", F.lit(batch).alias("batch")).repartition(self.buckets, "digest")
         .write.format("parquet").bucketBy(self.buckets, "digest").sortBy("digest").mode("append").saveAsTable(self.table))

    def held(self, groups: DataFrame) -> DataFrame:
        """``groups`` (digest, ...) with held_id and batch of those that the index holds."""
        return self._dealt(groups).join(self.read().select("digest", F.col("keep_id").alias("held_id"), "batch").hint("merge"), "digest")

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """(id, row, digest) of every row, written once; texts aren't moved. ``row`` tells equal rows apart."""
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    return save(docs.select(F.col(id_col).alias("id"), row.alias("row"), digest(F.col(text_col)).alias("digest")), "digests")


def groups(found: DataFrame) -> DataFrame:
    """(digest, keep_id, keep_row, group_size): combined before the shuffle, so a text's copies meet as one row per task."""
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col("row")))
    return (
        found.groupBy("digest").agg(first.alias("first"), F.count("*").alias("group_size"))
        .select("digest", F.col("first.id").alias("keep_id"), F.col("first.row").alias("keep_row"), "group_size")
    )


def dedup_batch(docs: DataFrame, index: DigestIndex, batch: str | None = None, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """One row per row of ``docs``: (id, row, keep_id, group_size, kept, digest), after its new digests joined ``index``.

    Which id stays is what the index then holds: texts of earlier batches are dropped whole. A batch that is given
    again under its name, after a failure say, has the same result. ``group_size`` is the group's in this batch.
    """
    batch = batch or uuid.uuid4().hex
    found = digests(docs, id_col, text_col, row_col)
    by = save(groups(found), "groups")
    index.append(index.unseen(by), batch)
    row = F.when(F.col("batch") == batch, F.col("keep_row"))
    known = save(index.held(by).select("digest", F.col("held_id").alias("keep_id"), row.alias("keep_row"), "group_size"), "known")
    out = join_per_key(found, known, "digest", "group_size", found.count())
    return out.select("id", "row", "keep_id", "group_size", F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False)).alias("kept"), "digest")


def dedup_alone(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """``dedup_batch`` against an index of its own, empty at first, dropped once the result's tables are written."""
    spark = docs.sparkSession
    index = DigestIndex(spark, f"digest_index_{uuid.uuid4().hex[:12]}", int(spark.conf.get("spark.sql.shuffle.partitions")), dict(docs.dtypes)[id_col])
    try:
        return dedup_batch(docs, index, None, id_col, text_col, row_col)
    finally:
        index.drop()


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Those rows of ``docs`` that stay, all columns as they were."""
    own, named, back = hidden(docs)
    keyed = row_key(own, named[id_col], "_row")
    found = dedup_alone(keyed.select(named[id_col], "_row", named[text_col]), named[id_col], named[text_col], "_row")
    return back(without(keyed, save(found.filter(~F.col("kept")).select(F.col("row").alias("_row")), "gone"), "_row"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_alone(spread(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "text"))
    return out.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


OP9_SQL = r"""
WITH n AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
), g AS (
  SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY text_sha256
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM n JOIN g USING (text_sha256)
"""
