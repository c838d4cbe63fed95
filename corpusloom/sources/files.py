"""Readers and writers of the formats that corpora come in; each returns or takes a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def done(spark: SparkSession, path: str) -> bool:
    """Whether a stage's output is complete there, so that a rerun can skip it."""
    return exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def read_texts(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, text): each *.txt of a folder, not of those below it, is a document."""
    t = spark.read.option("pathGlobFilter", "*.txt").text(folder, wholetext=True)
    return t.select(F.col("_metadata.file_name").alias("doc_id"), F.col("value").alias("text"))


def read_folder(spark: SparkSession, folder: str) -> DataFrame:
    """The *.parquet files of a folder."""
    return spark.read.option("pathGlobFilter", "*.parquet").parquet(folder)


def read_datasets(spark: SparkSession, root: str) -> DataFrame:
    """root/<dataset>/*.parquet, with dataset and source_file."""
    t = spark.read.option("pathGlobFilter", "*.parquet").parquet(f"{root}/*/")
    return t.withColumn("source_file", F.col("_metadata.file_path")).withColumn("dataset", F.element_at(F.split("source_file", "/"), -2))


def read_tree(spark: SparkSession, root: str) -> DataFrame:
    """Every file below ``root``, whatever its name, by column names; a column that some lack is null there."""
    return spark.read.option("recursiveFileLookup", True).option("mergeSchema", True).parquet(root)


def read_blocklist(spark: SparkSession, path: str) -> DataFrame:
    """(domain), a line each as it stands."""
    return spark.read.text(path).withColumnRenamed("value", "domain")


def read_suffixes(spark: SparkSession, path: str, most: int = 100_000) -> tuple[str, ...]:
    """Rules of a public suffix list in its own format, lower-cased; those of one label, which hold anyway, are left out."""
    lines = spark.read.text(path).filter(~F.col("value").rlike(r"^\s*(//|$)")).select(F.lower(F.regexp_extract("value", r"^\s*(\S+)", 1)).alias("rule"))
    found = [r["rule"] for r in lines.filter(F.contains("rule", F.lit("."))).distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"more than {most} suffix rules in {path}")
    return tuple(sorted(found))


def read_identified(spark: SparkSession, folder: str, id_col: str = "unique_id") -> DataFrame:
    """The *.parquet files of a folder that have ids, with source_file; files without that column are left out."""
    t = spark.read.option("pathGlobFilter", "*.parquet").option("mergeSchema", True).parquet(folder).withColumn("source_file", F.col("_metadata.file_path"))
    if id_col not in t.columns:
        return t.limit(0)
    named = t.groupBy("source_file").agg(F.count(id_col).alias("n")).filter("n > 0").select("source_file")
    return t.join(named, "source_file", "left_semi").select(*t.columns)


def write_once(df: DataFrame, path: str) -> bool:
    """Write unless a complete output is there; whether it was written."""
    if done(df.sparkSession, path):
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def write_report(flagged: DataFrame, path: str, by: str = "reason") -> None:
    """Rejected rows, a folder per reason: of blocked addresses by ``reason``, of gibberish by ``gibberish_reason``."""
    flagged.filter(F.col(by).isNotNull()).write.partitionBy(by).mode("overwrite").json(path)


def write_lists(lists: DataFrame, path: str) -> bool:
    """Duplicate lists (id, dup_ids) as JSON lines, unless they are there; whether they were written."""
    if done(lists.sparkSession, path):
        return False
    lists.write.mode("overwrite").json(path)
    return True


def write_stats(one_row: DataFrame, path: str) -> None:
    one_row.coalesce(1).write.mode("overwrite").json(path)


def write_texts(docs: DataFrame, path: str, text_col: str = "text", id_col: str = "doc_id") -> None:
    """A text file per document would be a folder of very small files; documents go to JSON lines with their names."""
    docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).write.mode("overwrite").json(path)
