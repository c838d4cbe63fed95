"""Queries through files: what readers and writers keep of a table, report or list. Each writes below the shared folder and reads it back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusloom.functions.profiles import LATIN
from corpusloom.operators import gibberish, minhash as M, urls
from corpusloom.plans.shared import new_path
from corpusloom.queries import dedup, gibberish as flags, urls as addresses
from corpusloom.queries.common import docs, table
from corpusloom.sources import files

_DATASETS = ("news", "books", "web")


def gibberish_report(spark, sf_dir: str) -> DataFrame:
    """Rejected documents with the reason, a folder each."""
    path = new_path(spark, "report")
    files.write_report(gibberish.flag_gibberish(docs(spark, sf_dir), LATIN).select("doc_id", "gibberish_reason"), path, "gibberish_reason")
    return spark.read.json(path).select("doc_id", F.col("gibberish_reason").alias("reason"))


def stats_report(spark, sf_dir: str) -> DataFrame:
    path = new_path(spark, "stats")
    files.write_stats(gibberish.gibberish_counts(gibberish.flag_gibberish(docs(spark, sf_dir), LATIN)), path)
    return spark.read.json(path)


def duplicate_lists(spark, sf_dir: str) -> DataFrame:
    path = new_path(spark, "lists")
    files.write_lists(M.near_lists(M.near_pairs(M.signatures(docs(spark, sf_dir), "doc_id"))), path)
    return spark.read.json(path).select("id", F.array_join("dup_ids", ",").alias("dup_ids"))


def blocklist_files(spark, sf_dir: str) -> DataFrame:
    """Addresses flagged by lists that stand in files, a domain a line."""
    path = new_path(spark, "lists")
    for name, domains in addresses.BLOCKED.items():
        spark.createDataFrame([(d,) for d in domains], "domain string").write.text(f"{path}/{name}")
    lists = urls.blocklist({name: files.read_blocklist(spark, f"{path}/{name}") for name in addresses.BLOCKED})
    return urls.with_reason(table(spark, sf_dir, "pages").select("page_id", "url"), lists)


def _in_datasets(spark, sf_dir: str) -> str:
    path = new_path(spark, "datasets")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    for k, name in enumerate(_DATASETS):
        files.write_once(pages.filter(F.col("page_id") % len(_DATASETS) == k), f"{path}/{name}")
    return path


def datasets_scan(spark, sf_dir: str) -> DataFrame:
    """Pages of several datasets, each in a folder of its name."""
    return files.read_datasets(spark, _in_datasets(spark, sf_dir)).select("page_id", "url", "dataset")


def tree_scan(spark, sf_dir: str) -> DataFrame:
    """The same whatever the folders; a second run of a stage writes nothing anew."""
    path = _in_datasets(spark, sf_dir)
    again = files.write_once(table(spark, sf_dir, "pages"), f"{path}/{_DATASETS[0]}")
    return files.read_tree(spark, path).select("page_id", F.lit(again).alias("again"))


QUERIES = {
    "gibberish_report": gibberish_report,
    "stats_report": stats_report,
    "duplicate_lists_report": duplicate_lists,
    "blocklist_files": blocklist_files,
    "datasets_scan": datasets_scan,
    "tree_scan": tree_scan,
}

ORACLE_SQL = {
    "gibberish_report": f"SELECT doc_id, gibberish_reason AS reason FROM ({flags.ORACLE_SQL['gibberish_flags_latin']}) WHERE is_gibberish",
    "stats_report": flags.ORACLE_SQL["gibberish_counts"],
    "duplicate_lists_report": dedup.ORACLE_SQL["near_dup_lists"],
    "blocklist_files": addresses.ORACLE_SQL["url_blacklist_reason"],
    "datasets_scan": f"SELECT page_id, url, ({list(_DATASETS)})[page_id % {len(_DATASETS)} + 1] AS dataset FROM pages",
    "tree_scan": "SELECT page_id, false AS again FROM pages",
}
