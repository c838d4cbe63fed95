"""Document cleaning: sentences are cleaned and sifted inside their document's row, so nothing is shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusloom.functions.documents import COUNTS, clean_udf, tidy_udf
from corpusloom.functions.profiles import ARABIC, Profile


def clean_documents(docs: DataFrame, profile: Profile = ARABIC, *, text_col: str = "text", html=None, nfkc=None,
                    script_share: float = 0.7, least_words: int = 8, most_removed: float = 0.3, least_doc_words: int = 64) -> DataFrame:
    """``docs`` with clean_text, drop_reason and counts; no row is removed, ``kept`` and ``rejects`` do that.

    A document is cleaned as one string in which U+FDD0 stands between sentences, and before and after each line break; that and
    U+FDD1 are taken out of texts first. ``html`` and ``nfkc`` are Column functions of functions.udfs. A null text has
    drop_reason 'null_text'.
    """
    d = docs
    if html is not None:
        d = d.withColumn("_page", html(F.col(text_col))).withColumn("n_scripts", F.col("_page.scripts")).withColumn("_raw", F.col("_page.text"))
        d = d.withColumn("html_changed", F.col("_raw") != F.col(text_col)).drop("_page")
    else:
        d = d.withColumn("n_scripts", F.lit(0)).withColumn("_raw", F.col(text_col)).withColumn("html_changed", F.lit(False))
    # Bytes that are no UTF-8 are replaced, as Python can't take them.
    raw = F.make_valid_utf8("_raw")
    if nfkc is None:
        d = d.withColumn("_c", clean_udf(docs.sparkSession, profile, script_share, least_words)(raw))
    else:
        d = d.withColumn("_tidy", tidy_udf(docs.sparkSession)(raw)).withColumn("_lines", nfkc(F.col("_tidy.lines")))
        d = d.withColumn("_c", clean_udf(docs.sparkSession, profile, script_share, least_words, tidied=True)(F.col("_tidy.empty"), F.col("_lines"))).drop("_tidy", "_lines")
    d = d.withColumns({n: F.col(f"_c.{n}") for n in COUNTS[:-1]}).withColumn("_text", F.col("_c.text"))
    d = d.withColumn("n_removed", F.col("n_sentences") - F.col("n_kept"))
    reason = (
        F.when(F.col("_raw").isNull(), "null_text")
        .when(F.coalesce(F.try_divide("n_removed", "n_sentences"), F.lit(0.0)) > most_removed, "sentences_removed")
        .when(F.col("_c.n_gaps") < least_doc_words - 1, "too_short")
    )
    return d.withColumn("drop_reason", reason).withColumnRenamed("_text", "clean_text").drop("_raw", "_c")


def kept(cleaned: DataFrame) -> DataFrame:
    return cleaned.filter(F.col("drop_reason").isNull())


def rejects(cleaned: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What was dropped, and why: the log of a run as rows."""
    return cleaned.filter(F.col("drop_reason").isNotNull()).select(F.col(id_col), F.lit("clean").alias("stage"), F.col("drop_reason").alias("reason"), F.col(text_col).alias("before"), F.col("clean_text").alias("after"))


def counters(cleaned: DataFrame) -> DataFrame:
    """One row of run statistics, right also when tasks are retried."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return cleaned.agg(
        F.count("*").alias("initial_docs"),
        total("n_sentences").alias("initial_sentences"),
        total("n_kept").alias("final_sentences"),
        total(F.col("n_sentences") - F.col("n_script")).alias("removed_for_script"),
        total(F.col("n_script") - F.col("n_kept")).alias("removed_for_words"),
        F.count_if(F.col("drop_reason") == "sentences_removed").alias("docs_removed_for_sentences"),
        F.count_if(F.col("drop_reason") == "too_short").alias("docs_removed_for_length"),
        F.count_if(F.col("drop_reason") == "null_text").alias("docs_without_text"),
        total("n_masked").alias("sentences_masked"),
        total("n_marks_cut").alias("sentences_with_marks_cut"),
        total("n_spans").alias("foreign_spans"),
        F.count_if(F.col("n_scripts") > 0).alias("docs_with_scripts"),
        F.count_if("html_changed").alias("docs_with_html"),
    )
