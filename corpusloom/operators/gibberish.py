"""Heuristic gibberish filter: cheap measures first, the language detector only for rows that need it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusloom.functions import text as T
from corpusloom.functions.profiles import ARABIC, Profile


def flag_gibberish(docs: DataFrame, profile: Profile = ARABIC, *, text_col: str = "text", detector=None, language: str = "ar", shaped: bool = False,
                   most_run: float = 0.25, most_marks: float = 0.15, least_word_like: int = 5, least_common: int = 3, least_script: float = 0.6) -> DataFrame:
    """``docs`` with is_gibberish and gibberish_reason, the first of empty, repeats, marks, no_words, not_script that holds.

    ``detector`` is a Column function text -> language; it sees only texts that all measures leave open.
    With ``shaped`` the script's share is taken after letters have become presentation forms.
    """
    c = F.col(text_col)
    share = T.shaped_script_share(c, profile) if shaped else T.script_share(c, profile)
    cheap = (
        F.when(c.isNull(), "null_text")
        .when(c == "", "empty")
        .when(T.has_long_last_run(c, most_run), "repeats")
        .when(T.mark_share(c) > most_marks, "marks")
        .when(~T.has_word_like(c, least_word_like, profile) & (T.common_word_count(c, profile) < least_common), "no_words")
    )
    d = docs.withColumn("_cheap", cheap).withColumn("_script", share > least_script)
    needs = F.col("_cheap").isNull() & ~F.col("_script")
    if detector is not None:
        d = d.withColumn("_language", detector(F.when(needs, c)))
        needs = needs & ~F.coalesce(F.col("_language") == language, F.lit(False))
    d = d.withColumn("gibberish_reason", F.coalesce("_cheap", F.when(needs, F.lit("not_script"))))
    return d.withColumn("is_gibberish", F.col("gibberish_reason").isNotNull()).drop("_cheap", "_script", "_language")


def drop_gibberish(flagged: DataFrame) -> DataFrame:
    return flagged.filter(~F.col("is_gibberish")).drop("is_gibberish", "gibberish_reason")


def gibberish_counts(flagged: DataFrame) -> DataFrame:
    return flagged.agg(F.count_if("is_gibberish").alias("gibberish"), F.count_if(~F.col("is_gibberish")).alias("kept"), F.count("*").alias("total"))
