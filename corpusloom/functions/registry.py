"""The text functions under names for SQL: expressions as SQL functions, so they stay in the JVM; others as Arrow-batched ones."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession, functions as F

from corpusloom.functions import text as T, udfs
from corpusloom.functions.profiles import ARABIC, Profile
from corpusloom.operators.urls import registered_domain


def expressions(profile: Profile = ARABIC) -> dict[str, tuple[str, str, Callable[..., Column]]]:
    """Name -> parameters, type of the result, Column function of the parameters."""
    return {
        "clean_whitespace": ("text STRING", "STRING", T.squeeze),
        "mask_emails": ("text STRING", "STRING", T.mask_emails),
        "mask_phones": ("text STRING", "STRING", T.mask_phones),
        "cut_mark_runs": ("text STRING", "STRING", lambda c: T.cut_mark_runs(c, profile)),
        "blank_foreign_spans": ("text STRING", "STRING", lambda c: T.blank_foreign_spans(c, profile)),
        "is_script_sentence": ("text STRING, threshold DOUBLE", "BOOLEAN", lambda c, t: T.is_script_sentence(c, profile, t)),
        "is_long_sentence": ("text STRING, least INT", "BOOLEAN", T.is_long_sentence),
        "word_like_count": ("text STRING", "INT", lambda c: T.word_like_count(c, profile)),
        "common_word_count": ("text STRING", "INT", lambda c: T.common_word_count(c, profile)),
        "script_share": ("text STRING", "DOUBLE", lambda c: T.script_share(c, profile)),
        "mark_share": ("text STRING", "DOUBLE", T.mark_share),
        "normalize_arabic": ("text STRING", "STRING", T.normalize_arabic),
        "core_letters": ("text STRING", "STRING", T.core_letters),
        "strip_marks": ("text STRING", "STRING", T.strip_marks),
        "keep_core": ("text STRING", "STRING", T.keep_core),
        "to_buckwalter": ("text STRING", "STRING", T.to_buckwalter),
        "from_buckwalter": ("text STRING", "STRING", T.from_buckwalter),
        "registered_domain": ("url STRING", "STRING", registered_domain),
    }


def _sql(spark: SparkSession, parameters: str, function: Callable[..., Column]) -> str:
    """The expression as SQL text, its parameters by their names."""
    names = [p.split()[0] for p in parameters.split(",")]
    made = spark.createDataFrame([], parameters).select(function(*map(F.col, names)).alias("made"))
    return made._jdf.queryExecution().analyzed().expressions().head().child().sql()


def register(spark: SparkSession, profile: Profile = ARABIC, prefix: str = "") -> list[str]:
    """Register all for the session's SQL, each under ``prefix`` and its name; the names."""
    for name, (parameters, kind, function) in (found := expressions(profile)).items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({parameters}) RETURNS {kind} RETURN CAST({_sql(spark, parameters, function)} AS {kind})")
    python = {"html_text": udfs.html_text(spark), "nfkc": udfs.nfkc_udf(spark)}
    for name, function in python.items():
        spark.udf.register(f"{prefix}{name}", function)
    return [prefix + name for name in (*found, *python)]
