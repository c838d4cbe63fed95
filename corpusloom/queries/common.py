"""Tables, the Arabic view of data without Arabic, and pieces of SQL."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusloom.functions import text as T
from corpusloom.functions.profiles import Profile
from corpusloom.plans.shared import spread

LATIN_26, ARABIC_26 = "abcdefghijklmnopqrstuvwxyz", "ابتثجحخدذرزسشصضطظعغفقكلمنه"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def in_arabic(c: Column) -> Column:
    """Latin letters as Arabic ones: text that exercises the Arabic profile."""
    return F.translate(F.lower(c), LATIN_26, ARABIC_26)


def arabic_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).withColumn("text", in_arabic(F.col("text")))


def re2(pattern: str) -> str:
    """A Java pattern's escapes in RE2's notation, quoted for SQL."""
    return re.sub(r"\\u([0-9A-Fa-f]{4})", r"\\x{\1}", pattern).replace("'", "''")


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sub(e: str, pattern: str, to: str) -> str:
    return f"regexp_replace({e}, '{re2(pattern)}', '{to}', 'g')"


AR = f"translate(lower(text), '{LATIN_26}', '{ARABIC_26}')"


def sql_squeeze(e: str) -> str:
    return sub(sub(e, r"^\s+|\s+$", ""), r"[ \t]+", " ")


def sql_sentences(e: str) -> str:
    return f"string_split(regexp_replace({e}, '([.?!;؟؛])\\s+', '\\1' || chr(1), 'g'), chr(1))"


def sql_emails(e: str) -> str:
    return sub(e, r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b", "Example@mail.com")


def sql_phones(e: str) -> str:
    return sub(e, T.PHONE.replace("(?![0-9])", ""), "+999-999-9999")


def sql_marks(e: str, p: Profile) -> str:
    mark = rf"[^\p{{L}}\p{{N}}_\s{p.block}]"
    return sub(e, f"({mark}{{3}}){mark}+", r"\1")


def sql_spans(e: str, p: Profile) -> str:
    return sub(e, T.foreign_span(p), " ")


def sql_is_script(e: str, p: Profile) -> str:
    own = f"length({sub(e, f'[^{p.inner}{p.neutral}]', '')})"
    return f"({e} <> '' AND {own}::DOUBLE / greatest(length({sub(e, r'\s', '')}), 1) >= 0.7)"


def sql_is_long(e: str) -> str:
    return f"(len(regexp_extract_all({e}, '\\S+')) >= 8)"
