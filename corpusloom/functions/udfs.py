"""Arrow-batched functions for what Spark has no expression for."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, SparkSession, functions as F

from corpusloom.plans.shared import ship


class _Texts(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[str] = []
        self.inside = self.dropped = 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.inside = 1
            self.dropped += 1

    def handle_startendtag(self, tag, attrs):
        self.dropped += tag in ("script", "style")

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.inside = 0

    def handle_data(self, data):
        if not self.inside:
            self.found.append(data)


def page_text(html: str | None) -> tuple[str | None, int]:
    """Text nodes outside scripts and styles, joined by one blank; how many of those elements there were. '' if it can't be parsed."""
    if html is None:
        return None, 0
    try:
        p = _Texts()
        p.feed(html)
        p.close()
    except Exception:  # noqa: BLE001  a document that can't be parsed is dropped, not the job
        return "", 0
    return " ".join(p.found), p.dropped


def html_text(spark: SparkSession):
    """Column function: html -> struct(text, scripts)."""
    ship(spark)

    @F.pandas_udf("text string, scripts int")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([page_text(x) for x in b], columns=["text", "scripts"])

    return texts


def nfkc_udf(spark: SparkSession):
    ship(spark)

    @F.pandas_udf("string")
    def composed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield b.map(lambda x: x if x is None else unicodedata.normalize("NFKC", x))

    return composed


def nfkc(spark: SparkSession):
    """Column function; rows of ASCII only never leave the JVM's value as they can't change."""
    composed = nfkc_udf(spark)

    def apply(c: Column) -> Column:
        ascii_only = c.rlike(r"\A[\x00-\x7F]*\z")
        return F.when(ascii_only, c).otherwise(composed(F.when(~ascii_only, c)))

    return apply


def detector(spark: SparkSession, function):
    """Column function text -> language, by a Python function; ``text.main_script`` needs none."""
    ship(spark)

    @F.pandas_udf("string")
    def language(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series([function(x) for x in b], dtype=object)

    return language
