"""Queries of the gibberish measures and of the filter."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusloom.functions import documents, text as T
from corpusloom.functions.profiles import ARABIC, LATIN, Profile
from corpusloom.operators import gibberish
from corpusloom.queries.common import AR, arabic_docs, docs, in_arabic, q, re2, sub


def _measure(column, name: str, arabic: bool = True):
    def run(spark, sf_dir: str) -> DataFrame:
        return (arabic_docs if arabic else docs)(spark, sf_dir).select("doc_id", column(F.col("text")).alias(name))

    return run


def _measure_sql(sql: str, name: str, arabic: bool = True) -> str:
    return f"SELECT doc_id, {sql} AS {name} FROM (SELECT doc_id, {AR if arabic else 'text'} AS text FROM documents)"


def _word_like(p: Profile) -> str:
    return f"CAST(len(regexp_extract_all(text, '{re2(f'[{p.block}]{{2,}}')}')) AS INTEGER)"


def _common(p: Profile) -> str:
    return f"CAST(len(list_intersect(list_distinct(regexp_extract_all(text, '{re2(f'[{p.block}]+')}')), [{', '.join(map(q, p.common))}])) AS INTEGER)"


def _share(p: Profile, more: str = "") -> str:
    return f"CASE WHEN text = '' THEN 0 ELSE length({sub('text', f'[^{p.block}]{more}', '')})::DOUBLE / length(text) END"


_MARKS = "CASE WHEN text = '' THEN 0 ELSE (length(text) - length(regexp_replace(text, '[!-/:-@\\[-`{-~]', '', 'g')))::DOUBLE / length(text) END"


def _runs(arabic: bool) -> str:
    """The longest of each character's last run, over the length."""
    return f"""
  SELECT t.doc_id, coalesce(max(last_run), 0)::DOUBLE / greatest(any_value(length(t.text)), 1) AS ratio
  FROM (SELECT doc_id, {AR if arabic else 'text'} AS text FROM documents) t LEFT JOIN (
    SELECT doc_id, ch, arg_max(run, upto) AS last_run FROM (
      SELECT doc_id, ch, count(*) AS run, max(i) AS upto FROM (
        SELECT doc_id, ch, i, i - row_number() OVER (PARTITION BY doc_id, ch ORDER BY i) AS g FROM (
          SELECT doc_id, unnest(regexp_extract_all({AR if arabic else 'text'}, '(?s).')) AS ch, unnest(range(1, length({AR if arabic else 'text'}) + 1)) AS i FROM documents))
      GROUP BY doc_id, ch, g) GROUP BY doc_id, ch) r ON r.doc_id = t.doc_id
  GROUP BY t.doc_id"""


def _flags(profile: Profile):
    def run(spark, sf_dir: str) -> DataFrame:
        d = (arabic_docs if profile is ARABIC else docs)(spark, sf_dir)
        return gibberish.flag_gibberish(d, profile).select("doc_id", "is_gibberish", "gibberish_reason")

    return run


def _flags_sql(p: Profile) -> str:
    arabic = p is ARABIC
    return f"""
SELECT doc_id, reason IS NOT NULL AS is_gibberish, reason AS gibberish_reason FROM (
  SELECT d.doc_id, CASE WHEN text = '' THEN 'empty' WHEN ratio > 0.25 THEN 'repeats' WHEN {_MARKS} > 0.15 THEN 'marks'
    WHEN {_word_like(p)} < 5 AND {_common(p)} < 3 THEN 'no_words' WHEN {_share(p)} <= 0.6 THEN 'not_script' END AS reason
  FROM (SELECT doc_id, {AR if arabic else 'text'} AS text FROM documents) d JOIN ({_runs(arabic)}) r ON r.doc_id = d.doc_id)"""


def flags_detected(spark, sf_dir: str) -> DataFrame:
    """As the source has it: the script's share after shaping, so that the detector decides for ordinary text."""
    d = gibberish.flag_gibberish(arabic_docs(spark, sf_dir), shaped=True, detector=documents.text_udf(spark, documents.main_script))
    return d.select("doc_id", "is_gibberish", "gibberish_reason")


def _with_common_arabic(c):
    """The Arabic view with frequent English words as frequent Arabic ones."""
    for latin, arabic in _SWAPPED.items():
        c = F.replace(c, F.lit(f" {latin} "), F.lit(f" {arabic} "))
    return in_arabic(c)


#: Every other word of Arabic's frequent ones stands for one of these.
_SWAPPED = dict(zip(("the", "of", "and", "a", "in", "la", "de", "der", "die", "que"), ARABIC.common[::2]))


def _common_arabic_sql() -> str:
    e = "text"
    for latin, arabic in _SWAPPED.items():
        e = f"replace({e}, ' {latin} ', ' {arabic} ')"
    return f"SELECT doc_id, {_common(ARABIC)} AS common FROM (SELECT doc_id, {AR.replace('text', e)} AS text FROM documents)"


def mixed_script(spark, sf_dir: str) -> DataFrame:
    """A third of the letters Arabic, or Cyrillic, by which of two vowels a text has more of; and some lines of their own."""
    extra = spark.sql("SELECT * FROM VALUES (-1L, ''), (-2L, '12 !?'), (-3L, 'پچژ گکی'), (-4L, 'αβγ def'), (-5L, 'שלום'), (-6L, '漢字 ab'), (-7L, 'жук bug') AS t(doc_id, text)")
    return docs(spark, sf_dir).select("doc_id", F.translate("text", _FEW, _OTHERS).alias("text")).unionByName(extra)


_FEW, _OTHERS = "etaoinsrh", "ابتثجحخДл"


def _script_sql() -> str:
    letters = "regexp_replace(text, '[^\\p{L}]', '', 'g')"
    names = sorted(T._SCRIPTS)
    counts = ", ".join(f"length(regexp_replace(l, '[^{re2(T._SCRIPTS[n])}]', '', 'g')) AS n_{n}" for n in names)
    top = "greatest(" + ", ".join(f"n_{n}" for n in names) + ")"
    cases = " ".join(f"WHEN n_{n} = {top} THEN " + (f"CASE WHEN len(regexp_extract_all(text, '[{T.PERSIAN}]')) > 0.08 * n_ar THEN 'fa' ELSE 'ar' END" if n == "ar" else f"'{n}'") for n in names)
    return f"SELECT doc_id, text, CASE WHEN {top} = 0 THEN NULL {cases} END AS language FROM (SELECT *, {counts} FROM (SELECT doc_id, text, {letters} AS l FROM d))"


_EXTRA = "(VALUES (-1, ''), (-2, '12 !?'), (-3, 'پچژ گکی'), (-4, 'αβγ def'), (-5, 'שלום'), (-6, '漢字 ab'), (-7, 'жук bug')) v(doc_id, text)"
_MIXED = f"SELECT doc_id, translate(text, '{_FEW}', '{_OTHERS}') AS text FROM documents UNION ALL SELECT * FROM {_EXTRA}"


def _detected_sql() -> str:
    return f"""
WITH d AS (SELECT doc_id, {AR} AS text FROM documents), g AS ({_script_sql()}), r AS ({_runs(True)})
SELECT doc_id, reason IS NOT NULL AS is_gibberish, reason AS gibberish_reason FROM (
  SELECT g.doc_id, CASE WHEN text = '' THEN 'empty' WHEN ratio > 0.25 THEN 'repeats' WHEN {_MARKS} > 0.15 THEN 'marks'
    WHEN {_word_like(ARABIC)} < 5 AND {_common(ARABIC)} < 3 THEN 'no_words'
    WHEN {_share(ARABIC, f"|[{T.SHAPED}]")} <= 0.6 AND coalesce(language, '') <> 'ar' THEN 'not_script' END AS reason
  FROM g JOIN r ON r.doc_id = g.doc_id)"""


QUERIES = {
    "char_last_run_ratio": _measure(T.last_run_ratio, "ratio"),
    "word_like_count": _measure(T.word_like_count, "word_like"),
    "common_words": _measure(lambda c: T.common_word_count(c, LATIN), "common", arabic=False),
    "script_ratio": _measure(T.script_share, "share"),
    "shaped_script_ratio": _measure(T.shaped_script_share, "share"),
    "punct_ratio": _measure(T.mark_share, "share", arabic=False),
    "gibberish_flags": _flags(ARABIC),
    "gibberish_flags_latin": _flags(LATIN),
    "gibberish_filter": lambda s, d: gibberish.drop_gibberish(gibberish.flag_gibberish(docs(s, d), LATIN)),
    "gibberish_counts": lambda s, d: gibberish.gibberish_counts(gibberish.flag_gibberish(docs(s, d), LATIN)),
    "common_words_arabic": lambda s, d: docs(s, d).select("doc_id", T.common_word_count(_with_common_arabic(F.col("text"))).alias("common")),
    "lang_detect": lambda s, d: mixed_script(s, d).select("doc_id", documents.text_udf(s, documents.main_script)(F.col("text")).alias("language")),
    "gibberish_flags_detected": flags_detected,
}

ORACLE_SQL = {
    "char_last_run_ratio": _runs(True),
    "word_like_count": _measure_sql(_word_like(ARABIC), "word_like"),
    "common_words": _measure_sql(_common(LATIN), "common", arabic=False),
    "script_ratio": _measure_sql(_share(ARABIC), "share"),
    "shaped_script_ratio": _measure_sql(_share(ARABIC, f"|[{T.SHAPED}]"), "share"),
    "common_words_arabic": _common_arabic_sql(),
    "lang_detect": f"WITH d AS ({_MIXED}) SELECT doc_id, language FROM ({_script_sql()})",
    "gibberish_flags_detected": _detected_sql(),
    "punct_ratio": _measure_sql(_MARKS, "share", arabic=False),
    "gibberish_flags": _flags_sql(ARABIC),
    "gibberish_flags_latin": _flags_sql(LATIN),
    "gibberish_filter": f"SELECT doc_id, text FROM documents JOIN ({_flags_sql(LATIN)}) USING (doc_id) WHERE NOT is_gibberish",
    "gibberish_counts": f"SELECT count(*) FILTER (is_gibberish) AS gibberish, count(*) FILTER (NOT is_gibberish) AS kept, count(*) AS total FROM ({_flags_sql(LATIN)})",
}
