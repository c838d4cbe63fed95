"""Queries of Arabic normalisation, transliteration and the diacritization wrapper, over the Arabic view of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.functions import documents, metrics, tashkeel as K, text as T
from corpusloom.operators import diacritize as D
from corpusloom.plans.shared import ship
from corpusloom.queries.common import AR, ARABIC_26, LATIN_26, arabic_docs, docs, q, re2, sub, table

_ELONGATED = "".join(chr(c) for c in [*range(0x621, 0x63B), *range(0x641, 0x64B), 0x671])
_OTHER = rf"[^{T.CHARSET}٠-٩0-9؟؛،.!?,;$% \n]"
_FOREIGN = rf"[^{T.LETTERS}٠-٩0-9 \n،.؟!؛:?%$,;]"


def _arabic(function, before=lambda c: c):
    def run(spark, sf_dir: str) -> DataFrame:
        return arabic_docs(spark, sf_dir).select("doc_id", function(before(F.col("text"))).alias("text"))

    return run


def _sql(e: str, before: str = "text") -> str:
    return f"SELECT doc_id, {e} AS text FROM (SELECT doc_id, {before} AS text FROM (SELECT doc_id, {AR} AS text FROM documents))"


def _long(e: str) -> str:
    return f"list_reduce({[*_ELONGATED]}, lambda t, x: regexp_replace(t, x || '{{3,}}', x || x, 'g'), {e})"


def _kashida(e: str) -> str:
    return f"replace({e}, '{T.TATWEEL}', '')"


def _map(e: str) -> str:
    return f"translate({e}, '?;,', '؟؛،')"


def _core(e: str) -> str:
    return sub(sub(e, f"[{T.MARKS}{T.TATWEEL}]", ""), _FOREIGN, " ")


_MARKED = f"translate(text, {q(T.BW)}, {q(T.AR)})"
_BACK = f"translate({_MARKED}, {q(T.AR)}, {q(T.BW)})"


def _marked(spark, sf_dir: str) -> DataFrame:
    """Latin text read as Buckwalter: many of its letters become marks."""
    return docs(spark, sf_dir).withColumn("text", T.from_buckwalter(F.col("text")))


def _pairs(spark, sf_dir: str) -> DataFrame:
    return _marked(spark, sf_dir).select("doc_id", K.pairs(F.col("text")).alias("p"))


def letter_tag_pairs(spark, sf_dir: str) -> DataFrame:
    said = F.array_join(F.transform("p", lambda x: F.concat(x["letter"], F.lit(":"), x["tag"])), "|")
    return _pairs(spark, sf_dir).select("doc_id", F.size("p").cast("bigint").alias("n_pairs"), said.alias("pairs"))


def _units(e: str | None = None) -> str:
    e = e or _MARKED
    e = f"replace(replace({e}, '{T.TATWEEL}', ''), 'ٱ', 'ا')"
    e = sub(e, r"[^ء-غـ-ْٰٱﻻﻷﻵﻹ ]", " ")
    e = f"trim({sub(e, ' +', ' ')}, ' ')"
    e = f"replace(translate({e}, {q(T.AR)}, {q(T.BW)}), '`', '')"
    for v in "auiFNK":
        e = f"replace({e}, '{v}~', '~{v}')"
    for m in "FNKaui~o":
        e = f"replace({e}, '{m}{m}', '{m}')"
    return f"regexp_extract_all({e}, '[^FNKaiuo~](?:~[aiuFNK]|[FNKaiuo~])?')"


_TAG = "CASE x[2:] WHEN '' THEN '<NT>' " + " ".join(f"WHEN '{m}' THEN '{t}'" for t, m in K.DOUBLE.items()) + " ELSE x[2:] END"
_PAIRS_SQL = f"""SELECT doc_id, len(u) + 2 AS n_pairs, array_to_string(list_concat(['<BOS>:<BOS>'], list_transform(u, lambda x: x[1] || ':' || {_TAG}), ['<EOS>:<EOS>']), '|') AS pairs
  FROM (SELECT doc_id, {_units()} AS u FROM documents)"""


def _joined(ids) -> Column:
    return F.array_join(ids.cast("array<string>"), ",")


def _encoded(spark, sf_dir: str) -> DataFrame:
    return _marked(spark, sf_dir).select("doc_id", K.encode_text(spark)(K.buckwalter(F.col("text"))).alias("e"))


def encode_ids(spark, sf_dir: str) -> DataFrame:
    e = _encoded(spark, sf_dir)
    return e.select("doc_id", _joined(F.col("e.input_ids")).alias("input_ids"), _joined(F.col("e.target_ids")).alias("target_ids"))


def decode_ids(spark, sf_dir: str) -> DataFrame:
    """Encoded and decoded again."""
    d = _encoded(spark, sf_dir)
    return d.select("doc_id", K.decode(F.col("e.input_ids"), F.col("e.target_ids")).alias("text"))


def _two(spark, sf_dir: str) -> DataFrame:
    """Benchmark items as references, and with some marks changed as hypotheses."""
    b = table(spark, sf_dir, "benchmark").select("item_id", T.from_buckwalter(F.col("text")).alias("ref"), T.from_buckwalter(F.replace("text", F.lit("ha"), F.lit("hi"))).alias("hyp"))
    return b.select("item_id", "ref", "hyp", K.pairs(F.col("ref")).alias("r"), K.pairs(F.col("hyp")).alias("h"))


def _rated(spark, d: DataFrame, ref: Column, hyp: Column) -> DataFrame:
    return d.select("item_id", metrics.error_rates(spark)(ref, hyp).alias("e")).select("item_id", "e.distance", "e.ref_length", "e.error_rate")


def der(spark, sf_dir: str) -> DataFrame:
    return _rated(spark, _two(spark, sf_dir), K.tag_array(F.col("r")), K.tag_array(F.col("h")))


def der_no_case_endings(spark, sf_dir: str) -> DataFrame:
    return _rated(spark, _two(spark, sf_dir), *(K.tag_array(K.without_case_endings(F.col(c))) for c in "rh"))


def wer_marked(spark, sf_dir: str) -> DataFrame:
    """Word error rate of marked text: letters and marks combined again, then cut into words."""
    return _rated(spark, _two(spark, sf_dir), *(metrics.words(K.combine(F.col(c))) for c in "rh"))


def wer_marked_no_case_endings(spark, sf_dir: str) -> DataFrame:
    return _rated(spark, _two(spark, sf_dir), *(metrics.words(K.combine(K.without_case_endings(F.col(c)))) for c in "rh"))


def corpus_der(spark, sf_dir: str) -> DataFrame:
    d = _two(spark, sf_dir).agg(F.sum(metrics.tag_distance(F.col("r"), F.col("h"))).alias("distance"), F.sum(F.size("r")).alias("ref_length"))
    return d.select("distance", "ref_length", (F.col("distance") / F.col("ref_length")).alias("der"))


def _plain_pairs(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("ref"), F.replace("text", F.lit("th"), F.lit("t")).alias("hyp"))


def wer_breakdown(spark, sf_dir: str) -> DataFrame:
    rates = metrics.error_rates(spark)
    return _plain_pairs(spark, sf_dir).select("item_id", rates(metrics.words(F.col("ref")), metrics.words(F.col("hyp"))).alias("e")).select("item_id", "e.*")


def cer_breakdown(spark, sf_dir: str) -> DataFrame:
    rates = metrics.error_rates(spark)
    return _plain_pairs(spark, sf_dir).select("item_id", rates(metrics.characters(F.col("ref")), metrics.characters(F.col("hyp"))).alias("e")).select("item_id", "e.*")


def number_spans(spark, sf_dir: str) -> DataFrame:
    d = D.span_rows(docs(spark, sf_dir))
    vals = F.array_join(F.transform("numbers", lambda s: s["val"]), "|")
    return d.select("doc_id", F.size("numbers").cast("bigint").alias("n_numbers"), vals.alias("numbers"))


def symbol_expand(spark, sf_dir: str) -> DataFrame:
    bare = docs(spark, sf_dir).withColumn("text", F.translate("text", "0123456789", ""))
    return D.span_rows(bare).select("doc_id", F.size("symbols").cast("bigint").alias("n_symbols"), F.col("expanded").alias("text"))


_BARE = "translate(text, '0123456789', '')"
_SYMBOL = f"replace(replace(replace(replace({_BARE}, ' %', '%'), '%', ' في المئة'), ' $', '$'), '$', ' دولار')"


def _marked_twice(spark, sf_dir: str) -> DataFrame:
    """Marked text in which letters carry a shadda and a vowel, in the order that composition turns round."""
    return docs(spark, sf_dir).select("doc_id", T.from_buckwalter(F.replace("text", F.lit("e"), F.lit("b~a"))).alias("text"))


_PIECES = "array<string>"


def _pieces_udf(spark, function):
    ship(spark)

    @F.pandas_udf(_PIECES)
    def run(texts: D.pd.Series) -> D.pd.Series:
        return texts.map(function)

    return run


def split_punctuation(spark, sf_dir: str) -> DataFrame:
    """Marks that end a chunk, with the white space around them, as they stand at odd places; and what is between them."""
    pieces = _pieces_udf(spark, D.split_marks)
    d = arabic_docs(spark, sf_dir).select("doc_id", pieces(F.col("text")).alias("p"))
    at = lambda odd: F.filter("p", lambda x, i: i % 2 == odd)
    return d.select("doc_id", F.size(at(1)).cast("bigint").alias("n_marks"), F.array_join(at(1), "|").alias("marks"), F.array_join(at(0), "|").alias("between"))


def split_long(spark, sf_dir: str) -> DataFrame:
    """How the wrapper cuts each text for a tagger of 1,024 characters: too long chunks, and all that they hold but white space."""
    chunks = _pieces_udf(spark, lambda t: D.chunks(t)[::2])
    bare = F.translate("text", "0123456789", "")
    d = arabic_docs(spark, sf_dir).select("doc_id", chunks(D.normalised(bare)).alias("p"))
    return d.select("doc_id", F.size(F.filter("p", lambda x: F.length(x) > D.MOST)).alias("too_long"), F.regexp_replace(F.array_join("p", ""), r"\s+", "").alias("letters"))


def chunk_words(spark, sf_dir: str) -> DataFrame:
    """Words of each chunk where no punctuation helps: as many as fit, so that no two neighbours would fit together."""
    cut = _pieces_udf(spark, lambda t: D.split_long(t, 100))
    d = arabic_docs(spark, sf_dir).select("doc_id", F.regexp_replace("text", r"\s+", " ").alias("t")).filter(F.length("t") > 0)
    d = d.select("doc_id", cut(F.col("t")).alias("p"))
    loose = F.size(F.filter("p", lambda x, i: (F.length(x) + 1 + F.length(F.substring_index(F.coalesce(F.get("p", i + 1), F.lit("x" * 100)), " ", 1))) <= 100))
    return d.select("doc_id", F.array_join("p", " ").alias("text"), F.size(F.filter("p", lambda x: F.length(x) > 100)).alias("too_long"), loose.alias("loose"))


def diacritize_stub(spark, sf_dir: str) -> DataFrame:
    return D.diacritize(arabic_docs(spark, sf_dir)).select("doc_id", "diacritized_text", "diac_error")


def diacritize_words(spark, sf_dir: str) -> DataFrame:
    """A tagger that knows some words, as a table of them; texts without marks of their own and without numbers."""
    known = {w: w[0] + "\u064e" + w[1:] + "\u064f" for w in _KNOWN}
    plain = arabic_docs(spark, sf_dir).select("doc_id", F.trim(F.regexp_replace("text", "[^ابتثجحخدذرزسشصضطظعغفقكلمنه]+", " ")).alias("text"))
    return D.diacritize(plain, D.dictionary_tagger(known)).select("doc_id", "diacritized_text", "diac_error")


#: "the", "de" and "la" in the Arabic view.
_KNOWN = tuple("".join(dict(zip(LATIN_26, ARABIC_26))[c] for c in w) for w in ("the", "de", "la"))


def removal_counts(spark, sf_dir: str) -> DataFrame:
    said = lambda m: F.array_join(F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string"))), "|")
    return _marked(spark, sf_dir).select("doc_id", *(said(v).alias(k) for k, v in T.removal_counts(F.col("text")).items()))


_STUB = sub(sub(_core(sub(AR, "^ +| +$", "")), " {2,}", " "), "(^|[^0-9])0+([0-9])", r"\1\2")


QUERIES = {
    "non_script_blank": _arabic(T.blank_other),
    "elongation": _arabic(T.shorten_elongations),
    "kashida": _arabic(T.drop_tatweel, lambda c: F.replace(c, F.lit(" "), F.lit(T.TATWEEL + " "))),
    "punct_map": _arabic(T.arabic_marks),
    "normalize_chain": _arabic(T.normalize_arabic),
    "normalize_chain_nfkc": lambda s, d: _marked_twice(s, d).select("doc_id", documents.text_udf(s, lambda: documents.normalize_arabic)(F.col("text")).alias("text")),
    "persian_map": _arabic(T.core_letters, lambda c: F.translate(c, "كبج", "گپچ")),
    "keep_core": lambda s, d: _marked(s, d).select("doc_id", T.keep_core(F.col("text")).alias("text")),
    "removal_counts": removal_counts,
    "strip_marks": lambda s, d: _marked(s, d).select("doc_id", T.strip_marks(F.col("text")).alias("text")),
    "bw_to_arabic": lambda s, d: _marked(s, d),
    "bw_roundtrip": lambda s, d: _marked(s, d).select("doc_id", T.to_buckwalter(F.col("text")).alias("text")),
    "letter_tag_pairs": letter_tag_pairs,
    "encode_ids": encode_ids,
    "decode_ids": decode_ids,
    "case_endings": lambda s, d: _marked(s, d).select("doc_id", K.without_case_endings_text(K.buckwalter(F.col("text"))).alias("text")),
    "der": der,
    "der_no_case_endings": der_no_case_endings,
    "wer_marked": wer_marked,
    "wer_marked_no_case_endings": wer_marked_no_case_endings,
    "corpus_der": corpus_der,
    "diac_accuracy": lambda s, d: _two(s, d).select("item_id", K.mark_accuracy(F.col("r"), F.col("h")).alias("accuracy")),
    "wer_distance": lambda s, d: _plain_pairs(s, d).select("item_id", metrics.word_distance(F.col("ref"), F.col("hyp")).alias("distance"), F.size(metrics.words(F.col("ref"))).cast("bigint").alias("ref_length")),
    "wer_breakdown": wer_breakdown,
    "cer_distance": lambda s, d: _plain_pairs(s, d).select("item_id", metrics.char_distance(F.col("ref"), F.col("hyp")).alias("distance")),
    "cer_breakdown": cer_breakdown,
    "number_spans": number_spans,
    "symbol_expand": symbol_expand,
    "split_punctuation": split_punctuation,
    "split_long": split_long,
    "chunk_words": chunk_words,
    "diacritize_words": diacritize_words,
    "diacritize_stub": diacritize_stub,
}

_WORDS = "list_filter(string_split_regex({}, '\\s+'), lambda w: w <> '')"
_R, _H = _WORDS.format("text"), _WORDS.format("replace(text, 'th', 't')")
_SPELL = "array_to_string(list_transform({}, lambda w: chr(CAST(list_position(known, w) AS INTEGER))), '')"
_CHAIN = _map(_kashida(_long(sub("text", _OTHER, " "))))


def _histogram(e: str, pattern: str) -> str:
    found = f"regexp_extract_all({e}, '{re2(pattern)}')"
    return f"array_to_string(list_transform(list_sort(list_distinct({found})), lambda k: k || ':' || len(list_filter({found}, lambda x: x = k))), '|')"


def _ids(e: str, known: list[str]) -> str:
    names = "[" + ", ".join(map(q, known)) + "]"
    return f"array_to_string(list_transform({e}, lambda x: CAST(coalesce(list_position({names}, x), 0) - 1 AS VARCHAR)), ',')"


_ITEM_UNITS = f"SELECT item_id, {_units('translate(text, ' + q(T.BW) + ', ' + q(T.AR) + ')')} AS r, {_units('translate(replace(text, ' + q('ha') + ', ' + q('hi') + '), ' + q(T.BW) + ', ' + q(T.AR) + ')')} AS h FROM benchmark"
_ENDS = "list_concat(['<BOS>'], list_transform({u}, lambda x: {of}), ['<EOS>'])"


def _tags(u: str) -> str:
    return _ENDS.format(u=u, of=_TAG)


def _open(u: str) -> str:
    """Units without the mark before an unmarked blank."""
    return f"list_transform(range(1, len({u}) + 1), lambda i: CASE WHEN {u}[i + 1] = ' ' THEN {u}[i][1] ELSE {u}[i] END)"


def _rate_sql(ref: str, hyp: str) -> str:
    """Distance of two lists over their different members, each spelled as a character."""
    spell = "array_to_string(list_transform({}, lambda w: chr(CAST(64 + list_position(known, w) AS INTEGER))), '')"
    return f"""
SELECT item_id, distance, ref_length, CASE WHEN ref_length > 0 THEN 100.0::DOUBLE * distance / ref_length END AS error_rate FROM (
  SELECT item_id, CAST(levenshtein({spell.format('a')}, {spell.format('b')}) AS INTEGER) AS distance, len(a)::DOUBLE AS ref_length
  FROM (SELECT item_id, a, b, list_sort(list_distinct(list_concat(a, b))) AS known FROM (SELECT item_id, {ref} AS a, {hyp} AS b FROM ({_ITEM_UNITS}))))"""


def _words_of(u: str) -> str:
    return f"list_filter(string_split_regex(array_to_string({u}, ''), '\\s+'), lambda w: w <> '')"


_ACCURACY = f"""
SELECT item_id, CASE WHEN n > 0 THEN same / n::DOUBLE END AS accuracy FROM (
  SELECT item_id, len(m) AS n, len(list_filter(m, lambda i: a[i] = b[i])) AS same FROM (
    SELECT item_id, a, b, list_filter(range(1, least(len(a), len(b)) + 1), lambda i: a[i] NOT IN ('<BOS>', '<EOS>', '<NT>')) AS m FROM (SELECT item_id, {_tags('r')} AS a, {_tags('h')} AS b FROM ({_ITEM_UNITS}))))"""
_PUNCTUATION = "\\s*[،.؟!؛:?,;\\n]\\s*"
_WORDS_ONLY = f"trim(regexp_replace({AR}, '[^ابتثجحخدذرزسشصضطظعغفقكلمنه]+', ' ', 'g'), ' ')"
_DICTIONARY = "array_to_string(list_transform(string_split(t, ' '), lambda w: CASE WHEN w IN (" + ", ".join(map(q, _KNOWN)) + ") THEN w[1] || chr(1614) || w[2:] || chr(1615) ELSE w END), ' ')"

ORACLE_SQL = {
    "non_script_blank": _sql(sub("text", _OTHER, " ")),
    "elongation": _sql(_long("text")),
    "kashida": _sql(_kashida("text"), f"replace(text, ' ', '{T.TATWEEL} ')"),
    "punct_map": _sql(_map("text")),
    "normalize_chain": _sql(_CHAIN),
    # What the first step leaves has no compatibility characters, so the canonical form serves.
    "normalize_chain_nfkc": f"SELECT doc_id, {_map(_kashida(_long(f'nfc_normalize({sub("text", _OTHER, " ")})')))} AS text FROM (SELECT doc_id, translate(replace(text, 'e', 'b~a'), {q(T.BW)}, {q(T.AR)}) AS text FROM documents)",
    "removal_counts": f"SELECT doc_id, {_histogram('text', f'[{T.MARKS}]')} AS marks, {_histogram('text', T.TATWEEL)} AS tatweel, {_histogram(sub('text', f'[{T.MARKS}{T.TATWEEL}]', ''), _FOREIGN)} AS \"foreign\" FROM (SELECT doc_id, {_MARKED} AS text FROM documents)",
    "encode_ids": f"SELECT doc_id, {_ids(_ENDS.format(u='u', of='x[1]'), K.LETTERS)} AS input_ids, {_ids(_tags('u'), K.TAGS)} AS target_ids FROM (SELECT doc_id, {_units()} AS u FROM documents)",
    "decode_ids": f"SELECT doc_id, translate(array_to_string({_units()}, ''), {q(T.BW)}, {q(T.AR)}) AS text FROM documents",
    "case_endings": f"SELECT doc_id, array_to_string({_open('u')}, '') AS text FROM (SELECT doc_id, {_units()} AS u FROM documents)",
    "der": _rate_sql(_tags("r"), _tags("h")),
    "der_no_case_endings": _rate_sql(_tags(_open("r")), _tags(_open("h"))),
    "wer_marked": _rate_sql(_words_of("r"), _words_of("h")),
    "wer_marked_no_case_endings": _rate_sql(_words_of(_open("r")), _words_of(_open("h"))),
    "corpus_der": f"SELECT CAST(sum(distance) AS BIGINT) AS distance, CAST(sum(ref_length) AS BIGINT) AS ref_length, sum(distance) / sum(ref_length)::DOUBLE AS der FROM ({_rate_sql(_tags('r'), _tags('h'))})",
    "diac_accuracy": _ACCURACY,
    "split_long": f"SELECT doc_id, 0::INTEGER AS too_long, regexp_replace(regexp_replace({_core('t')}, '[،.؟!؛:?,;]', '', 'g'), '\\s+', '', 'g') AS letters FROM (SELECT doc_id, translate({AR}, '0123456789', '') AS t FROM documents)",
    "chunk_words": f"SELECT doc_id, trim(regexp_replace({AR}, '\\s+', ' ', 'g'), ' ') AS text, 0::INTEGER AS too_long, 0::INTEGER AS loose FROM documents WHERE text <> ''",
    "diacritize_words": f"SELECT doc_id, {_DICTIONARY} AS diacritized_text, CAST(NULL AS VARCHAR) AS diac_error FROM (SELECT doc_id, {_WORDS_ONLY} AS t FROM documents)",
    "persian_map": _sql("translate(text, 'ڤچگپۀ', 'فجكبه')", "translate(text, 'كبج', 'گپچ')"),
    "keep_core": f"SELECT doc_id, {_core('text')} AS text FROM (SELECT doc_id, {_MARKED} AS text FROM documents)",
    "strip_marks": f"SELECT doc_id, {sub('text', f'[{T.MARKS}ٱ]', '')} AS text FROM (SELECT doc_id, {_MARKED} AS text FROM documents)",
    "bw_to_arabic": f"SELECT doc_id, {_MARKED} AS text FROM documents",
    "bw_roundtrip": f"SELECT doc_id, {_BACK} AS text FROM documents",
    "letter_tag_pairs": _PAIRS_SQL,
    "wer_distance": f"SELECT item_id, CAST(levenshtein({_SPELL.format('r')}, {_SPELL.format('h')}) AS INTEGER) AS distance, len(r) AS ref_length FROM (SELECT item_id, r, h, list_distinct(list_concat(r, h)) AS known FROM (SELECT item_id, {_R} AS r, {_H} AS h FROM benchmark))",
    "cer_distance": "SELECT item_id, CAST(levenshtein(replace(text, ' ', ''), replace(replace(text, 'th', 't'), ' ', '')) AS INTEGER) AS distance FROM benchmark",
    "number_spans": "SELECT doc_id, len(n) AS n_numbers, array_to_string(list_transform(n, lambda x: regexp_replace(x, '^0+([0-9])', '\\1')), '|') AS numbers FROM (SELECT doc_id, regexp_extract_all(text, '[0-9]+') AS n FROM documents)",
    "symbol_expand": f"SELECT doc_id, len(regexp_extract_all(text, '[%$]')) AS n_symbols, {_SYMBOL} AS text FROM documents",
    "split_punctuation": f"SELECT doc_id, len(m) AS n_marks, array_to_string(m, '|') AS marks, regexp_replace(t, '{_PUNCTUATION}', '|', 'g') AS between FROM (SELECT doc_id, t, regexp_extract_all(t, '{_PUNCTUATION}') AS m FROM (SELECT doc_id, {AR} AS t FROM documents))",
    "diacritize_stub": f"SELECT doc_id, {_STUB} AS diacritized_text, CAST(NULL AS VARCHAR) AS diac_error FROM documents",
}
