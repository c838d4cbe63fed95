"""Diacritization around an injected tagger: numbers and symbols are spelled out, chunks tagged, and the originals put back.

The tagger is a Python function list[str] -> list[str] that only adds marks. It is made once per worker by ``make_tagger``.
A row that fails has its error in ``diac_error`` and null text; no other row is touched.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.functions import text as T
from corpusloom.plans.shared import ship

MOST = 1024
#: Characters of texts that are worked on at once.
TEXT_AT_ONCE = 1 << 20
_ONES = "صفر واحد اثنان ثلاثة أربعة خمسة ستة سبعة ثمانية تسعة عشرة".split() + ["أحد عشر", "اثنا عشر"] + [f"{x} عشر" for x in "ثلاثة أربعة خمسة ستة سبعة ثمانية تسعة".split()]
_TENS = ["", "", *"عشرون ثلاثون أربعون خمسون ستون سبعون ثمانون تسعون".split()]
_HUNDREDS = ["", "مئة", "مئتان", *"ثلاثمئة أربعمئة خمسمئة ستمئة سبعمئة ثمانمئة تسعمئة".split()]
_SCALES = [None, ("ألف", "ألفان", "آلاف"), ("مليون", "مليونان", "ملايين"), ("مليار", "ملياران", "مليارات"), ("تريليون", "تريليونان", "تريليونات")]
_SYMBOLS = {"%": "في المئة", "$": "دولار"}
_MARK = re.compile("[ً-ْٰ]")
_PUNCTUATION = re.compile(r"(\s*[،.؟!؛:?,;\n]\s*)")


def spell(n: int) -> str:
    """A number below 10^15 in Arabic words, unmarked."""
    if n < 20:
        return _ONES[n]
    groups, scale = [], 0
    while n:
        n, g = divmod(n, 1000)
        if g:
            groups.append((g, scale))
        scale += 1
    out = []
    for g, s in reversed(groups):
        if s and g < 3:
            out.append(_SCALES[s][g - 1])
            continue
        h, r = divmod(g, 100)
        parts = [_HUNDREDS[h]] if h else []
        if r >= 20:
            t, o = divmod(r, 10)
            parts += [_ONES[o]] if o else []
            parts.append(_TENS[t])
        elif r:
            parts.append(_ONES[r])
        word = " و".join(parts)
        out.append(f"{word} {_SCALES[s][2 if 3 <= g <= 10 else 0]}" if s else word)
    return " و".join(out)


Span = tuple[int, int, str]


def _expand(raw: str, pattern: str, word: Callable[[re.Match, str], str], value: Callable[[str], str]) -> tuple[str, list[Span]]:
    parts, spans, at, size = [], [], 0, 0
    for m in re.finditer(pattern, raw):
        before = raw[at : m.start()]
        new = word(m, before)
        size += len(before)
        spans.append((size, size + len(new), value(m.group())))
        parts += [before, new]
        size += len(new)
        at = m.end()
    return "".join([*parts, raw[at:]]), spans


def plain_digits(digits: str) -> str:
    """Digits of any script as ASCII ones without leading zeros; a run of any length."""
    return "".join(str(unicodedata.decimal(d)) for d in digits).lstrip("0") or "0"


def spell_digits(digits: str) -> str:
    return spell(int(digits)) if len(digits) <= 15 else " ".join(_ONES[int(d)] for d in digits)


def expand_numbers(raw: str) -> tuple[str, list[Span]]:
    """Each run of digits as words; spans (start, end, number) in the new text."""
    return _expand(raw, r"\d+", lambda m, _: spell_digits(plain_digits(m.group())), plain_digits)


def expand_symbols(raw: str) -> tuple[str, list[Span]]:
    """% and $ as words after a blank, which belongs to the span if it wasn't there."""
    return _expand(raw, r"[%$]", lambda m, b: ("" if b.endswith(" ") else " ") + _SYMBOLS[m.group()], str)


def split_marks(text: str) -> list[str]:
    """Text at even places, punctuation with the white space around it at odd ones."""
    return _PUNCTUATION.split(text)


def cut_long(text: str, most: int) -> list[str]:
    """Whole words, as many as fit, at even places, the white space between them at odd ones; a longer word in parts with nothing between."""
    out, now, gap = [], "", ""
    for w in re.findall(r"\s+|\S+", text):
        if w.isspace():
            gap = w
        elif now and len(now) + len(gap) + len(w) <= most:
            now += gap + w
        else:
            out += [now, gap] if now else []
            parts = [w[i : i + most] for i in range(0, len(w), most)]
            for part in parts[:-1]:
                out += [part, ""]
            now = parts[-1]
    return [*out, now]


def split_long(text: str, most: int) -> list[str]:
    """Whole words, as many as fit, with single blanks; a longer word in parts."""
    words = text.split()
    return cut_long(" ".join(words), most)[::2] if words else []


def chunks(text: str, most: int = MOST) -> list[str]:
    """What the tagger gets at even places, what joins it at odd ones; together they are the text."""
    out: list[str] = []
    for i, piece in enumerate(split_marks(text)):
        bare = piece.strip()
        if i % 2 or len(piece) <= most or not bare:
            out.append(piece)
            continue
        at = piece.index(bare)
        before, after = piece[:at], piece[at + len(bare) :]
        out += [*(["", before] if before else []), *cut_long(bare, most), *([after, ""] if after else [])]
    return out


def align(bare: str, marked: str) -> list[int]:
    """For each character of ``bare`` that is no mark its place in ``marked``; -1 for marks. Raises where they differ."""
    places, i = [], 0
    for ch in bare:
        if _MARK.match(ch):
            places.append(-1)
            continue
        while i < len(marked) and _MARK.match(marked[i]):
            i += 1
        if i == len(marked) or marked[i] != ch:
            raise ValueError(f"letter {len(places)} is {ch!r} but {marked[i]!r} after tagging" if i < len(marked) else f"text ends at letter {len(places)} of {len(bare)} after tagging")
        places.append(i)
        i += 1
    return places


def restore(marked: str, spans: list[Span], places: list[int]) -> str:
    """The spans' words, with marks that follow them, replaced by what they stood for."""
    out, at = [], 0
    for start, end, value in spans:
        stop = places[end - 1] + 1
        while stop < len(marked) and _MARK.match(marked[stop]):
            stop += 1
        out += [marked[at : places[start]], value]
        at = stop
    return "".join([*out, marked[at:]])


def prepare(raw: str) -> tuple[str, str, list[Span], list[Span], list[str]]:
    with_numbers, numbers = expand_numbers(raw)
    full, symbols = expand_symbols(with_numbers)
    return with_numbers, full, numbers, symbols, chunks(full)


def finish(prepared: tuple, tagged: list[str]) -> str:
    with_numbers, full, numbers, symbols, parts = prepared
    marked = "".join(tagged[i // 2] if i % 2 == 0 else p for i, p in enumerate(parts))
    marked = restore(marked, symbols, align(full, marked))
    return restore(marked, numbers, align(with_numbers, marked))


def normalised(c: Column) -> Column:
    """What the tagger's text is made of: core letters, no marks, single blanks."""
    edge = F.regexp_replace(c, r"\A +| +\z", "")
    return F.regexp_replace(T.keep_core(T.core_letters(edge)), " {2,}", " ")


def identity_tagger() -> Callable[[list[str]], list[str]]:
    return lambda texts: list(texts)


def dictionary_tagger(words: dict[str, str]):
    """A tagger by known words; others stay bare. It trims, as taggers with a tokenizer do."""
    def make() -> Callable[[list[str]], list[str]]:
        return lambda texts: [" ".join(words.get(w, w) for w in t.split()) for t in texts]

    return make


def _attempt(function, *args):
    """What it returns and no error, or none and its error: one row's failure must not lose the others."""
    try:
        return function(*args), None
    except Exception as e:  # noqa: BLE001
        return None, f"{type(e).__name__}: {e}"


def _tag_rows(tagger, rows: list[list[str]], batch: int) -> list[tuple[list[str] | None, str | None]]:
    """Tagged chunks of each row. Chunks of several rows go to the tagger together; where that fails, row by row."""

    def tag(todo: list[str]) -> list[str]:
        out: list[str] = []
        for i in range(0, len(todo), batch):
            out += tagger(todo[i : i + batch])
        return out

    together, error = _attempt(tag, [c for r in rows for c in r])
    if error:
        return [_attempt(tag, r) for r in rows]
    ends = list(accumulate(map(len, rows)))
    return [(together[e - len(r) : e], None) for r, e in zip(rows, ends)]


def by_size(texts: pd.Series, most: int | None = None) -> Iterator[pd.Series]:
    """A batch in parts of about ``most`` characters (TEXT_AT_ONCE without it), or of one text, so that memory doesn't depend on how many texts come at once."""
    at = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t is not None else 0
        if i > at and size + n > (most or TEXT_AT_ONCE):
            yield texts.iloc[at:i]
            at, size = i, 0
        size += n
    if at < len(texts):
        yield texts.iloc[at:]


def diacritize(docs: DataFrame, make_tagger=identity_tagger, text_col: str = "text", batch: int = 128) -> DataFrame:
    """``docs`` with diacritized_text and diac_error. Chunks of some rows go to the tagger together."""
    ship(docs.sparkSession)

    @F.pandas_udf("diacritized_text string, diac_error string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tagger = make_tagger()
        for texts in (part for whole in batches for part in by_size(whole)):
            ready = [(None, None) if t is None else _attempt(prepare, t) for t in texts]
            tagged = iter(_tag_rows(tagger, [r[4][::2] for r, _ in ready if r], batch))
            out = []
            for r, error in ready:
                if r:
                    done, error = next(tagged)
                    done, error = (None, error) if error else _attempt(finish, r, done)
                out.append((done if r else None, error))
            yield pd.DataFrame(out, columns=["diacritized_text", "diac_error"], dtype=object)

    return docs.withColumn("_d", run(normalised(F.col(text_col)))).select(*docs.columns, "_d.diacritized_text", "_d.diac_error")


def span_rows(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the expanded text and its spans of numbers and symbols, as arrays of structs."""
    ship(docs.sparkSession)
    span = "array<struct<start: int, end: int, val: string>>"

    @F.pandas_udf(f"expanded string, numbers {span}, symbols {span}")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        def named(spans):
            return [{"start": a, "end": b, "val": v} for a, b, v in spans]

        for texts in (part for whole in batches for part in by_size(whole)):
            out = []
            for t in texts:
                _, full, numbers, symbols, _ = prepare(t or "")
                out.append((full, named(numbers), named(symbols)))
            yield pd.DataFrame(out, columns=["expanded", "numbers", "symbols"])

    return docs.withColumn("_s", run(F.col(text_col))).select(*docs.columns, "_s.expanded", "_s.numbers", "_s.symbols")
