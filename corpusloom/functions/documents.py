"""Whole documents cleaned, sifted and told apart in Arrow-batched Python: Java's patterns ask a class of characters range by range, Python's look a character up.

A document is one string in which U+FDD0 stands between sentences, and before and after each line break.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession, functions as F

from corpusloom.functions import text as T
from corpusloom.functions.profiles import WS, Profile
from corpusloom.plans.shared import ship

#: Characters of results that leave in one array.
TEXT_AT_ONCE = 1 << 20
#: White space but the line break.
_INLINE = WS.replace(r"\t-\r", r"\t\x0B-\r")
_LINES, _BLANKS = re.compile(r"\n{2,}"), re.compile(r"[ \t]{2,}|\t")
_EMAIL, _PHONE = re.compile(T.EMAIL.replace(T._EDGE, r"\b")), re.compile(T.PHONE)
_END, _DOTS_OR_END = re.compile(f"([.?!;؟؛])[{_INLINE}]+"), re.compile(T.SENTENCE_END.replace(WS, _INLINE))
COUNTS = ("n_sentences", "n_script", "n_kept", "n_masked", "n_marks_cut", "n_spans", "n_gaps")


def tidy(text: str) -> tuple[bool, str]:
    """Whether there are only line breaks; lines without white space at their ends, one blank for many."""
    text = text.replace(T.PART, "").replace(T.ELLIPSIS, "")
    if "\n\n" in text:
        text = _LINES.sub("\n", text)
    text = text.strip("\n")
    lines = "\n".join([x.strip() for x in text.split("\n")])
    return text == "", _BLANKS.sub(" ", lines) if "  " in lines or "\t" in lines else lines


def cleaner(profile: Profile, script_share: float, least_words: int) -> Callable[[bool, str], tuple]:
    """Function of what ``tidy`` gives -> COUNTS and the clean text. ``n_gaps``: its blanks and line breaks."""
    # A class first, so that the search leaps to its characters.
    mark = rf"[^\w{WS}{profile.block}{T.PART}{T.ELLIPSIS}]"
    marks = re.compile(f"({mark}{mark}{mark}){mark}+")
    far = f"[^{profile.block}0-9{T.PART}\\n]"
    spans = re.compile(f"{far}{far}{{29,}}")
    usual = re.compile(f"[{profile.inner}{profile.neutral}{WS}]+")

    def changed(a: str, b: str) -> int:
        return 0 if a == b else sum(x != y for x, y in zip(a.split(T.PART), b.split(T.PART), strict=True))

    def clean(empty: bool, lines: str) -> tuple:
        s0 = _DOTS_OR_END.sub(T.PART, lines) if "..." in lines else _END.sub(rf"\1{T.PART}", lines)
        breaks = lines.count("\n")
        if breaks:
            s0 = s0.replace("\n", f"{T.PART}\n{T.PART}")
        s1 = _EMAIL.sub("Example@mail.com", s0) if "@" in s0 else s0
        s1 = _PHONE.sub("+999-999-9999", s1) if "+" in s1 else s1
        s2 = marks.sub(r"\1", s1.replace("...", T.ELLIPSIS)).replace(T.ELLIPSIS, "...")
        s3, n_spans = spans.subn(" ", s2)
        # What counts as the script's is what is neither white space nor this, which is little.
        n_script, kept = 0, []
        for s, other in zip(s3.split(T.PART), usual.sub("", s3).split(T.PART), strict=True):
            if s == "\n":
                kept.append(s)
            elif s:
                words = s.split()
                n = len("".join(words))
                if (n - len(other)) / max(n, 1) >= script_share:
                    n_script += 1
                    if len(words) >= least_words:
                        kept.append(s)
        text = T.PART.join(kept).replace(f"{T.PART}\n", "\n").replace(f"\n{T.PART}", "\n")
        text = _LINES.sub("\n", text).strip("\n").replace(T.PART, " ")
        n = 0 if empty else s0.count(T.PART) + 1 - breaks
        return n, n_script, len(kept) - breaks, changed(s0, s1), changed(s1, s2), n_spans, text.count(" ") + text.count("\n"), text

    return clean


def _batches(kind: pa.StructType, of: Callable[..., tuple | None]):
    """Rows of Python values by ``of``, a few at a time, so that memory doesn't depend on how many texts come at once."""

    def run(*columns: pa.Array) -> pa.Array:
        done, rows, size = [], [], 0

        def flush() -> None:
            fields = list(zip(*(r if r is not None else (None,) * len(kind) for r in rows), strict=True))
            missing = pa.array([r is None for r in rows], pa.bool_())
            done.append(pa.StructArray.from_arrays([pa.array(x, f.type) for x, f in zip(fields, kind, strict=True)], fields=list(kind), mask=missing))
            rows.clear()

        for i in range(len(columns[0])):
            row = of(*(c[i].as_py() for c in columns))
            rows.append(row)
            size += len(row[-1]) if row is not None and row[-1] is not None else 0
            if size >= TEXT_AT_ONCE:
                flush()
                size = 0
        if rows:
            flush()
        return pa.concat_arrays(done) if done else pa.array([], kind)

    return run


def tidy_udf(spark: SparkSession):
    """Column function: text -> struct(empty, lines)."""
    ship(spark)

    @F.arrow_udf("empty boolean, lines string")
    def lines(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run = _batches(pa.struct([("empty", pa.bool_()), ("lines", pa.string())]), lambda t: None if t is None else tidy(t))
        for texts in batches:
            yield run(texts)

    return lines


def clean_udf(spark: SparkSession, profile: Profile, script_share: float, least_words: int, tidied: bool = False):
    """Column function: text -> struct of COUNTS and text; where ``tidied``, of (empty, lines)."""
    ship(spark)
    kind = pa.struct([*((n, pa.int32()) for n in COUNTS), ("text", pa.string())])

    def own() -> Callable[..., pa.Array]:
        clean = cleaner(profile, script_share, least_words)
        of = (lambda empty, lines: None if lines is None else clean(empty, lines)) if tidied else (lambda t: None if t is None else clean(*tidy(t)))
        return _batches(kind, of)

    if tidied:

        @F.arrow_udf(", ".join([*(f"{n} int" for n in COUNTS), "text string"]))
        def cleaned(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            run = own()
            for empty, lines in batches:
                yield run(empty, lines)
    else:

        @F.arrow_udf(", ".join([*(f"{n} int" for n in COUNTS), "text string"]))
        def cleaned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            run = own()
            for texts in batches:
                yield run(texts)

    # A filter on what it gives would otherwise be pushed below it, with a call of its own.
    return cleaned.asNondeterministic()


# --- functions of a text, each as the Column function in functions.text that it is named after --------------------------------


def squeeze(text: str) -> str:
    text = (_LINES.sub("\n", text) if "\n\n" in text else text).strip()
    return (_BLANKS.sub(" ", text) if "  " in text or "\t" in text else text).strip()


_SPLIT, _MARK_END = re.compile(T.SENTENCE_END), re.compile(f"([.?!;؟؛])[{WS}]+")


def sentences(text: str) -> list[str]:
    if "..." in text or T.PART in text:
        return _SPLIT.split(text)
    return _MARK_END.sub(rf"\1{T.PART}", text).split(T.PART)


def is_script_sentence(profile: Profile, threshold: float = 0.7) -> Callable[[str], bool]:
    other = re.compile(f"[^{profile.inner}{profile.neutral}]+")
    return lambda s: s != "" and len(other.sub("", s)) / max(len("".join(s.split())), 1) >= threshold


def is_long_sentence(least: int = 8) -> Callable[[str], bool]:
    return lambda s: len(s.split(None, least)) >= least


def _script_table() -> np.ndarray:
    """By code unit: 0 for no letter, 1 for a letter of no named script, or 2 more than the script's place by name; 128 more for a Persian letter."""
    blocks = [re.compile(f"[{T._SCRIPTS[n]}]") for n in sorted(T._SCRIPTS)]
    table = np.zeros(1 << 16, np.uint8)
    for i in range(1 << 16):
        c = chr(i)
        if unicodedata.category(c)[0] == "L":
            table[i] = next((k for k, b in enumerate(blocks, 2) if b.match(c)), 1)
        if c in T.PERSIAN:
            table[i] |= 128
    return table


def main_script(persian: float = 0.08) -> Callable[[str], str | None]:
    table, names = _script_table(), sorted(T._SCRIPTS)

    def of(text: str) -> str | None:
        # Halves of characters beyond the basic plane are no letters; no script that is told apart has any there.
        n = np.bincount(table[np.frombuffer(text.encode("utf-16-le"), np.uint16)], minlength=256)
        counts = (n[:128] + n[128:])[2 : 2 + len(names)]
        top = int(counts.argmax())
        if not counts[top]:
            return None
        return "fa" if names[top] == "ar" and n[128:].sum() > counts[top] * persian else names[top]

    return of


_OTHER, _LONG = re.compile(rf"[^{T.CHARSET}٠-٩0-9؟؛،.!?,;$% \n]"), re.compile(rf"([{T.LETTERS}ٱ])\1\1+")


def normalize_arabic(text: str) -> str:
    """With the compatibility form."""
    text = _LONG.sub(r"\1\1", unicodedata.normalize("NFKC", _OTHER.sub(" ", text)))
    return text.replace(T.TATWEEL, "").replace("?", "؟").replace(";", "؛").replace(",", "،")


def text_udf(spark: SparkSession, make: Callable[[], Callable[[str], str | None]]):
    """Column function text -> string by the Python function that ``make`` gives, made once per worker; null stays null."""
    ship(spark)

    @F.arrow_udf("string")
    def each(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        of = make()
        run = _batches(pa.struct([("text", pa.string())]), lambda t: (None if t is None or (got := of(t)) is None else got,))
        for texts in batches:
            yield run(texts).field("text")

    inner = each.asNondeterministic()
    return lambda c: inner(F.make_valid_utf8(c))


def kept_udf(spark: SparkSession, make: Callable[[], Callable[[str], bool]]):
    """Column function text -> struct(kept, text): how many of its sentences ``make``'s function keeps, and those."""
    ship(spark)
    kind = pa.struct([("kept", pa.int64()), ("text", pa.string())])

    @F.arrow_udf("kept bigint, text string")
    def each(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        keep = make()

        def of(text: str | None) -> tuple | None:
            if text is None:
                return None
            own = [s for s in sentences(squeeze(text)) if keep(s)]
            return len(own), " ".join(own)

        run = _batches(kind, of)
        for texts in batches:
            yield run(texts)

    inner = each.asNondeterministic()
    return lambda c: inner(F.make_valid_utf8(c))
