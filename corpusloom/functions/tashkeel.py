"""Diacritized text as (letter, tag) pairs in Buckwalter notation, ids, and back; Column expressions, and one Arrow-batched function."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession, functions as F

from corpusloom.functions import text as T
from corpusloom.plans.shared import ship

_SPECIAL = ["<PAD>", "<BOS>", "<EOS>"]
# Letters and tags by their ids; the marks of a tag that stands for a shadda and a vowel.
LETTERS = [
    "<PAD>", "<BOS>", "<EOS>",
    " ", "$", "&", "'", "*", "<", ">", "A", "D", "E", "H", "S", "T", "Y", "Z",
    "b", "d", "f", "g", "h", "j", "k", "l", "m", "n", "p", "q", "r", "s", "t",
    "v", "w", "x", "y", "z", "|", "}", "<MASK>",
]
TAGS = ["<PAD>", "<BOS>", "<EOS>", "<NT>", "<SD>", "<SDD>", "<SF>", "<SFF>", "<SK>", "<SKK>", "F", "K", "N", "a", "i", "o", "u", "~"]
DOUBLE = {"<SD>": "~u", "<SDD>": "~N", "<SF>": "~a", "<SFF>": "~F", "<SK>": "~i", "<SKK>": "~K"}
NONE = "<NT>"
_VOWELS, _MARKS = "auiFNK", "FNKaiuo~"
#: Ids that are sent on together.
IDS_AT_ONCE = 1 << 20


def clean(c: Column) -> Column:
    """Without tatweel, wasla as plain alef; what is no Arabic letter or mark is a blank; blanks squeezed."""
    c = F.replace(F.replace(c, F.lit(T.TATWEEL), F.lit("")), F.lit("ٱ"), F.lit("ا"))
    c = F.regexp_replace(c, r"[^ء-غـ-ْٰٱﻻﻷﻵﻹ ]", " ")
    return F.trim(F.regexp_replace(c, " +", " "))


def shadda_first(bw: Column) -> Column:
    for v in _VOWELS:
        bw = F.replace(bw, F.lit(f"{v}~"), F.lit(f"~{v}"))
    return bw


def _plain(c: Column) -> Column:
    bw = shadda_first(F.replace(T.to_buckwalter(clean(c)), F.lit("`"), F.lit("")))
    for m in "FNKaui~o":
        bw = F.replace(bw, F.lit(m * 2), F.lit(m))
    return bw


def buckwalter(c: Column) -> Column:
    """``combine`` of ``pairs`` as one string, without an array: letters in Buckwalter, each with its mark or shadda and vowel."""
    return F.regexp_replace(_plain(c), rf"\A[{_MARKS}]+|([^{_MARKS}](?:~[{_VOWELS}]|[{_MARKS}])?+)[{_MARKS}]+", "$1")


def without_case_endings_text(bw: Column) -> Column:
    """``without_case_endings`` of such a string: the mark before each unmarked blank goes."""
    return F.regexp_replace(bw, rf"(?<=[^{_MARKS}])(?:~[{_VOWELS}]|[{_MARKS}])(?= (?![{_MARKS}]))", "")


def encode_text(spark: SparkSession):
    """Column function: such a string -> struct<input_ids, target_ids>, as ``encode`` of its pairs; a text at a time, as arrays of numbers.

    The ids leave in batches of about a million, so memory doesn't depend on how many texts come at once.
    """
    ship(spark)
    @F.arrow_udf("struct<input_ids: array<int>, target_ids: array<int>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        letters, single, double = (np.full(129, n, np.int32) for n in (-1, -1, -1))
        for i, x in enumerate(LETTERS):
            if len(x) == 1:
                letters[ord(x)] = i
        for i, x in enumerate(TAGS):
            if len(x) == 1:
                single[ord(x)] = i
        for tag, marks in DOUBLE.items():
            double[ord(marks[1])] = TAGS.index(tag)
        bos, eos, none = LETTERS.index("<BOS>"), LETTERS.index("<EOS>"), TAGS.index(NONE)

        def ids(text: str | None) -> tuple[np.ndarray, np.ndarray]:
            if text is None:
                return letters[:0], letters[:0]
            codes = np.minimum(np.frombuffer(f"{text}\uffff\uffff".encode("utf-32-le"), np.uint32), 128)
            at = np.flatnonzero(single[codes[:-2]] < 0)
            first, second = codes[at + 1], codes[at + 2]
            tag = np.where((first == ord("~")) & (double[second] >= 0), double[second], np.where(single[first] < 0, none, single[first]))
            return np.concatenate([[bos], letters[codes[at]], [eos]]), np.concatenate([[bos], tag, [eos]])

        def lists(of: list[np.ndarray]) -> pa.Array:
            ends = np.concatenate([[0], np.cumsum([len(x) for x in of])]).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(of).astype(np.int32)))

        def rows(made: list[tuple[np.ndarray, np.ndarray]]) -> pa.Array:
            null = pa.array([not len(x) for x, _ in made])
            return pa.StructArray.from_arrays([lists([x for x, _ in made]), lists([y for _, y in made])], ["input_ids", "target_ids"], mask=null)

        for texts in batches:
            made, size = [], 0
            for text in texts:
                made.append(ids(text.as_py()))
                size += len(made[-1][0])
                if size >= IDS_AT_ONCE:
                    yield rows(made)
                    made, size = [], 0
            if made:
                yield rows(made)

    return run


def pairs(c: Column) -> Column:
    """array<struct<letter, tag>> from <BOS> to <EOS>. A mark without a letter before it is dropped."""
    bw = _plain(c)
    tags = F.create_map(*(F.lit(x) for tag, marks in DOUBLE.items() for x in (marks, tag)))
    units = F.regexp_extract_all(bw, F.lit(r"([^FNKaiuo~])(~[aiuFNK]|[FNKaiuo~])?"), F.lit(0))

    def unit(u: Column) -> Column:
        marks = F.substring(u, 2, 2)
        return F.struct(F.substring(u, 1, 1).alias("letter"), F.when(marks == "", F.lit(NONE)).otherwise(F.coalesce(F.try_element_at(tags, marks), marks)).alias("tag"))

    ends = [F.array(F.struct(F.lit(x).alias("letter"), F.lit(x).alias("tag"))) for x in ("<BOS>", "<EOS>")]
    return F.when(c.isNotNull(), F.concat(ends[0], F.transform(units, unit), ends[1]))


def combine(p: Column) -> Column:
    """Letters and marks in Buckwalter; special ones at the ends are left out."""
    marks = F.create_map(*(F.lit(x) for tag, m in [*DOUBLE.items(), (NONE, "")] for x in (tag, m)))
    inner = F.filter(p, lambda x: ~x["letter"].isin(*_SPECIAL))
    return F.array_join(F.transform(inner, lambda x: F.concat(x["letter"], F.coalesce(F.try_element_at(marks, x["tag"]), x["tag"]))), "")


def encode(p: Column) -> Column:
    """struct<input_ids, target_ids>; an unknown letter or tag has id -1."""
    def ids(field: str, known: list[str]) -> Column:
        vocabulary = F.array(*map(F.lit, known))
        return F.transform(p, lambda x: (F.array_position(vocabulary, x[field]) - 1).cast("int"))

    return F.struct(ids("letter", LETTERS).alias("input_ids"), ids("tag", TAGS).alias("target_ids"))


def decode(input_ids: Column, target_ids: Column) -> Column:
    """Arabic text. Ends are taken off letters and tags by themselves; a <BOS> or <EOS> tag inside means no mark."""
    letters, tags = F.array(*map(F.lit, LETTERS)), F.array(*map(F.lit, TAGS))
    found = F.filter(F.transform(input_ids, lambda i: F.get(letters, i)), lambda x: ~x.isin(*_SPECIAL))
    n = F.size(target_ids)
    named = F.transform(
        target_ids,
        lambda i, at: F.when(((F.get(tags, i) == "<BOS>") & (at != 0)) | ((F.get(tags, i) == "<EOS>") & (at != n - 1)), F.lit(NONE)).otherwise(F.get(tags, i)),
    )
    named = F.filter(named, lambda x: ~x.isin(*_SPECIAL))
    zipped = F.filter(F.zip_with(found, named, lambda a, b: F.struct(a.alias("letter"), b.alias("tag"))), lambda x: x["letter"].isNotNull() & x["tag"].isNotNull())
    return T.from_buckwalter(combine(zipped))


def without_case_endings(p: Column) -> Column:
    """The tag before each unmarked blank cleared; the last word keeps its ending."""
    blank = F.struct(F.lit(" ").alias("letter"), F.lit(NONE).alias("tag"))
    return F.transform(p, lambda x, i: F.when(F.get(p, i + 1) == blank, F.struct(x["letter"].alias("letter"), F.lit(NONE).alias("tag"))).otherwise(x))


def tag_array(p: Column) -> Column:
    return F.transform(p, lambda x: x["tag"])


def mark_accuracy(ref: Column, hyp: Column) -> Column:
    """Share of the reference's marked letters whose tag the other has at the same place; null without any."""
    n = F.least(F.size(ref), F.size(hyp))
    both = F.zip_with(F.slice(ref, F.lit(1), n), F.slice(hyp, F.lit(1), n), lambda a, b: F.struct(a["tag"].alias("r"), b["tag"].alias("h")))
    marked = F.filter(both, lambda x: ~x["r"].isin("<BOS>", "<EOS>", NONE))
    return F.try_divide(F.size(F.filter(marked, lambda x: x["r"] == x["h"])), F.size(marked))
