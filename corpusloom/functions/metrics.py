"""Edit distances: totals as expressions, the breakdown by an Arrow-batched function."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, SparkSession, functions as F

from corpusloom.functions import tashkeel as K
from corpusloom.plans.shared import ship

#: Characters that stand for words: from U+4E00, then all from U+10000.
NEAR_SIGNS, FAR_SIGNS = 20_000, 0x100000

_ERROR = "insertions int, deletions int, substitutions int, distance int, ref_length double, error_rate double"


def edits(ref, hyp) -> tuple[int, int, int]:
    """Insertions, deletions and substitutions of a least-cost alignment; of equal ones that with most substitutions."""
    row = [(j, j, 0, 0) for j in range(len(hyp) + 1)]  # cost, insertions, deletions, substitutions
    for i, r in enumerate(ref, 1):
        new = [(i, 0, i, 0)]
        for j, h in enumerate(hyp, 1):
            if r == h:
                new.append(row[j - 1])
                continue
            d, u, left = row[j - 1], row[j], new[j - 1]
            new.append(min((d[0] + 1, 0, d[1], d[2], d[3] + 1), (u[0] + 1, 1, u[1], u[2] + 1, u[3]), (left[0] + 1, 2, left[1] + 1, left[2], left[3])))
            new[-1] = (new[-1][0], *new[-1][2:])
        row = new
    return row[-1][1:]


def error_rates(spark: SparkSession):
    """Column function (array of strings, array of strings) -> struct; the rate, in percent, is null for an empty reference."""
    ship(spark)

    @F.pandas_udf(_ERROR)
    def rates(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for refs, hyps in batches:
            out = []
            for r, h in zip(refs, hyps):
                if r is None or h is None:
                    out.append((None,) * 6)
                    continue
                i, d, s = edits(list(r), list(h))
                out.append((i, d, s, i + d + s, float(len(r)), 100.0 * (i + d + s) / len(r) if len(r) else None))
            f = pd.DataFrame(out, columns=["insertions", "deletions", "substitutions", "distance", "ref_length", "error_rate"])
            yield f.astype({c: "Int32" for c in f.columns[:4]} | {c: "Float64" for c in f.columns[4:]})

    return rates


def words(c: Column) -> Column:
    return F.filter(F.split(c, r"[\t-\r\x1C-\x20\x85\xA0]+", -1), lambda w: w != "")


def characters(c: Column) -> Column:
    bare = F.trim(F.replace(c, F.lit(" "), F.lit("")))
    return F.filter(F.split(bare, "", -1), lambda x: x != "")


def char_distance(ref: Column, hyp: Column) -> Column:
    """Edit distance after blanks are taken out."""
    return F.levenshtein(F.replace(ref, F.lit(" "), F.lit("")), F.replace(hyp, F.lit(" "), F.lit("")))


def word_distance(ref: Column, hyp: Column) -> Column:
    """Edit distance over words: each word that both have stands for one character, all others of a side for one.

    Words of one side alone match nothing, so which of them it is doesn't matter. With more words in common than there
    are characters (over a million) the query fails.
    """

    def distance(p: Column) -> Column:
        r, h, known = p["r"], p["h"], p["known"]

        def sign(w: Column, own: str) -> Column:
            at = F.array_position(known, w)
            far = F.decode(F.unhex(F.lpad(F.hex(at - NEAR_SIGNS - 1 + 0x10000), 8, "0")), "UTF-32")
            return F.when(at == 0, F.lit(own)).when(at <= NEAR_SIGNS, F.substring(signs, at.cast("int"), F.lit(1))).otherwise(far)

        spell = lambda ws, own: F.array_join(F.transform(ws, lambda w: sign(w, own)), "")
        many = F.size(known) > NEAR_SIGNS + FAR_SIGNS
        return F.when(many, F.raise_error(F.lit("more words in common than characters")).cast("int")).otherwise(F.levenshtein(spell(r, "r"), spell(h, "h")))

    signs = F.lit("".join(map(chr, range(0x4E00, 0x4E00 + NEAR_SIGNS))))
    r, h = words(ref), words(hyp)
    # The words are made once: within the lambda they are a value.
    pair = F.struct(r.alias("r"), h.alias("h"), F.array_intersect(r, h).alias("known"))
    return F.get(F.transform(F.array(pair), distance), F.lit(0))


def tag_distance(ref: Column, hyp: Column) -> Column:
    """Edit distance of two pair arrays' tags, their ends included."""
    signs = F.create_map(*(x for i, t in enumerate(K.TAGS) for x in (F.lit(t), F.lit(chr(0x4E00 + i)))))
    spell = lambda p: F.array_join(F.transform(K.tag_array(p), lambda t: F.try_element_at(signs, t)), "")
    return F.levenshtein(spell(ref), spell(hyp))
