"""Near-duplicates by MinHash and locality-sensitive bands. A text's tokens and minima are one Arrow-batched function, bands are expressions.

Texts of equal signature are one class, represented by its smallest id, so that copies are never paired with each other:
pairs are between representatives, and ``membership`` has a row per document.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusloom.functions.profiles import WORD, WS
from corpusloom.plans.components import components
from corpusloom.plans.keys import join_per_key
from corpusloom.plans.shared import save, ship
from corpusloom.sources import files

PRIME, PERMUTATIONS, BANDS, ROWS = (1 << 31) - 1, 32, 8, 4
HASHES_AT_ONCE = 1 << 14
#: Words whose hashes are remembered at once.
WORDS_KNOWN = 1 << 17
_NO_WORD = re.compile(r"\W+")
_draw = random.Random(20240607)
A = [_draw.randrange(1, PRIME) for _ in range(PERMUTATIONS)]
B = [_draw.randrange(0, PRIME) for _ in range(PERMUTATIONS)]


def word_tokens(c: Column) -> Column:
    """Words without punctuation and Arabic marks, case kept."""
    return F.regexp_extract_all(F.regexp_replace(c, f"[^{WORD}{WS}]+", ""), F.lit(f"[^{WS}]+"), F.lit(0))


def char_tokens(c: Column) -> Column:
    """Distinct letters, digits and underscores: all that is left if a text is taken for a list of texts."""
    return F.array_distinct(F.regexp_extract_all(c, F.lit(f"[{WORD}]"), F.lit(0)))


def _hash(token: str) -> int:
    """32 bits of a token's SHA-1."""
    return int.from_bytes(hashlib.sha1(token.encode()).digest()[:4], "big")


def _bare(word: str) -> str:
    return word if word.isalnum() else _NO_WORD.sub("", word)


def _word_hashes() -> Callable[[str], set[int]]:
    """Function text -> hashes of its different words. Frequent words come again and again: those of late are remembered."""
    known: dict[str, int | None] = {}
    before: dict[str, int | None] = {}

    def of(text: str) -> set[int]:
        nonlocal known, before
        if len(known) > WORDS_KNOWN:
            known, before = {}, known
        found = set()
        for w in set(text.split()):
            h = known.get(w, -1)
            if h == -1:
                h = before.get(w, -1)
                if h == -1:
                    h = _hash(bare) if (bare := _bare(w)) else None
                known[w] = h
            found.add(h)
        found.discard(None)
        return found

    return of


def _char_hashes() -> Callable[[str], set[int]]:
    return lambda text: {_hash(c) for c in set(text) if c.isalnum() or c == "_"}


def _shingle_hashes(n: int = 5) -> Callable[[str], set[int]]:
    def of(text: str) -> set[int]:
        words = [bare for w in text.split() if (bare := _bare(w))]
        return {_hash(" ".join(words[i : i + n])) for i in range(max(1, len(words) - n + 1))}

    return of


def _rest(x: np.ndarray) -> np.ndarray:
    """x mod 2^31 - 1 for x from 0 below 2^63, in place and without division."""
    for _ in range(2):
        high = x >> 31
        x &= PRIME
        x += high
    # Now below 2 (2^31 - 1); a difference below zero is, unsigned, the larger one.
    return np.minimum(x.view(np.uint64), (x - PRIME).view(np.uint64)).view(np.int64)


def minima(sets: list[set[int]]) -> np.ndarray:
    """(32, texts): of each text's hashes the minima of (a h + b) mod 2^31 - 1; without hashes all are 2^31 - 1."""
    at = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int64)
    h = np.fromiter(chain.from_iterable(sets), np.int64, int(at[-1]))
    out = np.full((PERMUTATIONS, len(sets)), PRIME, np.int64)
    a, b = np.array(A, np.int64)[:, None], np.array(B, np.int64)[:, None]
    i = 0
    while i < len(sets):  # as many texts as have some hashes together
        j = max(i + 1, int(np.searchsorted(at, at[i] + HASHES_AT_ONCE, "right")) - 1)
        full = i + np.flatnonzero(at[i + 1 : j + 1] > at[i:j])
        if len(full):
            out[:, full] = np.minimum.reduceat(_rest(h[at[i] : at[j]] * a + b), at[full] - at[i], axis=1)
        i = j
    return out


def sketch(spark: SparkSession, tokens: str):
    """Column function: text -> its 32 minima. A text's tokens are made, hashed and forgotten again, a few texts at a time."""
    ship(spark)
    made = {"word": _word_hashes, "char": _char_hashes, "shingle": _shingle_hashes}[tokens]

    @F.arrow_udf("array<bigint>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes = made()
        for texts in batches:
            done, sets, size = [], [], 0
            for i in range(len(texts)):
                sets.append(hashes(texts[i].as_py()))
                size += len(sets[-1])
                if size >= HASHES_AT_ONCE:
                    done.append(minima(sets))
                    sets, size = [], 0
            out = np.concatenate([*done, minima(sets)], axis=1)
            yield pa.ListArray.from_arrays(pa.array(np.arange(0, PERMUTATIONS * (len(texts) + 1), PERMUTATIONS, dtype=np.int32)), pa.array(out.T.ravel()))

    # A filter on what it gives would otherwise be pushed below it, with a call of its own.
    return run.asNondeterministic()


def signatures(docs: DataFrame, id_col: str = "unique_id", text_col: str = "text", tokens: str = "word", order_col: str | None = None) -> DataFrame:
    """(unique_id, sig). ``tokens``: word, char or shingle. A null text counts as empty.

    With ``order_col`` a repeated id has one signature, that of its last row in that order; otherwise one for each row.
    """
    if id_col not in docs.columns:
        raise ValueError(f"no column {id_col}: this table is to be skipped")
    order = [F.col(order_col).alias("_order")] if order_col else []
    # Bytes that are no UTF-8 are replaced, as Python can't take them.
    text = F.make_valid_utf8(F.coalesce(F.col(text_col), F.lit("")))
    made = docs.select(F.col(id_col).alias("unique_id"), sketch(docs.sparkSession, tokens)(text).alias("sig"), *order)
    return made.groupBy("unique_id").agg(F.max_by("sig", "_order").alias("sig")) if order else made


def band_hashes(sig: Column) -> Column:
    return F.array(*(F.xxhash64(F.lit(i), *(F.get(sig, F.lit(i * ROWS + j)) for j in range(ROWS))) for i in range(BANDS)))


def bands(sigs: DataFrame) -> DataFrame:
    """(band, bucket, unique_id), the index as a table."""
    return sigs.select("unique_id", F.posexplode(band_hashes(F.col("sig"))).alias("band", "bucket"))


def classes(sigs: DataFrame) -> DataFrame:
    """(rep, sig, members): texts of equal signature."""
    return sigs.groupBy("sig").agg(F.min("unique_id").alias("rep"), F.count("*").alias("members"))


def membership(sigs: DataFrame) -> DataFrame:
    """(unique_id, rep)."""
    s = save(sigs.select("unique_id", "sig", F.xxhash64("sig").alias("h")), "signatures")
    c = save(s.groupBy("h", "sig").agg(F.min("unique_id").alias("rep"), F.count("*").alias("n")), "classes")
    return join_per_key(s, c, ["h", "sig"], "n", s.count()).select("unique_id", "rep")


def estimate(a: Column, b: Column) -> Column:
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)) / PERMUTATIONS


def near_pairs(sigs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(id, dup_id, jaccard_est) of representatives that share a band and are estimated over ``threshold``; id < dup_id.

    A pair comes from the first band that it shares, so no distinct is needed.
    """
    c = classes(sigs).select("rep", "sig", band_hashes(F.col("sig")).alias("hashes"))
    rows = save(c.select("rep", "sig", "hashes", F.posexplode("hashes").alias("band", "bucket")), "bands")
    a, b = rows.alias("a"), rows.alias("b")
    first = F.array_position(F.zip_with("a.hashes", "b.hashes", lambda x, y: x == y), True) - 1
    near = estimate(F.col("a.sig"), F.col("b.sig"))
    on = (F.col("a.band") == F.col("b.band")) & (F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.rep") < F.col("b.rep"))
    found = a.join(b, on & (near > threshold) & (first == F.col("a.band")))
    return found.select(F.col("a.rep").alias("id"), F.col("b.rep").alias("dup_id"), near.alias("jaccard_est"))


def near_lists(pairs: DataFrame) -> DataFrame:
    """(id, dup_ids): both directions, ids in order."""
    both = pairs.select("id", "dup_id").unionByName(pairs.select(F.col("dup_id").alias("id"), F.col("id").alias("dup_id")))
    return both.groupBy("id").agg(F.array_sort(F.collect_list("dup_id")).alias("dup_ids"))


def cross_pairs(left: DataFrame, right: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(id, dup_id, jaccard_est): representatives of two shards, id from ``left``."""
    def side(s: DataFrame) -> DataFrame:
        c = classes(s).select("rep", "sig", band_hashes(F.col("sig")).alias("hashes"))
        return c.select("rep", "sig", "hashes", F.posexplode("hashes").alias("band", "bucket"))

    a, b = side(left).alias("a"), side(right).alias("b")
    near = estimate(F.col("a.sig"), F.col("b.sig"))
    first = F.array_position(F.zip_with("a.hashes", "b.hashes", lambda x, y: x == y), True) - 1
    on = (F.col("a.band") == F.col("b.band")) & (F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.rep") != F.col("b.rep"))
    found = a.join(b, on & (near > threshold) & (first == F.col("a.band")))
    return found.select(F.col("a.rep").alias("id"), F.col("b.rep").alias("dup_id"), near.alias("jaccard_est"))


def keep_one(docs: DataFrame, sigs: DataFrame, id_col: str = "unique_id", threshold: float = 0.5) -> DataFrame:
    """``docs`` without those that a smaller id is linked to, over any number of links."""
    sigs = save(sigs, "signatures")
    members = save(membership(sigs), "members")
    found = components(near_pairs(sigs, threshold).select(F.col("id").alias("u"), F.col("dup_id").alias("v")))
    gone = members.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("unique_id", F.coalesce("root", "rep").alias("root"))
    gone = gone.filter("unique_id <> root").select(F.col("unique_id").alias(id_col))
    return docs.join(gone, id_col, "left_anti")


# --- shards -------------------------------------------------------------------------------------


def shard_of(folder: Column) -> Column:
    """The shard that a folder is named after: what follows its last underscore."""
    return F.substring_index(F.regexp_replace(folder, "/+$", ""), "_", -1)


def write_index(sigs: DataFrame, path: str) -> bool:
    """(shard, unique_id, sig) -> saved signatures, and the index of their bands, by shard; unless both are there.

    Texts of equal signature in a shard are one class there, under its smallest id.
    """
    spark = sigs.sparkSession
    if files.done(spark, f"{path}/bands"):
        return False
    sigs.select("shard", "unique_id", "sig").write.mode("overwrite").partitionBy("shard").parquet(f"{path}/signatures")
    one = read_signatures(spark, path).groupBy("shard", "sig").agg(F.min("unique_id").alias("rep"), F.count("*").alias("members"))
    one = one.withColumn("hashes", band_hashes(F.col("sig")))
    rows = one.select("shard", "rep", "members", "sig", "hashes", F.posexplode("hashes").alias("band", "bucket"))
    rows.write.mode("overwrite").partitionBy("shard").parquet(f"{path}/bands")
    return True


def _of(spark: SparkSession, path: str, shards: tuple[str, ...]) -> DataFrame:
    t = spark.read.option("recursiveFileLookup", False).parquet(path).withColumn("shard", F.col("shard").cast("string"))
    return t.filter(F.col("shard").isin(*shards)) if shards else t


def read_signatures(spark: SparkSession, path: str, *shards: str) -> DataFrame:
    """(unique_id, sig, shard) of the named shards, or of all; other shards' folders aren't read."""
    return _of(spark, f"{path}/signatures", shards)


def read_bands(spark: SparkSession, path: str, *shards: str) -> DataFrame:
    return _of(spark, f"{path}/bands", shards)


def shard_duplicates(spark: SparkSession, path: str, indexed: tuple[str, ...] = (), asked: tuple[str, ...] = (), threshold: float = 0.5) -> DataFrame:
    """(shard, dup_shard, id, dup_id, jaccard_est): classes of the ``asked`` shards and those in the index of the ``indexed`` ones.

    Without names every pair of shards is gone through in one join, each once: the asked shard comes after the indexed one, or is it.
    """
    a, b = read_bands(spark, path, *asked).alias("a"), read_bands(spark, path, *indexed).alias("b")
    near = estimate(F.col("a.sig"), F.col("b.sig"))
    first = F.array_position(F.zip_with("a.hashes", "b.hashes", lambda x, y: x == y), True) - 1
    pair = (F.col("a.shard") > F.col("b.shard")) | ((F.col("a.shard") == F.col("b.shard")) & (F.col("a.rep") > F.col("b.rep"))) if not indexed and not asked else F.col("a.rep") != F.col("b.rep")
    on = (F.col("a.band") == F.col("b.band")) & (F.col("a.bucket") == F.col("b.bucket")) & pair
    found = a.join(b, on & (near > threshold) & (first == F.col("a.band")))
    return found.select(F.col("a.shard").alias("shard"), F.col("b.shard").alias("dup_shard"), F.col("a.rep").alias("id"), F.col("b.rep").alias("dup_id"), near.alias("jaccard_est"))
