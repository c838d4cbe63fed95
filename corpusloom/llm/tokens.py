"""Exact token counts of a byte-level BPE tokenizer by a two-tier, map-side lookup.

A text is cut into pre-tokens, each of which the tokenizer encodes by itself, so a text's count is the
sum of its pre-tokens' lengths. Frequent pre-tokens' lengths are broadcast; others are encoded once per
worker and kept in its bounded cache. Nothing is shuffled: each task sends the driver its commonest pre-tokens, a bounded
number for all tasks together. Texts with characters on which two versions
of Unicode may disagree, or with a special token's string, go to the tokenizer itself.

Cases: null text counts as empty (0 tokens); very long texts are cut at single spaces between
non-space characters, where a pre-token always begins, and counted piece by piece; rows with null or
repeated ids are counted like any other; an empty table gives no rows; further columns pass through, but for those named
n_tokens or over_limit, which are replaced.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.plans.shared import ship, spread

#: The tokenizer's split, without its look for digits or letters beyond Unicode's classes.
PRETOKEN = r"'(?:[stmd]|re|ve|ll)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters that the pattern above and the tokenizer class alike, checked one by one.
AGREED = r"\x00-\u0557\u1E00-\u1FFF\u2000-\u2070\u2190-\u23FF\u2500-\u27BF\u3041-\u3096\u30A0-\u30FF\u4E00-\u9FEF\uAC00-\uD7A3\uFF00-\uFF60\U0001F300-\U0001F64F"
SAFE_CUT = r"(?<=[^\s\x1c-\x1f\x85\u180E]) (?=[^\s\x1c-\x1f\x85\u180E])"
#: Entries of the broadcast table, and of what all tasks send for it. One text in FREQUENT_SHARE, by its hash, of every partition is
#: counted for it; it only saves time, no count depends on it.
FREQUENT, SENT, FREQUENT_SHARE = 32_768, 1 << 18, 64
#: Entries of a worker's cache; beyond it starts anew from the frequent ones. Longer pre-tokens aren't kept.
CACHED, LONGEST_CACHED, PIECE = 300_000, 48, 1 << 20


class Lengths(dict):
    """Pre-token -> number of tokens; a missing one is encoded."""

    def __init__(self, path: str, frequent: dict[str, int] | None = None):
        from tokenizers import Tokenizer

        self.tokenizer, self.frequent = Tokenizer.from_file(path), frequent or {}
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = [t["content"] for t in json.loads(self.tokenizer.to_str())["added_tokens"]]
        self.split = regex.compile(PRETOKEN)
        self.odd = regex.compile("|".join([f"[^{AGREED}]", *map(regex.escape, added)]))
        self.cut = regex.compile(SAFE_CUT)
        super().__init__(self.frequent)

    def __missing__(self, word: str) -> int:
        n = len(self.tokenizer.encode(word, add_special_tokens=False).ids)
        if len(word) <= LONGEST_CACHED:
            if len(self) >= CACHED:
                self.clear()
                self.update(self.frequent)
            self[word] = n
        return n

    def pieces(self, text: str) -> Iterator[tuple[int, int]]:
        at = 0
        while len(text) - at > PIECE:
            found = self.cut.search(text, at + PIECE)
            if not found:
                break
            yield at, found.start()
            at = found.start()
        yield at, len(text)

    def count(self, text: str) -> int:
        n = 0
        for a, b in self.pieces(text):
            if self.odd.search(text, a, b):
                n += len(self.tokenizer.encode(text[a:b], add_special_tokens=False).ids)
            else:
                n += sum(map(self.__getitem__, self.split.findall(text, a, b)))
        return n


_lengths: dict[tuple, Lengths] = {}


def _worker(path: str, frequent) -> Lengths:
    """One per worker process and broadcast; it outlives the task."""
    key = (path, frequent.id if hasattr(frequent, "id") else None)
    if key not in _lengths:
        _lengths.clear()
        _lengths[key] = Lengths(path, frequent.value)
    return _lengths[key]


def frequent_lengths(docs: DataFrame, path: str, text_col: str = "text", size: int = FREQUENT, share: int = FREQUENT_SHARE, sent: int = SENT) -> dict[str, int]:
    """The first tier: lengths of the commonest pre-tokens, at most ``size``, of one text in ``share`` of all partitions.

    A task counts in bounded room and sends its commonest, ``sent`` in all; with so many tasks that those would be under 16
    each, every so many-th task sends.
    """
    chosen = docs.select(F.col(text_col).alias("text")).filter(F.col("text").isNotNull() & (F.pmod(F.xxhash64("text"), F.lit(share)) == 0))
    parts = max(1, chosen.rdd.getNumPartitions())
    each, stride = min(size, max(16, sent // parts)), -(-16 * parts // sent)
    split = regex.compile(PRETOKEN)

    def common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if TaskContext.get().partitionId() % stride:
            return
        seen: Counter = Counter()
        lengths = Lengths(path)
        for b in batches:
            for t in b.column(0).to_pylist():
                for at, end in lengths.pieces(t):
                    seen.update(w for w in split.findall(t, at, end) if len(w) <= LONGEST_CACHED)
                    if len(seen) > 8 * size:
                        seen = Counter(dict(seen.most_common(4 * size)))
        top = seen.most_common(each)
        cells = {"w": pa.array([w for w, _ in top], pa.string()), "c": pa.array([c for _, c in top], pa.int64()), "n": pa.array([lengths[w] for w, _ in top], pa.int32())}
        yield pa.RecordBatch.from_pydict(cells)

    times, known = Counter(), {}
    for r in chosen.mapInArrow(common, "w string, c bigint, n int").collect():
        times[r["w"]] += r["c"]
        known[r["w"]] = r["n"]
    return {w: known[w] for w, _ in sorted(times.items(), key=lambda x: (-x[1], x[0]))[:size]}


def count_tokens(docs: DataFrame, path: str, text_col: str = "text", limit: int = 1024) -> DataFrame:
    """``docs`` with n_tokens and over_limit. ``path``: a tokenizers .json on every machine."""
    spark = docs.sparkSession
    ship(spark)
    frequent = spark.sparkContext.broadcast(frequent_lengths(docs, path, text_col))

    @F.pandas_udf("long")
    def n_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lengths = _worker(path, frequent)
        for texts in batches:
            yield pd.Series([lengths.count(t) for t in texts], dtype="int64")

    return docs.withColumn("n_tokens", n_tokens(F.coalesce(F.col(text_col), F.lit("")))).withColumn("over_limit", F.col("n_tokens") > limit)


def op3_token_counts(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    out = count_tokens(docs, str(tokenizer))
    return out.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), "n_tokens", "over_limit")
