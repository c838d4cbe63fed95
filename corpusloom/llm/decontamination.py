"""Benchmark decontamination: which documents hold which test items, by containment of word shingles.

An item is contained at least ``threshold`` if so large a share of its distinct five-word shingles is anywhere in the
document. Items are partitioned by size; of an item with n shingles the smallest n - ceil(threshold n) + 1 hashes are its MinHash
sketch, shingles that many items share being put last. A document that lacks all of them lacks too many shingles, so probing the
sketches with each document's shingles misses no item, however long the document. Shingles are counted, byte by byte, only for
the items so found.

Items are the stated query set: they go out in blocks of bounded size, each to all documents; no row is moved. Documents are read
once for each block.

Cases: words are lower-cased (A-Z) and end at ASCII white space; null text is empty; an item with fewer words than a shingle is
one shingle, its words in a row; an item without words is in no document; of items with equal text each is reported; null and
repeated ids are reported as such; a very long text goes in pieces; empty tables give no leaks; columns of ``docs`` besides id
and text have no part in ``find_leaks`` and pass through ``drop_leaking`` as they are, whatever their names.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from functools import lru_cache, reduce
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.llm import rolling
from corpusloom.plans.keys import hidden
from corpusloom.plans.shared import save, ship, spread

SHINGLE, THRESHOLD = 5, 0.8
#: Bytes of item text that are broadcast at once; bytes of documents that are looked at at once.
ITEM_BYTES, BLOCK_BYTES = 32 << 20, 1 << 20
#: A shingle that more items of a block have comes last in their sketches.
COMMON = 16
FILTER_BITS = 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words:
    """The words of texts that lie end to end in ``raw``, lower-cased and a blank apart."""

    def __init__(self, raw: np.ndarray, at: np.ndarray):
        space = _SPACE[raw]
        keep = ~space
        keep[1:] |= ~space[:-1]
        #: Where each byte that is kept stood.
        self.origin = np.flatnonzero(keep)
        solid = ~space[self.origin]
        self.buf = np.where(solid, _LOWER[raw[self.origin]], np.uint8(32))
        at = np.searchsorted(self.origin, at)
        edge = np.zeros(len(self.buf) + 1, bool)
        edge[at] = True
        self.starts = np.flatnonzero(solid & (edge[:-1] | np.r_[True, ~solid[:-1]]))
        self.ends = np.flatnonzero(solid & (edge[1:] | np.r_[~solid[1:], True])) + 1
        self.text = np.searchsorted(at, self.starts, "right") - 1
        self.per_text = np.bincount(self.text, minlength=len(at) - 1)
        self.first = np.cumsum(self.per_text) - self.per_text
        self.sums = rolling.sums(self.buf)

    def hashes(self, w: int) -> tuple[np.ndarray, np.ndarray]:
        """Of the ``w`` words from each word on, and whether they are all of one text."""
        n = max(0, len(self.starts) - w + 1)
        return rolling.stretch(self.sums, self.starts[:n], self.ends[w - 1 :][:n]), self.text[:n] == self.text[w - 1 :][:n]

    def shingle(self, p: int, w: int) -> bytes:
        return self.buf[self.starts[p] : self.ends[p + w - 1]].tobytes()


def _distinct(text: bytes, shingle: int) -> tuple[int, list[bytes]]:
    """Words in a shingle of this text, and its shingles."""
    words = text.split()
    w = min(shingle, len(words))
    return w, sorted({b" ".join(words[i : i + w]) for i in range(len(words) - w + 1)}) if w else []


def _hashes(parts: list[bytes]) -> np.ndarray:
    found, i = [np.empty(0, np.uint64)], 0
    while i < len(parts):
        j, size = i, 0
        while j < len(parts) and (j == i or size < BLOCK_BYTES):
            size += len(parts[j])
            j += 1
        ends = np.cumsum([len(p) for p in parts[i:j]])
        found.append(rolling.stretch(rolling.sums(np.frombuffer(b"".join(parts[i:j]), np.uint8)), np.r_[0, ends[:-1]], ends))
        i = j
    return np.concatenate(found)


class Items:
    """One block of items, ready to be searched for."""

    def __init__(self, items: list[tuple[int | None, str | None]], threshold: float = THRESHOLD, shingle: int = SHINGLE):
        self.ids, self.threshold, self.shingle = [i for i, _ in items], threshold, shingle
        self.texts = [b" ".join((text or "").encode("utf-8", "replace").lower().split()) for _, text in items]
        own = [(w, _hashes(s)) for w, s in (_distinct(t, shingle) for t in self.texts)]
        self.widths, self.sizes = [w for w, _ in own], [len(h) for _, h in own]
        seen, times = np.unique(np.concatenate([h for _, h in own] or [np.empty(0, np.uint64)]), return_counts=True)
        parts: dict[tuple[int, int], list[tuple[int, int, np.ndarray]]] = {}
        for k, (w, h) in enumerate(own):
            if w:
                least = self.least(k)
                sketch = h[np.lexsort((h, times[np.searchsorted(seen, h)] > COMMON))][: len(h) - least + 1]
                parts.setdefault((w, len(h).bit_length()), []).append((least, k, sketch))
        #: By width: for each size class the least shingles that a document must have, and its sketches' hashes with their items.
        self.sketches: dict[int, list[tuple[int, np.ndarray, np.ndarray]]] = {}
        self.filters: dict[int, np.ndarray] = {}
        for (w, _), members in sorted(parts.items()):
            h = np.concatenate([s for _, _, s in members])
            of = np.concatenate([np.full(len(s), k) for _, k, s in members])
            by = np.argsort(h, kind="stable")
            self.sketches.setdefault(w, []).append((min(n for n, _, _ in members), h[by], of[by]))
            self.filters.setdefault(w, np.zeros(1 << FILTER_BITS, bool))[self._slot(h)] = True

    def least(self, k: int) -> int:
        """Shingles of item ``k`` that a document must have."""
        return max(1, ceil(self.threshold * self.sizes[k] - 1e-9))

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)

    def candidates(self, words: Words, whole: bool = True) -> list[tuple[int, int]]:
        """(text, item) where a text has a shingle of an item's sketch; unless ``whole``, texts are parts of longer ones."""
        found = [np.empty(0, np.int64)]
        for w, parts in self.sketches.items():
            h, inside = words.hashes(w)
            near = np.flatnonzero(self.filters[w][self._slot(h)] & inside)
            room = words.per_text[words.text[near]] - w + 1
            for least, hashes, items in parts:
                p = near[room >= least] if whole else near
                a, n = np.searchsorted(hashes, h[p], "left"), 0
                n = np.searchsorted(hashes, h[p], "right") - a
                at = np.repeat(a - (np.cumsum(n) - n), n) + np.arange(n.sum())
                found.append(np.repeat(words.text[p], n) * len(self.ids) + items[at])
        return [divmod(x, len(self.ids)) for x in np.unique(np.concatenate(found)).tolist()]

    def held(self, words: Words, pairs: list[tuple[int, int]]) -> Iterator[tuple[int, int, set[bytes]]]:
        """(text, item, the item's shingles that are in the text), compared byte by byte."""
        sought = lru_cache(64)(lambda k: (s := _distinct(self.texts[k], self.shingle)[1], _hashes(s)))
        hashes = {w: words.hashes(w)[0] for w in {self.widths[k] for _, k in pairs}}
        last, order = None, np.empty(0, np.int64)
        for t, k in pairs:
            w = self.widths[k]
            if (t, w) != last:
                last, lo = (t, w), words.first[t]
                mine = hashes[w][lo : lo + max(0, words.per_text[t] - w + 1)]
                order = np.argsort(mine, kind="stable")
                ranked = mine[order]
            shingles, wanted = sought(k)
            a, b = np.searchsorted(ranked, wanted, "left"), np.searchsorted(ranked, wanted, "right")
            yield t, k, {shingles[i] for i in np.flatnonzero(b > a).tolist() if any(words.shingle(lo + p, w) == shingles[i] for p in order[a[i] : b[i]].tolist())}

    def find(self, raw: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(text, item, shared shingles) of all items that texts contain."""
        i = 0
        while i < len(at) - 1:
            j = max(i + 1, int(np.searchsorted(at, at[i] + BLOCK_BYTES, "right")) - 1)
            block = raw[at[i] : at[j]]
            if len(block) <= BLOCK_BYTES:
                words = Words(block, at[i : j + 1] - at[i])
                found = ((i + t, k, len(s)) for t, k, s in self.held(words, self.candidates(words)))
            else:
                found = ((i, k, n) for k, n in self._in_long(block))
            yield from ((t, k, n) for t, k, n in found if n >= self.least(k))
            i = j

    def _in_long(self, raw: np.ndarray) -> Iterator[tuple[int, int]]:
        """(item, shared shingles) of a text in pieces: what may be in it first, then how much of that is."""
        some = sorted({k for words in self._pieces(raw) for _, k in self.candidates(words, whole=False)})
        got: dict[int, set[bytes]] = {}
        for words in self._pieces(raw) if some else ():
            for _, k, s in self.held(words, [(0, k) for k in sorted(some, key=self.widths.__getitem__)]):
                got.setdefault(k, set()).update(s)
        yield from ((k, len(s)) for k, s in got.items())

    def _pieces(self, raw: np.ndarray) -> Iterator[Words]:
        """Pieces that end between words and share as many words as a shingle has, but one."""
        lo, size, shared = 0, BLOCK_BYTES, max(self.sketches, default=1) - 1
        while lo < len(raw):
            hi = lo + size
            while hi < len(raw) and not _SPACE[raw[hi]]:
                gap = np.flatnonzero(_SPACE[raw[hi : hi + BLOCK_BYTES]])
                hi += int(gap[0]) if len(gap) else BLOCK_BYTES
            hi = min(hi, len(raw))
            words = Words(raw[lo:hi], np.array([0, hi - lo]))
            if hi < len(raw) and len(words.starts) <= shared:
                size *= 2
                continue
            yield words
            lo = lo + int(words.origin[words.starts[-shared]]) if hi < len(raw) and shared else hi
            size = BLOCK_BYTES


def _blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int | None, str | None]]]:
    block, size = [], 0
    for r in items.select(F.col(id_col).cast("bigint").alias("i"), F.col(text_col).alias("t")).toLocalIterator():
        block.append((r["i"], r["t"]))
        size += len(r["t"] or "") + 64
        if size > ITEM_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def find_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, *, id_col: str = "doc_id", text_col: str = "text",
               item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, shared, shingles): a row for each text and item that it contains."""
    spark = docs.sparkSession
    ship(spark)
    schema = f"doc_id {dict(docs.dtypes)[id_col]}, item_id bigint, shared int, shingles int"
    given = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def searched(block) -> DataFrame:
        shared = spark.sparkContext.broadcast(Items(block, threshold))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sought = shared.value
            for b in batches:
                found = list(sought.find(*rolling.flat(b.column(1))))
                cells = [pa.array([f(t, k, n) for t, k, n in found], kind) for f, kind in (
                    (lambda t, k, n: sought.ids[k], pa.int64()), (lambda t, k, n: n, pa.int32()), (lambda t, k, n: sought.sizes[k], pa.int32()))]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array([t for t, _, _ in found], pa.int64())), *cells], ["doc_id", "item_id", "shared", "shingles"])

        return given.mapInArrow(run, schema)

    parts = [searched(b) for b in _blocks(items, item_id, item_text)]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def drop_leaking(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, *, text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Those rows of ``docs`` whose text contains no item, all columns as they were."""
    spark = docs.sparkSession
    ship(spark)
    left, named, back = hidden(docs)

    def clean(block):
        shared = spark.sparkContext.broadcast(Items(block, threshold))

        @F.arrow_udf("boolean")
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for texts in batches:
                free = np.ones(len(texts), bool)
                free[[t for t, _, _ in shared.value.find(*rolling.flat(texts))]] = False
                yield pa.array(free)

        return run

    for n, block in enumerate(_blocks(items, item_id, item_text)):
        # One block's sketches in a worker at a time.
        left = (save(left, "clean") if n else left).filter(clean(block)(F.coalesce(F.col(named[text_col]), F.lit(""))))
    return back(left)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document and benchmark item that it contains."""
    out = find_leaks(spread(spark.read.parquet(f"{sf_dir}/documents.parquet")), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.withColumn("containment", F.col("shared") / F.col("shingles"))


def _sql_words(table: str, key: str) -> str:
    lower = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    return f"SELECT {key}, regexp_extract_all({lower}, '[^\\x20\\x09-\\x0D]+') AS w FROM {table}"


OP8_SQL = f"""
WITH i AS (
  SELECT DISTINCT item_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda p: array_to_string(w[p:p + k - 1], ' '))) AS s
  FROM (SELECT item_id, w, least(len(w), {SHINGLE}) AS k FROM ({_sql_words("benchmark", "item_id")})) WHERE k > 0
), d AS (
  SELECT DISTINCT doc_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda p: array_to_string(w[p:p + k - 1], ' '))) AS s
  FROM ({_sql_words("documents", "doc_id")}), (SELECT DISTINCT k FROM i)
), n AS (SELECT item_id, count(*) AS shingles FROM i GROUP BY item_id),
x AS (SELECT doc_id, item_id, count(*) AS shared FROM d JOIN i USING (k, s) GROUP BY ALL)
SELECT doc_id, item_id, CAST(shared AS INTEGER) AS shared, CAST(shingles AS INTEGER) AS shingles, shared / shingles::DOUBLE AS containment
FROM x JOIN n USING (item_id) WHERE shared * 5 >= shingles * 4
"""
