"""Removal of every byte that a 200-byte string covers which also starts anywhere else, exactly.

Whole-corpus suffix arrays don't fit a worker, so the corpus is cut into shards by content. Winnowing picks
k-byte anchors by least hash, so that each 200-byte string has one and equal strings have equal ones. Around an anchor lies
its surrounding: all 200-byte strings that hold it. Equal strings are therefore in surroundings of equal anchors:

* anchors that stand once in the corpus are done with;
* equal surroundings that stand twice or more are removed whole;
* different surroundings of equal anchors meet in a shard, whose suffix array (induced sorting) and permuted common
  prefixes tell which strings they share. An anchor with very many different surroundings goes string by string instead.

Hashes only pick candidates; what a shard removes is compared byte by byte. Equal surroundings are told by 128 bits.

Cases: null text counts as empty; texts under 200 bytes lose nothing; equal rows are different documents, so each loses all it
shares; ids may be null or repeated; very long texts go in overlapping pieces; an empty table gives no rows; further columns
don't take part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.llm import rolling
from corpusloom.llm.suffixes import common_prefixes, suffix_array
from corpusloom.plans.keys import join_per_key, row_key
from corpusloom.plans.shared import save, ship, spread

LENGTH, ANCHOR = 200, 64
#: Bytes that are hashed at once, and bytes of surroundings in a shard.
PIECE, SHARD = 1 << 20, 1 << 20
#: An anchor with more different surroundings goes string by string.
MANY = 20_000
_LAST = np.uint64(0xFFFFFFFFFFFFFFFF)


def _sliding(x: np.ndarray, w: int, least) -> np.ndarray:
    """Least (or greatest) of each w neighbours, by the first of them."""
    n, width, cur = len(x) - w + 1, 1, x
    while 2 * width <= w:
        cur = least(cur[:-width], cur[width:])
        width *= 2
    return least(cur[:n], cur[w - width : w - width + n])


def _picked(buf: np.ndarray, at: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchors (hash, start) of the texts that lie end to end in ``buf``, by start."""
    w = length - k + 1
    none = np.empty(0, np.uint64), np.empty(0, np.int64)
    if len(buf) < length:
        return none
    h = rolling.windows(rolling.sums(buf), k)
    h[h == _LAST] = 0
    least = _sliding(h, w, np.minimum)  # by start of a string of `length`
    inside = np.zeros(len(buf) + 1, np.int32)
    sizes = np.diff(at)
    whole = sizes >= length
    np.add.at(inside, at[:-1][whole], 1)
    np.add.at(inside, at[1:][whole] - length + 1, -1)
    least[np.cumsum(inside)[: len(least)] == 0] = 0  # strings that cross texts pick nothing
    # A start is an anchor if it is the least of some string that holds it: then the greatest of these least ones is its own.
    pad = np.zeros(w - 1, np.uint64)
    held = _sliding(np.concatenate([pad, least, pad]), w, np.maximum)
    pos = np.flatnonzero((h == held) & (held != 0))
    if not len(pos):
        return none
    # Where text repeats itself, equal anchors crowd: of those in half a string's starts the first and last do.
    text = np.searchsorted(at, pos, "right")
    same = (h[pos][1:] == h[pos][:-1]) & (pos[1:] // (w // 2) == pos[:-1] // (w // 2)) & (text[1:] == text[:-1])
    keep = ~(np.r_[False, same] & np.r_[same, False])
    return h[pos[keep]], pos[keep]


def anchors_of(buf: np.ndarray, at: np.ndarray, length: int = LENGTH, k: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """(hash, hash of the surrounding, text number, start, bytes before, bytes from the start on) of each anchor."""
    hs, ps = [], []
    i = 0
    while i < len(at) - 1:
        j = max(i + 1, int(np.searchsorted(at, at[i] + PIECE, "right")) - 1)
        lo, hi = at[i], at[j]
        if hi - lo <= 2 * PIECE:
            h, p = _picked(buf[lo:hi], at[i : j + 1] - lo, length, k)
            hs.append(h)
            ps.append(p + lo)
        else:  # one long text, in pieces that share a string
            own: dict[int, int] = {}
            for a in range(lo, hi, PIECE):
                b = min(hi, a + PIECE + length)
                h, p = _picked(buf[a:b], np.array([0, b - a]), length, k)
                own.update(zip((p + a).tolist(), h.tolist()))
            ps.append(np.array(sorted(own), np.int64))
            hs.append(np.array([own[p] for p in sorted(own)], np.uint64))
        i = j
    h = np.concatenate(hs) if hs else np.empty(0, np.uint64)
    p = np.concatenate(ps) if ps else np.empty(0, np.int64)
    text = np.searchsorted(at, p, "right") - 1
    left = np.minimum(p - at[text], length - k)
    right = np.minimum(at[text + 1] - p, length)
    view, digest = memoryview(np.ascontiguousarray(buf)), xxhash.xxh3_64_intdigest
    s = np.array([digest(view[a:b], n) for a, b, n in zip((p - left).tolist(), (p + right).tolist(), left.tolist())], np.uint64)
    return h, s, text, p - at[text], left, right


def _anchors(docs: DataFrame, length: int, k: int) -> DataFrame:
    """(h, s, row, pos, span): span is 1024 times the bytes before the anchor plus those from its start on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            buf, at = rolling.flat(b.column(1))
            h, s, text, pos, left, right = anchors_of(buf, at, length, k)
            row = b.column(0).to_numpy(zero_copy_only=False)[text] if len(text) else np.empty(0, np.int64)
            cells = [h.view(np.int64), s.view(np.int64), row, pos, (left * 1024 + right).astype(np.int32)]
            for i in range(0, len(h), 1 << 17):
                yield pa.RecordBatch.from_arrays([pa.array(c[i : i + (1 << 17)]) for c in cells], ["h", "s", "row", "pos", "span"])

    return docs.select("row", "text").mapInArrow(run, "h bigint, s bigint, row bigint, pos bigint, span int")


def shared_strings(pieces: list[bytes], owner: np.ndarray, offset: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For each piece, the starts of its ``length``-byte strings that another place (owner, offset + start) has too."""
    t = np.frombuffer(b"\xff".join(pieces) + b"\xff", np.uint8)
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    first = np.cumsum(sizes + 1) - sizes - 1
    piece = np.repeat(np.arange(len(pieces)), sizes + 1)
    room = first[piece] + sizes[piece] - np.arange(len(t))
    sa = suffix_array(t, length)
    sa = sa[room[sa] >= length]
    plcp, before = common_prefixes(t, sa, length, room)
    again = plcp[sa] >= length
    # Hashes said so; compare the bytes.
    hit = np.flatnonzero(again)
    for i in range(0, len(hit), 1 << 13):
        x = sa[hit[i : i + (1 << 13)]]
        w = np.arange(length)
        again[hit[i : i + (1 << 13)]] = (t[x[:, None] + w] == t[before[x][:, None] + w]).all(1)
    # Runs of equal strings; the same place may be in more than one piece.
    run = np.cumsum(~again) - 1 if len(sa) else np.empty(0, np.int64)
    place = np.stack([owner[piece[sa]], offset[piece[sa]] + sa - first[piece[sa]]]) if len(sa) else np.empty((2, 0), np.int64)
    heads = np.flatnonzero(~again)
    differs = (place != place[:, heads][:, run]).any(0) if len(sa) else np.empty(0, bool)
    many = np.zeros(len(heads), bool)
    many[run[differs]] = True
    found = np.sort(sa[many[run]]) if len(sa) else np.empty(0, np.int64)
    cut = np.searchsorted(found, np.r_[first, len(t)])
    return [found[a:b] - f for a, b, f in zip(cut[:-1], cut[1:], first)]


def _runs(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """[start, end) of the bytes that strings at sorted ``starts`` cover."""
    if not len(starts):
        return []
    gap = np.flatnonzero(starts[1:] > starts[:-1] + length)
    return list(zip(starts[np.r_[0, gap + 1]].tolist(), (starts[np.r_[gap, len(starts) - 1]] + length).tolist()))


def _sharded(snippets: DataFrame, length: int) -> DataFrame:
    """(h, row, pos, n, piece) -> (row, start, end): what surroundings of equal anchors share, shard by shard.

    The anchors of a partition come sorted; a shard is as many whole anchors as fill it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: list[tuple] = []
        size, last = 0, None

        def out():
            owner = np.array([r[1] for r in shard], np.int64)
            offset = np.array([r[2] for r in shard], np.int64)
            rows, starts, ends = [], [], []
            for (_, row, pos, n, _), found in zip(shard, shared_strings([r[4] for r in shard], owner, offset, length)):
                if n == 1:
                    for a, b in _runs(found, length):
                        rows.append(row)
                        starts.append(pos + a)
                        ends.append(pos + b)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (rows, starts, ends)], ["row", "start", "end"])

        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns)):
                if r[0] != last and size > SHARD:
                    yield out()
                    shard, size = [], 0
                shard.append(r)
                size, last = size + len(r[4]) + 1, r[0]
        if shard:
            yield out()

    dealt = snippets.repartition("h").sortWithinPartitions("h", "row", "pos").select("h", "row", "pos", "n", "piece")
    return dealt.mapInArrow(run, "row bigint, start bigint, end bigint")


def _stringwise(snippets: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many surroundings: strings by 128-bit hash, combined before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, starts, a, z = [], [], [], []
            for row, pos, piece in zip(*(b.column(c).to_pylist() for c in ("row", "pos", "piece"))):
                for i in range(len(piece) - length + 1):
                    d = xxhash.xxh3_128_digest(piece[i : i + length])
                    rows.append(row)
                    starts.append(pos + i)
                    a.append(int.from_bytes(d[:8], "little", signed=True))
                    z.append(int.from_bytes(d[8:], "little", signed=True))
                if len(rows) > 1 << 16:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (rows, starts, a, z)], ["row", "start", "a", "z"])
                    rows, starts, a, z = [], [], [], []
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (rows, starts, a, z)], ["row", "start", "a", "z"])

    strings = save(snippets.mapInArrow(run, "row bigint, start bigint, a bigint, z bigint"), "strings")
    place = F.xxhash64("row", "start")
    twice = strings.groupBy("a", "z").agg(F.count("*").alias("n"), F.min(place).alias("lo"), F.max(place).alias("hi"))
    twice = save(twice.filter("lo <> hi").select("a", "z", "n"), "twice")
    found = join_per_key(strings, twice, ["a", "z"], "n", strings.count())
    return found.select("row", "start", (F.col("start") + length).alias("end"))


def find_repeats(docs: DataFrame, length: int = LENGTH, k: int = ANCHOR, many: int = MANY) -> DataFrame:
    """(row, text), no nulls, rows unique -> (row, start, end): byte ranges to remove, which may overlap."""
    ship(docs.sparkSession)
    anchors = save(_anchors(docs, length, k), "anchors")
    twice = save(anchors.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1"), "twice")
    met = save(join_per_key(anchors, twice, "h", "n", anchors.count()).select("h", "s", "row", "pos", "span"), "met")
    classes = met.groupBy("h", "s").agg(F.count("*").alias("n"), F.first("row").alias("row"), F.first("pos").alias("pos"), F.first("span").alias("span"))
    classes = save(classes, "classes")
    total = met.count()
    left, right = F.floor(F.col("span") / 1024), F.col("span") % 1024
    equal = join_per_key(met, classes.filter("n > 1").select("h", "s", "n"), ["h", "s"], "n", total)
    equal = equal.filter(left + right >= length).select("row", (F.col("pos") - left).alias("start"), (F.col("pos") + right).alias("end"))
    # Anchors with different surroundings: one of each, unless all of them go anyway.
    mixed = classes.groupBy("h").agg(F.count("*").alias("m"), F.min("n").alias("least")).filter("m > 1 AND least = 1").select("h", "m")
    mixed = save(mixed, "mixed")
    compared = join_per_key(classes, mixed, "h", "m", classes.count())
    compared = save(compared.filter(left + right >= length), "compared")
    per_row = compared.groupBy("row").agg(F.collect_list(F.struct("h", "m", "n", (F.col("pos") - left).alias("pos"), (left + right).alias("size"))).alias("at"))
    snippets = docs.select("row", "text").join(per_row, "row").select("row", F.col("text").cast("binary").alias("text"), F.explode("at").alias("x"))
    snippets = snippets.select("row", "x.h", "x.m", "x.n", "x.pos", F.substring("text", (F.col("x.pos") + 1).cast("int"), F.col("x.size").cast("int")).alias("piece"))
    found = equal.unionByName(_sharded(snippets.filter(F.col("m") <= many), length))
    if not mixed.filter(F.col("m") > many).isEmpty():
        found = found.unionByName(_stringwise(snippets.filter(F.col("m") > many), length))
    return found


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, k: int = ANCHOR, many: int = MANY) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept) of every row; kept holds the remaining bytes, which a cut may leave inside a character."""
    kind = dict(docs.dtypes)[id_col]
    texts = row_key(docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")), "id", "row")
    ranges = find_repeats(texts, length, k, many).groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("cut"))
    joined = texts.join(ranges, "row", "left").select("id", "text", F.array_sort("cut").alias("cut"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts, cuts = b.column(0), b.column(1), b.column(2)
            sizes, removed, spans, kept = [], [], [], []
            for text, cut in zip(texts, cuts):
                raw = text.as_py().encode()
                parts, at, n = [], 0, 0
                last = -1
                for r in cut.as_py() or ():
                    if r["start"] > last:
                        parts.append(raw[at : r["start"]])
                        n += 1
                    at = last = max(last, r["end"])
                parts.append(raw[at:])
                kept.append(b"".join(parts))
                sizes.append(len(raw))
                removed.append(len(raw) - len(kept[-1]))
                spans.append(n)
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, pa.int64()) for c in (sizes, removed, spans)), pa.array(kept, pa.binary())], ["id", "n_bytes", "n_removed", "n_spans", "kept"])

    return joined.mapInArrow(run, f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "text")
    out = remove_repeats(docs)
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
