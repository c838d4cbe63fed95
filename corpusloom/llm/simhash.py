"""SimHash near-dedup with the generalised pigeonhole principle.

Fingerprints of 64 bits link at ``TAU`` or fewer differing bits. Bits are put into parts, correlated bits together; parts
get thresholds t_i with sum TAU - parts + 1, so that linked fingerprints differ in at most t_i bits of some part i. A dynamic
program picks parts and thresholds by the rows to probe and the candidates to expect, so that wider parts come with more
fingerprints. Only distinct fingerprints are compared, bucket by bucket; a large bucket gives a spanning forest of its links
instead of all of them, so what is kept never grows with the square of a group, and no link between groups is lost.

Cases: null text counts as empty; a text without words has fingerprint 0, linked like any other; a text with fewer words than a
shingle is one shingle; very long texts are hashed in blocks; null ids take part but are never the smallest while a component
has another; repeated rows have a result each; an empty table gives no rows; further columns pass through ``drop_near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.plans.components import components
from corpusloom.plans.keys import hidden, join_per_key, row_key, without
from corpusloom.plans.shared import save, ship, spread

SHINGLE, SEED, TAU, BITS = 3, 42, 3, 64
BLOCK = 1 << 16
#: A bucket with more distinct fingerprints is split by further bits before it is compared.
LARGE = 20_000
#: What moving a probe row costs, in comparisons of a candidate.
ROW_COST = 20


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned; a bit is set if it is in over half of the shingles' hashes, repeats included."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # of bytes: A-Z only, and white space of ASCII only
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    counts, n, digest = np.zeros(BITS, np.int64), len(starts), xxhash.xxh64_intdigest
    for i in range(0, n, BLOCK):
        h = np.array([digest(line[a:b], SEED) for a, b in zip(starts[i : i + BLOCK].tolist(), ends[i : i + BLOCK].tolist())], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp) of every row, written once; fp is the fingerprint as a signed bigint."""
    ship(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return save(given.mapInArrow(run, f"id {kind}, fp bigint"), "fingerprints")


def _bit_counts(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and for each pair of bits how many have both; 4,097 numbers whatever the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((BITS, BITS), np.int64), 0
        for b in batches:
            x = np.ascontiguousarray(b.column(0).to_numpy(zero_copy_only=False)).view(np.uint8).reshape(-1, 8)
            x = np.unpackbits(x, axis=1, bitorder="little").astype(np.float32)
            both, n = both + (x.T @ x).astype(np.int64), n + len(x)
        cells = np.concatenate([both.ravel(), [n]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells), dtype=np.int32)), pa.array(cells)], ["at", "n"])

    cells = np.zeros(BITS * BITS + 1, np.int64)
    for r in distinct.select("fp").mapInArrow(run, "at int, n bigint").groupBy("at").agg(F.sum("n").alias("n")).collect():
        cells[r["at"]] = r["n"]
    return int(cells[-1]), cells[:-1].reshape(BITS, BITS)


def _parts(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """m parts of equal size; each grows by the bit that correlates most with what it has."""
    p = np.diag(both) / max(1, n)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs((both / max(1, n) - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    free, parts = set(range(BITS)), []
    for k in range(m):
        size = BITS // m + (k < BITS % m)
        part = [max(free, key=lambda b: (corr[b, list(free)].sum(), -b))]
        free.discard(part[0])
        while len(part) < size:
            part.append(max(free, key=lambda b: (corr[b, part].sum(), -b)))
            free.discard(part[-1])
        parts.append(sorted(part))
    return parts


def plan(n: int, both: np.ndarray, tau: int = TAU) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each part that is probed: the cheapest of all numbers of parts and thresholds of 0, 1 or none."""
    p = np.diag(both) / max(1, n)
    differ = 2 * p * (1 - p)
    best: tuple[float, list] | None = None
    for m in range(2, tau + 2):
        parts = _parts(n, both, m)

        def cost(part: list[int], t: int) -> float:
            if t < 0:
                return 0.0
            at_most = np.zeros(t + 1)
            at_most[0] = 1
            for b in part:  # how many bits of the part differ in two fingerprints drawn at random
                at_most[1:] = at_most[1:] * (1 - differ[b]) + at_most[:-1] * differ[b]
                at_most[0] *= 1 - differ[b]
            rows = 1 + sum(comb(len(part), d) for d in range(1, t + 1)) / 2
            return n * rows * ROW_COST + n * n / 2 * at_most.sum()

        states: dict[int, tuple[float, list]] = {0: (0.0, [])}  # sum of thresholds so far -> cost, thresholds
        for part in parts:
            step: dict[int, tuple[float, list]] = {}
            for total, (c, ts) in states.items():
                for t in (-1, 0, 1):
                    x = (c + cost(part, t), [*ts, t])
                    if total + t not in step or x < step[total + t]:
                        step[total + t] = x
            states = step
        if (need := tau - m + 1) in states and (best is None or states[need][0] < best[0]):
            best = (states[need][0], [(part, t) for part, t in zip(parts, states[need][1]) if t >= 0])
    return best[1]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _mask(bits: list[int]) -> int:
    return _signed(sum(1 << b for b in bits))


def _probes(distinct: DataFrame, chosen: list[tuple[list[int], int]]) -> DataFrame:
    """(part, key, fp): each fingerprint under its own bits of a part and, at threshold 1, with each unset bit set.

    Of two fingerprints that differ in one bit of a part, the one without it meets the other there.
    """
    rows = []
    for i, (bits, t) in enumerate(chosen):
        own = F.col("fp").bitwiseAND(F.lit(_mask(bits)))
        keys = F.array(own)
        if t:
            unset = F.filter(F.array(*(F.lit(_mask([b])) for b in bits)), lambda b: F.col("fp").bitwiseAND(b) == 0)
            keys = F.concat(keys, F.transform(unset, lambda b: own.bitwiseOR(b)))
        rows.append(F.transform(keys, lambda k: F.struct(F.lit(i).alias("part"), k.alias("key"))))  # noqa: B023
    r = distinct.select("fp", F.explode(F.concat(*rows)).alias("at"))
    return r.select("fp", F.col("at.part").alias("part"), F.xxhash64("at.part", "at.key").alias("key"))


def _split(probes: DataFrame, chosen: list[tuple[list[int], int]], tau: int, large: int) -> DataFrame:
    """(key, fp) with the buckets of over ``large`` rows dealt anew by tau + 1 shares of their other bits, again and again.

    Linked fingerprints differ in at most ``tau`` bits, so they agree in one of the shares whole. It ends when no bucket is
    large, or only such as have too few bits left to hold many fingerprints.
    """
    done, agreed = None, [bits for bits, _ in chosen]
    while True:
        hot = save(probes.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > large), "large")
        other = [[b for b in range(BITS) if b not in bits] for bits in agreed]
        if hot.isEmpty() or min(map(len, other)) <= 2 * (tau + 1):
            rest = probes.select("key", "fp")
            return done.unionByName(rest) if done is not None else rest
        masks = F.array(*(F.array(*(F.lit(_mask(o[j :: tau + 1])) for j in range(tau + 1))) for o in other))
        rest = probes.join(hot.hint("merge"), "key", "left_anti").select("key", "fp")
        done = done.unionByName(rest) if done is not None else rest
        found = join_per_key(probes, hot, "key", "n", probes.count())
        finer = found.select("fp", "key", "part", F.posexplode(F.element_at(masks, F.col("part") + 1)).alias("j", "mask"))
        finer = finer.select("fp", (F.col("part") * (tau + 1) + F.col("j")).alias("part"), F.xxhash64("key", "j", F.col("fp").bitwiseAND(F.col("mask"))).alias("key"))
        probes = save(finer, "finer")
        agreed = [bits + o[j :: tau + 1] for bits, o in zip(agreed, other) for j in range(tau + 1)]


SMALL = 64


def links_within(key: np.ndarray, fp: np.ndarray, tau: int = TAU) -> tuple[np.ndarray, np.ndarray]:
    """Links of rows sorted by key: all of a small bucket's, a spanning forest of a large one's."""
    us, vs = [], []
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[starts, len(key)])
    size_of = np.repeat(sizes, sizes)
    at = np.flatnonzero((size_of > 1) & (size_of <= SMALL))
    for d in range(1, SMALL):
        at = at[at + d < len(key)]
        at = at[key[at] == key[at + d]]
        if not len(at):
            break
        x = fp[at] ^ fp[at + d]
        near = (np.bitwise_count(x) <= tau) & (x != 0)
        us.append(fp[at[near]])
        vs.append(fp[at[near] + d])
    for s, n in zip(starts[sizes > SMALL], sizes[sizes > SMALL]):
        left = np.unique(fp[s : s + n])
        while len(left):
            front, left = [left[0]], left[1:]
            while front and len(left):
                u = front.pop()
                near = np.bitwise_count(left ^ u) <= tau
                if near.any():
                    new = left[near]
                    left = left[~near]
                    us.append(np.full(len(new), u))
                    vs.append(new)
                    front.extend(new)
    if not us:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.concatenate(us), np.concatenate(vs)


def _links(buckets: DataFrame, tau: int) -> DataFrame:
    """(u, v) of linked fingerprints that share a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flat(x) -> np.ndarray:
            return x.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)

        def out(key: np.ndarray, fp: np.ndarray):
            u, v = links_within(key, fp, tau)
            for i in range(0, len(u), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c[i : i + (1 << 16)]).view(np.int64)) for c in (u, v)], ["u", "v"])

        kept: list[tuple[np.ndarray, np.ndarray]] = []  # of the last key, which may go on in the next batch
        for b in batches:
            if not b.num_rows:
                continue
            key, fp = flat(b.column(0)), flat(b.column(1))
            same = key == key[-1]
            cut = len(key) - int(same[::-1].argmin()) if not same.all() else 0
            if cut:
                kept.append((key[:cut], fp[:cut]))
                yield from out(*map(np.concatenate, zip(*kept)))
                kept = []
            elif kept and kept[-1][0][-1] != key[0]:
                yield from out(*map(np.concatenate, zip(*kept)))
                kept = []
            kept.append((key[cut:], fp[cut:]))
        if kept:
            yield from out(*map(np.concatenate, zip(*kept)))

    dealt = buckets.repartition("key").sortWithinPartitions("key", "fp").select("key", "fp")
    return dealt.mapInArrow(run, "u bigint, v bigint")


def cluster(fps: DataFrame, tau: int = TAU, large: int = LARGE) -> DataFrame:
    """(id, fp) -> (id, fp, component_id): the smallest id reachable over links, its own included."""
    by = save(fps.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("n")), "distinct")
    n, both = _bit_counts(by)
    chosen = plan(n, both, tau)
    probes = _probes(by, chosen)
    found = components(save(_links(_split(probes, chosen, tau, large), tau), "links"))
    linked = save(found.withColumnRenamed("node", "fp").join(by.select("fp", "least"), "fp"), "linked")
    least = save(linked.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("size")), "roots")
    linked = join_per_key(linked.select("fp", "root"), least, "root", "size", linked.count()).select("fp", "component_id")
    whole = by.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"), "n")
    return join_per_key(fps, save(whole, "classes"), "fp", "n", fps.count()).select("id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each component, the row with the smallest id; all columns as they were."""
    own, named, back = hidden(docs)
    keyed = row_key(own, named[id_col], "_row")
    found = cluster(fingerprints(keyed, "_row", named[text_col]))
    gone = save(found.filter("id <> component_id").select(F.col("id").alias("_row")), "gone")
    return back(without(keyed, gone, "_row"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "text")
    out = cluster(fingerprints(docs))
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
