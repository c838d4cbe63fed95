"""SimHash against comparing all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from corpusloom.llm import simhash as S


def slow(text: str | None) -> int:
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def reachable(fps: dict[int, int]) -> dict[int, int]:
    least = {i: i for i in fps}
    distinct: dict[int, int] = {}
    for i in sorted(fps):
        distinct.setdefault(fps[i], i)
    links = [(u, v) for u in distinct for v in distinct if u < v and (u ^ v).bit_count() <= 3]
    root = {f: i for f, i in distinct.items()}
    changed = True
    while changed:
        changed = False
        for u, v in links:
            m = min(root[u], root[v])
            changed |= root[u] != m or root[v] != m
            root[u] = root[v] = m
    return {i: root[f] for i, f in fps.items()} | {i: m for i, m in least.items() if i not in fps}


def test_fingerprints():
    rng = random.Random(2)
    for text in [None, "", " \n", "One", "one TWO", "É É é", "a\x0bb c d", "x " * 50, *(" ".join(rng.choice("abcdeÄ") for _ in range(rng.randrange(300))) for _ in range(60))]:
        assert S.fingerprint(text) == slow(text), text


@pytest.mark.parametrize("block", [1, 2, 7, 299])
def test_blocks_change_nothing(monkeypatch, block):
    rng = random.Random(block)
    monkeypatch.setattr(S, "BLOCK", block)
    for n in (1, 2, 3, 4, 9, 10, 301):
        text = " ".join(rng.choice("abcdeÄ") for _ in range(n))
        assert S.fingerprint(text) == slow(text), text


def test_least_id_stays_where_ids_repeat(spark, docs_of):
    same = "word " * 50
    left = S.drop_near_duplicates(docs_of([(None, same), (9, same), (3, same), (9, "other words stand here"), (3, same)]))
    assert sorted((r["doc_id"], r["text"][:4]) for r in left.collect()) == [(3, "word"), (9, "othe")]


@pytest.mark.parametrize("large", [S.LARGE, 5])
def test_components(spark, large):
    rng = random.Random(large)
    fps = [rng.getrandbits(64) for _ in range(80)] + [0, 1, 7, 1 << 63, (1 << 64) - 1]
    for f in fps[:20]:  # chains: each a few bits from the one before
        for _ in range(rng.randrange(12)):
            f ^= sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 5)))
            fps.append(f)
    fps += [fps[0] ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a)]  # one large group
    fps += fps[:30]
    given = {i: f for i, f in enumerate(fps)}
    d = spark.createDataFrame([(i, S._signed(f)) for i, f in given.items()], "id bigint, fp bigint")
    assert {r["id"]: r["component_id"] for r in S.cluster(d, large=large).collect()} == reachable(given)


def test_every_plan_finds_all_near_fingerprints():
    rng = np.random.default_rng(1)
    n = 4_000
    bits = rng.random((n, 64)) < rng.random(64)
    both = bits.T.astype(int) @ bits.astype(int)
    for many in (n, 10**6, 10**10):
        chosen = S.plan(many, both * (many // n))
        assert len({b for part, _ in chosen for b in part}) == sum(len(part) for part, _ in chosen)
        for _ in range(300):
            flips = set(rng.choice(64, rng.integers(1, 4), replace=False).tolist())
            assert any(len(flips & set(part)) <= t for part, t in chosen)


def test_odd_tables(odd, spark):
    got = S.cluster(S.fingerprints(odd)).toPandas()
    assert len(got) == odd.count()
    empty = got[got["fp"] == 0]
    assert len(empty) == 4 and set(empty["component_id"].astype(int)) == {2}
    left = S.drop_near_duplicates(odd)
    assert left.columns == odd.columns and left.filter("_row <> 7 or id <> 7").count() == 0
    assert sorted(r["doc_id"] or -1 for r in left.collect()) == [-1, 1, 2, 5]
    assert S.drop_near_duplicates(odd.limit(0)).count() == 0 and S.cluster(S.fingerprints(odd.limit(0))).count() == 0


def test_query(spark, sf):
    d = {r["doc_id"]: slow(r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = S.op10_simhash(spark, sf).collect()
    want = reachable(d)
    assert {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in got} == {(i, f"{f:016x}", want[i]) for i, f in d.items()}
    assert len(got) == len(d)
