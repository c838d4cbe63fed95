"""Removal of repeated strings against counting all strings; suffix arrays against sorting."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from corpusloom.llm import substring_dedup as S, suffixes


def brute(texts: list[str | None], length: int) -> list[tuple[int, int, int, str]]:
    raw = [(t or "").encode() for t in texts]
    n = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if n[b[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed: int, length: int) -> list[str | None]:
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randrange(1, 6)))
    some = lambda n: " ".join(word() for _ in range(n))
    shared = [some(length // 2) for _ in range(3)] + ["ab" * length, "x" * (2 * length)]
    texts: list[str | None] = [None, "", "short", "x" * length, "x" * (length + 1), shared[0], shared[0], "y" * (5 * length)]
    for _ in range(25):
        parts = [some(rng.randrange(1, length)) for _ in range(rng.randrange(1, 4))] + rng.choices(shared, k=rng.randrange(3))
        rng.shuffle(parts)
        texts.append(rng.choice(["", " "]).join(parts))
    return texts + [texts[-1], "z" + texts[-2][3:]]


@pytest.mark.parametrize(("length", "k", "many"), [(200, 64, 20_000), (24, 8, 20_000), (24, 8, 1)])
def test_against_brute_force(spark, docs_of, monkeypatch, length, k, many):
    monkeypatch.setattr(S, "SHARD", 2_000)
    texts = corpus(length + many, length)
    got = S.remove_repeats(docs_of(texts), length=length, k=k, many=many).orderBy("id").collect()
    assert [(r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in got] == brute(texts, length)


def test_pieces_of_long_texts(spark, docs_of, monkeypatch):
    rng = random.Random(8)
    part = "".join(rng.choice("abcdefgh") for _ in range(300))
    long = "".join(rng.choice("abcdefgh") for _ in range(9_000))
    texts = [long[:4_000] + part + long[4_000:], "q" + part]
    monkeypatch.setattr(S, "PIECE", 700)
    raw = [t.encode() for t in texts]
    h, s, text, pos, left, right = S.anchors_of(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    assert set(h[text == 0].tolist()) & set(h[text == 1].tolist())
    assert [tuple(r)[:3] for r in S.remove_repeats(docs_of(texts)).select("n_bytes", "n_removed", "n_spans").collect()] == [x[:3] for x in brute(texts, 200)]


def test_odd_tables(odd):
    got = S.remove_repeats(odd.select("doc_id", "text")).toPandas()
    assert len(got) == odd.count() and got["n_removed"].max() == len("long words ") * 30_000
    assert S.remove_repeats(odd.limit(0)).count() == 0 and S.remove_repeats(odd).count() == odd.count()


@pytest.mark.parametrize("few", [0.0, 0.75, 2.0])
@pytest.mark.parametrize("seed", range(20))
def test_suffix_arrays(seed, few):
    """With doubling only, with levels as long as some names repeat, and with levels only."""
    rng = random.Random(seed)
    t = np.array([rng.randrange(1 + seed % 4 + 1) for _ in range(rng.randrange(1, 300))], np.uint8)
    if seed % 5 == 0:
        t = np.concatenate([t, t, t])
    b = t.tobytes()
    sa = suffixes.suffix_array(t, None, few)
    assert sa.tolist() == sorted(range(len(b)), key=lambda i: b[i:])
    plcp, before = suffixes.common_prefixes(t, sa, 30, len(t) - np.arange(len(t)))
    for x, y in zip(sa[:-1], sa[1:]):
        n = next((i for i in range(30) if b[x + i : x + i + 1] != b[y + i : y + i + 1] or x + i >= len(b) or y + i >= len(b)), 30)
        assert before[y] == x and plcp[y] == n
    deep = suffixes.suffix_array(t, 10, few)
    assert [b[i : i + 10] for i in deep] == sorted(b[i : i + 10] for i in range(len(b)))


@pytest.mark.parametrize("few", [0.0, 2.0])
@pytest.mark.parametrize("letters", [1, 2, 30, 4_000])
def test_suffix_arrays_of_many_letters(letters, few):
    rng = random.Random(letters)
    part = [rng.randrange(letters) for _ in range(300)]
    t = np.array(part + [rng.randrange(letters) for _ in range(600)] + part)
    assert suffixes.suffix_array(t, None, few).tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())


def test_query(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    got = S.op5_substring_dedup(spark, sf).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == brute([r["text"] for r in d], 200)
