"""Containment search against shingle sets."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from corpusloom.llm import decontamination as D


def shingles(text: str | None) -> set[str]:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {" ".join(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {" ".join(words)} - {""}


def brute(docs: dict, items: dict, threshold: float = 0.8) -> set[tuple]:
    """An item of fewer than five words is held where its words stand in a row."""
    out = set()
    for d, text in docs.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        for i, item in items.items():
            own = shingles(item)
            w = min(5, len((item or "").split()))
            held = own & {" ".join(words[j : j + w]) for j in range(len(words) - w + 1)} if w else set()
            if own and len(held) >= threshold * len(own) - 1e-9:
                out.add((d, i, len(held), len(own)))
    return out


def test_against_brute_force(spark, docs_of, monkeypatch):
    rng = random.Random(4)
    word = lambda: rng.choice("alpha Beta gamma delta épsilon zeta eta theta iota".split()) + str(rng.randrange(40))
    items = {i: " ".join(word() for _ in range(rng.randrange(1, 40))) for i in range(40)} | {40: "", 41: None, 42: "One", 43: " two  Words ", 44: "a b c d e"}
    items[45] = items[3]
    docs = []
    for k in range(60):
        own = [word() for _ in range(rng.randrange(200))]
        if k % 2:
            it = (items[rng.randrange(40)] or "").split()
            for _ in range(rng.randrange(4)):  # damaged here and there
                it[rng.randrange(len(it))] = word()
            at = rng.randrange(len(own) + 1)
            own[at:at] = it
        docs.append(rng.choice([" ", "\n", "  "]).join(own))
    docs += [None, "", "ONE", "two words", "a b c d", "A B C D E", "one two words one"]
    table = spark.createDataFrame(list(items.items()), "item_id bigint, text string")
    want = brute(dict(enumerate(docs)), items)
    for item_bytes, common in ((D.ITEM_BYTES, D.COMMON), (1_500, 0)):
        monkeypatch.setattr(D, "ITEM_BYTES", item_bytes)
        monkeypatch.setattr(D, "COMMON", common)
        got = [tuple(r) for r in D.find_leaks(docs_of(docs), table).collect()]
        assert set(got) == want and len(got) == len(want)
        left = {r["doc_id"] for r in D.drop_leaking(docs_of(docs), table).collect()}
        assert left == set(range(len(docs))) - {x[0] for x in want}
    assert 15 < len(want) < len(docs) * len(items)
    for block in (40, 100, 1_000):  # texts in pieces
        monkeypatch.setattr(D, "BLOCK_BYTES", block)
        sought = D.Items(list(items.items()))
        for d, text in enumerate(docs):
            raw = np.frombuffer((text or "").encode(), np.uint8)
            assert {(d, sought.ids[k], n, sought.sizes[k]) for _, k, n in sought.find(raw, np.array([0, len(raw)]))} == {x for x in want if x[0] == d}


@pytest.mark.parametrize("threshold", [0.5, 1.0])
def test_other_thresholds(docs_of, spark, threshold):
    item = "a1 a2 a3 a4 a5 a6 a7 a8 a9 a10 a11 a12"
    docs = [item, item.replace("a12", "x"), item.replace("a6", "x"), "y " + item]
    got = D.find_leaks(docs_of(docs), spark.createDataFrame([(0, item)], "item_id bigint, text string"), threshold)
    assert {tuple(r) for r in got.collect()} == brute(dict(enumerate(docs)), {0: item}, threshold)


def test_odd_tables(odd, spark):
    items = spark.createDataFrame([(None, "x y z"), (1, None), (2, "a b c d e f"), (3, "words long words")], "item_id bigint, text string")
    got = sorted(map(tuple, D.find_leaks(odd, items).collect()), key=str)
    assert got == [(1, 2, 2, 2), (1, 2, 2, 2), (5, 3, 1, 1), (None, None, 1, 1)]
    left = D.drop_leaking(odd, items)
    assert left.columns == odd.columns and sorted((r["doc_id"] or -1) for r in left.collect()) == [-1, 2, 3, 4]
    for none in (D.find_leaks(odd, items.limit(0)), D.find_leaks(odd.limit(0), items), D.drop_leaking(odd.limit(0), items)):
        assert none.count() == 0
    assert D.drop_leaking(odd, items.limit(0)).count() == odd.count()
