"""Toxicity and quality: held-out accuracy, order, and tables that lack things."""

from __future__ import annotations

import math
import pickle
import random
import re
import zlib

import numpy as np
import pytest

from corpusloom.llm import quality, toxicity

SF = "/root/testdata/sf0.01"


def auc(score: np.ndarray, y: np.ndarray) -> float:
    pos, neg = score[y == 1], score[y == 0]
    return float(((pos[:, None] > neg).mean() + 0.5 * (pos[:, None] == neg).mean()))


@pytest.mark.parametrize(("query", "label", "cut", "least"), [(toxicity.op4_toxicity, "toxic", 0.5, 0.9), (quality.op6_quality, "quality", 0.3, 0.9)])
def test_held_out(spark, query, label, cut, least):
    got = query(spark, SF).toPandas()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert got["score"].between(0, 1).all() and ((got["score"] >= cut) == (got["predicted"] == 1)).all()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got["doc_id"]]).all()
    both = got[got["held_out"]].merge(spark.read.parquet(f"{SF}/labels.parquet").toPandas(), on="doc_id")
    assert auc(both["score"].to_numpy(), both[label].to_numpy()) >= least
    assert (both["predicted"] == both[label]).mean() >= 0.8


@pytest.mark.parametrize(("fit", "score", "label"), [(toxicity.fit_toxicity, toxicity.score_toxicity, "toxic"), (quality.fit_quality, quality.score_quality, "quality")])
def test_odd_tables(spark, odd, fit, score, label):
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, 0), (None, 1), (2, None), (5, 9), (77, 0)], f"doc_id bigint, {label} int")
    for given in (labels, labels.limit(0), labels.filter(f"{label} = 1")):
        model = fit(odd, given)
        out = score(odd, model).toPandas()
        assert len(out) == odd.count() and out["score"].between(0, 1).all()
        assert score(odd.limit(0), model).count() == 0
    assert fit(odd.limit(0), labels) and score(odd, fit(odd, labels)).columns.count("score") == 1


def test_long_texts_are_read_in_blocks(monkeypatch):
    text = " ".join(f"word{i % 97}x" for i in range(400))
    whole = {int(x) for f in toxicity.features(text) for x in f}
    monkeypatch.setattr(toxicity, "BLOCK", 50)
    assert {int(x) for f in toxicity.features(text) for x in f} == whole


def sampled(seed: int, n: int = 90) -> list[tuple[str, int]]:
    rng = random.Random(seed)
    word = lambda bad: rng.choice(["vile", "nasty", "fool"] if bad and rng.random() < 0.5 else ["the", "cat", "Sat", "on", "a", "mat", "naïve", "x2y"])
    return [(rng.choice([" ", ", ", "\n"]).join(word(k % 3 == 0) for _ in range(rng.randrange(0, 60))), int(k % 3 == 0)) for k in range(n)]


class PlainToxicity:
    """FTRL-proximal by coordinate, over features named by what they are made of."""

    def __init__(self, rows):
        m = [int(x) for x in toxicity._MIX]
        wrap = (1 << 64) - 1

        def slot(x: int, salt: int) -> int:
            x = ((x ^ (x >> 29)) * m[0] + salt) & wrap
            return (((x ^ (x >> 32)) * m[1]) & wrap) >> (64 - toxicity.BITS)

        def features(text: str) -> set[int]:
            ids = [zlib.crc32(w.encode()) for w in re.findall(r"[^\W\d_]+", text.lower())]
            pairs = {slot((a * m[1] + b * m[2]) & wrap, 2) for a, b in zip(ids, ids[1:])}
            return {slot(a, 1) for a in ids} | pairs | {slot((a * m[3] + b * m[4]) & wrap, 3) for a, b in zip(ids, ids[2:])}

        self.features, self.z, self.n = features, {}, {}
        prior = (sum(y for _, y in rows) + 1) / (len(rows) + 2)
        self.bias = math.log(prior / (1 - prior))
        data = [(features(t), y) for t, y in rows]
        for _ in range(toxicity.EPOCHS):
            for f, y in data:
                w = {i: self.weight(i) for i in f}
                g = 1 / (1 + math.exp(-(self.bias + sum(w.values())))) - y
                for i in f:
                    before = self.n.get(i, 0.0)
                    self.z[i] = self.z.get(i, 0.0) + g - (math.sqrt(before + g * g) - math.sqrt(before)) / toxicity.ALPHA * w[i]
                    self.n[i] = before + g * g
                self.bias -= toxicity.BIAS_RATE * g

    def weight(self, i: int) -> float:
        z = self.z.get(i, 0.0)
        return 0.0 if abs(z) <= toxicity.L1 else -(z - math.copysign(toxicity.L1, z)) / ((toxicity.BETA + math.sqrt(self.n[i])) / toxicity.ALPHA + toxicity.L2)

    def total(self, text: str) -> float:
        return self.bias + sum(self.weight(i) for i in self.features(text))


@pytest.mark.parametrize("l1", [toxicity.L1, 0.3])
def test_toxicity_against_a_plain_version(monkeypatch, l1):
    monkeypatch.setattr(toxicity, "L1", l1)
    rows = sampled(5)
    plain, scorer = PlainToxicity(rows), toxicity.Scorer(toxicity.train(iter(rows)))
    assert int((scorer.weights != 0).sum()) == sum(plain.weight(i) != 0 for i in plain.z) and scorer.bias == pytest.approx(plain.bias)
    totals = [max(-toxicity.CLIP, min(toxicity.CLIP, plain.total(t))) for t, _ in rows]
    # The calibration is where the penalised likelihood is flat.
    p = [1 / (1 + math.exp(-(scorer.at + scorer.slope * x))) for x in totals]
    assert sum(a - y for a, (_, y) in zip(p, rows)) + 1e-3 * scorer.at == pytest.approx(0, abs=1e-5)
    assert sum((a - y) * x for a, x, (_, y) in zip(p, totals, rows)) + 1e-3 * scorer.slope == pytest.approx(0, abs=1e-4)
    for text, _ in [*rows[:30], *sampled(6, 30), ("", 0), ("9 _ 9", 0)]:
        x = max(-toxicity.CLIP, min(toxicity.CLIP, plain.total(text)))
        assert scorer.score(text) == pytest.approx(1 / (1 + math.exp(-(scorer.at + scorer.slope * x))), abs=1e-6)


def plain_sizes(model: dict, text: str) -> tuple[int, int, int]:
    """Bytes, and compressed bytes with the good and with the bad dictionary, a frame for each KB less what every frame has."""
    z = pytest.importorskip("zstandard")
    raw, out = text.encode(), []
    for side in ("good", "bad"):
        c = z.ZstdCompressor(level=quality.LEVEL, dict_data=z.ZstdCompressionDict(model[side]), write_content_size=False, write_checksum=False, write_dict_id=False)
        out.append(sum(len(c.compress(raw[i : i + 1024])) - 4 for i in range(0, len(raw), 1024)))
    return len(raw), *out


def test_quality_against_a_plain_version(spark):
    """Sizes by whole frames, scores of all documents by the definition, and weights where the penalised likelihood is flat."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    raw = quality.fit_quality(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    m = pickle.loads(raw)
    texts = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
    got = {r["doc_id"]: r["score"] for r in quality.score_quality(docs, raw).select("doc_id", "score").collect()}
    for i, text in list(texts.items())[:150]:
        n, a, b = plain_sizes(m, text)
        x = (plain_features(n, a, b) - m["mean"]) / m["scale"]
        assert got[i] == pytest.approx(1 / (1 + math.exp(-(m["weights"][0] + float(x @ m["weights"][1:])))), abs=1e-6)
    assert set(got) == set(texts)


def plain_features(n: int, a: int, b: int) -> np.ndarray:
    share, size = min(a, b) / (n + quality.SMOOTH), math.log1p(n)
    return np.array([(b - a) / (a + b + quality.SMOOTH), share, share * share, size, size * size])
