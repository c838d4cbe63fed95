"""Mixing: targets against filling step by step, words taken, reruns."""

from __future__ import annotations

import duckdb
import pytest

from corpusloom.llm import mixing as M


def filled(sizes: list[int], weights: list[int], times: float = 1.5, epochs: int = 2) -> list[float]:
    total, capped = times * sum(sizes), set()
    while True:
        left = total - sum(epochs * sizes[i] for i in capped)
        weight = sum(w for i, w in enumerate(weights) if i not in capped)
        share = [epochs * s if i in capped else left * weights[i] / weight for i, s in enumerate(sizes)]
        over = {i for i, s in enumerate(sizes) if i not in capped and share[i] > epochs * s}
        if not over:
            return share
        capped |= over


@pytest.mark.parametrize("sizes", [[100, 100, 100], [10, 1000, 1000], [1, 1, 5000, 3], [7], [0, 50, 20], [900, 5, 5, 5, 5, 5, 5]])
def test_targets(spark, sizes):
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    d = spark.createDataFrame([(f"s{i}", n, w) for i, (n, w) in enumerate(zip(sizes, weights))], "source string, source_size bigint, weight int")
    got = [r["target"] for r in M.water_fill(d).orderBy("source").collect()]
    assert got == pytest.approx(filled(sizes, weights))


@pytest.mark.parametrize("most", [M.MOST_BROADCAST, 0])
def test_words_taken(spark, docs_of, monkeypatch, most):
    monkeypatch.setattr(M, "MOST_BROADCAST", most)
    docs = docs_of([" ".join(["w"] * (i * 7 % 40)) for i in range(2_000)], sources=("a", "b", "b", "b", "B", None, "", "c"))
    once = sorted(map(tuple, M.mix(docs).collect()), key=str)
    assert once == sorted(map(tuple, M.mix(docs.repartition(7)).collect()), key=str) and len(once) == 2_000
    by = {r["source"]: r for r in M.mix(docs).groupBy("source").agg({"mix_target": "max", "mix_source_size": "max", "mix_copies": "max"}).collect()}
    taken = {r["source"]: r[1] for r in M.mix(docs).groupBy("source").agg({"mix_size": "sum"}).collect()}
    assert sum(r["max(mix_target)"] for r in by.values()) == pytest.approx(1.5 * sum(taken.values()))
    for r in by.values():
        assert r["max(mix_copies)"] <= 2
    words = M.mix(docs).selectExpr("source", "mix_size * mix_copies AS t").groupBy("source").sum("t").collect()
    for r in words:
        assert abs(r[1] - by[r["source"]]["max(mix_target)"]) <= 40


def test_odd_tables(odd):
    got = M.mix(odd)
    assert got.count() == odd.count() and got.columns.count("mix_size") == 1 and got.filter("_u <> 7 or _source <> 7").count() == 0
    assert M.mix(odd.limit(0)).count() == 0
    assert M.mix(odd.filter("text is null")).filter("mix_copies <> 0 or mix_target <> 0").count() == 0


@pytest.mark.parametrize(("slices", "few"), [(1024, 50_000), (4, 3), (2, 0)])
def test_slices_of_any_size_take_the_same(spark, docs_of, monkeypatch, slices, few):
    """Against the SQL, which sorts whole sources."""
    monkeypatch.setattr(M, "SLICES", slices)
    monkeypatch.setattr(M, "FEW", few)
    docs = docs_of([" ".join(["w"] * (i * 7 % 40)) for i in range(400)] + [" ".join(["w"] * 10)] * 300, sources=("a", "b", "b", "b", None))
    got = {(r["doc_id"], r["mix_size"] * r["mix_copies"]) for r in M.mix(docs).collect()}
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    assert got == set(con.execute(f"SELECT doc_id, taken FROM ({M.OP7_SQL})").fetchall())


@pytest.mark.parametrize("n", [2, 3, 20, 40])
def test_rest_on_the_edge_of_a_slice(spark, docs_of, n):
    """Equal sizes: half of a lone source is taken once more, though no slice straddles that."""
    docs = docs_of([" ".join(["w"] * 10)] * n, sources=("one",))
    taken = [r["mix_copies"] for r in M.mix(docs).orderBy(M._draw("doc_id", 7)).collect()]
    want = [2 if i * 10 + 5 <= n * 5 else 1 for i in range(n)]
    assert taken == want
