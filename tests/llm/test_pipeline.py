"""The pipeline's stages against plain versions of each."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from corpusloom.llm import exact_dedup, mixing, quality
from corpusloom.llm.simhash import fingerprint
from tests.llm.test_decontamination import brute as leaks
from tests.llm.test_exact_dedup import norm
from tests.llm.test_simhash import reachable


def test_run_against_plain_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = quality.fit_quality(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    scorer = quality.Scorer(model)
    left = {r["doc_id"]: r for r in docs.collect() if scorer.score(r["text"] or "") >= quality.THRESHOLD}
    first: dict[str, int] = {}
    for i in sorted(left):
        first.setdefault(norm(left[i]["text"]), i)
    left = {i: left[i] for i in first.values()}
    roots = reachable({i: fingerprint(r["text"]) for i, r in left.items()})
    left = {i: r for i, r in left.items() if roots[i] == i}
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    held = {x[0] for x in leaks({i: r["text"] for i, r in left.items()}, items)}
    left = {i: r for i, r in left.items() if i not in held}
    assert held and 0 < len(left) < docs.count()
    kept = spark.createDataFrame(list(left.values()), docs.schema)
    want = {r["doc_id"]: r["mix_copies"] for r in mixing.mix(kept).collect() if r["mix_copies"]}
    got = P.run(spark, sf)
    assert {r["doc_id"]: r["n"] for r in got.groupBy("doc_id").agg(F.count("*").alias("n")).collect()} == want
    assert got.filter("mix_copy < 1 or mix_copy > 2").count() == 0


@pytest.mark.parametrize("k", range(5))
def test_stages_keep_columns_and_survive_odd_tables(spark, odd, sf, k):
    """What a filter keeps is as it was; an empty table stays one."""
    stage = P.STAGES[k][1]
    for docs in (odd, odd.limit(0)):
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns if k < 4 else set(docs.columns) <= set(out.columns)
        assert out.filter("_row <> 7").count() == 0 and (docs is odd or out.count() == 0)


def test_first_of_copies_stays(spark, docs_of, sf):
    docs = docs_of([(5, "same text here"), (2, "same  text here"), (9, "other words stand here")])
    assert sorted(r["doc_id"] for r in exact_dedup.drop_duplicates(docs).collect()) == [2, 9]
    near = P.near(spark, docs_of([(5, "word " * 200), (2, "word " * 201), (9, "quite other words stand here")]), sf)
    assert sorted(r["doc_id"] for r in near.collect()) == [2, 9]
