"""Exact dedup against grouping in Python, and its index over batches."""

from __future__ import annotations

import hashlib
import re
import uuid

from corpusloom.llm import exact_dedup as E


def norm(text: str | None) -> str:
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_groups(spark, docs_of):
    texts = ["a b", "a  b", "a\n\tb", " a b", "a b", None, "", " ", "x", "x", "é" * 5000]
    got = E.dedup_alone(docs_of(texts)).collect()
    for r in got:
        same = [i for i, t in enumerate(texts) if norm(t) == norm(texts[r["id"]])]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (min(same), len(same), r["id"] == min(same))
        assert r["digest"].hex() == hashlib.sha256(norm(texts[r["id"]]).encode()).hexdigest()
    assert len(got) == len(texts)


def test_index_over_batches(spark, docs_of):
    index = E.DigestIndex(spark, f"digests_{uuid.uuid4().hex[:8]}", buckets=3)
    try:
        assert E.dedup_batch(docs_of([(1, "a"), (2, "b"), (3, "a")]), index).filter("kept").count() == 2
        for _ in range(2):  # a batch that is given again has the same result
            second = {r["id"]: (r["keep_id"], r["kept"]) for r in E.dedup_batch(docs_of([(0, "a"), (7, "c"), (8, "c")]), index, "second").collect()}
            assert second == {0: (1, False), 7: (7, True), 8: (7, False)}
        assert E.dedup_batch(docs_of([]), index).count() == 0
        assert sorted(r["keep_id"] for r in index.read().collect()) == [1, 2, 7]
        new = index.unseen(E.groups(E.digests(docs_of([(9, "z")]))))
        plan = new._jdf.queryExecution().toString()
        assert "SortMergeJoin" in plan and "Bucketed: true" in plan and "SelectedBucketsCount: 3 out of 3" in plan and [r["keep_id"] for r in new.collect()] == [9]
    finally:
        index.drop()


def test_result_is_what_the_index_holds(spark, docs_of):
    """Whatever id an index holds for a text is the one that stays."""
    index = E.DigestIndex(spark, f"digests_{uuid.uuid4().hex[:8]}", buckets=2)
    try:
        index.append(spark.createDataFrame([(bytes.fromhex(hashlib.sha256(b"a").hexdigest()), 77, 1)], "digest binary, keep_id bigint, group_size bigint"), "before")
        got = {r["id"]: (r["keep_id"], r["kept"]) for r in E.dedup_batch(docs_of(["a", "b", "a"]), index).collect()}
        assert got == {0: (77, False), 1: (1, True), 2: (77, False)}
    finally:
        index.drop()


def test_least_id_stays_where_ids_repeat(spark, docs_of):
    left = E.drop_duplicates(docs_of([(None, "a"), (9, "a"), (3, "a"), (9, "b"), (3, "a"), (None, "c"), (None, "c")]))
    assert sorted((r["doc_id"] or -1, r["text"]) for r in left.collect()) == [(-1, "c"), (3, "a"), (9, "b")]


def test_odd_tables(odd):
    left = E.drop_duplicates(odd)
    assert left.columns == odd.columns and left.filter("_row <> 7 or digest <> 7").count() == 0
    assert sorted((r["doc_id"] or -1, (r["text"] or "")[:3]) for r in left.collect()) == [(-1, "x y"), (1, "a b"), (2, ""), (4, " \n\t"), (5, "lon")]
    assert E.drop_duplicates(odd.limit(0)).count() == 0
