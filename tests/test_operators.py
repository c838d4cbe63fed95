"""Document cleaning, address filters, MinHash, diacritization, components, keys, files, streams."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from corpusloom import catalog
from corpusloom.functions import documents, text as T, udfs
from corpusloom.functions.profiles import ARABIC, LATIN
from corpusloom.operators import clean, diacritize as D, minhash as M, urls
from corpusloom.plans import keys
from corpusloom.plans.components import components
from corpusloom.sources import files
from corpusloom.streaming import incremental

LONG = "this sentence has exactly eight words in it."


def test_cleaning_keeps_drops_and_counts(spark):
    texts = [" ".join([LONG] * 8), " ".join([LONG] * 7), "\n".join([LONG] * 9), " ".join([LONG] * 8 + ["no.", "no.", "no.", "no."]), "", None, "   \n" + " ".join([LONG] * 9)]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = clean.clean_documents(d, LATIN)
    by = {r["doc_id"]: r for r in got.collect()}
    assert [by[i]["drop_reason"] is None for i in range(7)] == [True, False, True, False, False, False, True]
    assert by[6]["n_removed"] == 1 and by[2]["clean_text"].count("\n") == 8
    assert clean.kept(got).count() + clean.rejects(got).count() == len(texts)
    assert clean.kept(clean.clean_documents(d.limit(0), LATIN)).count() == 0


def test_documents_are_cleaned_once_without_java_patterns(spark):
    rows = [(1, "\U0001d51fa@b.co"), (2, "a@b.co, a. b... c"), (3, None), (4, "\n\n"), (5, " ")]
    got = clean.clean_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), LATIN)
    by = {r["doc_id"]: r for r in got.collect()}
    assert [by[i]["n_masked"] for i in range(1, 6)] == [0, 1, None, 0, 0]  # a letter beyond the basic plane is a letter
    assert [by[i]["n_sentences"] for i in range(1, 6)] == [1, 4, None, 0, 1] and by[3]["drop_reason"] == "null_text"
    plan = clean.rejects(got)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "regexp" not in plan and "RLIKE" not in plan


def test_bytes_that_are_no_text_are_cleaned(spark):
    d = spark.range(1).select("id", F.expr("cast(X'61FF62' as string)").alias("text"))
    assert clean.clean_documents(d, LATIN).first()["n_sentences"] == 1


def test_functions_of_texts_agree_with_columns(spark):
    texts = ["", " ", "\n\n a.  b\t? c", "a... b.... c", "\ufdd0 a. b", "one two three four five six seven eight", " one two three four five six seven\u2003", "السلام عليكم",
             "پچژ گکی abc", "αβγ де", "\U0001d51f 漢字", "ب\u064e\u0651 ـــ بببب ، ؟ x;?,", "12 !?", None, "!! ??  ab. cd"]
    d, c = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1), F.col("t")
    for make, column in ((lambda: documents.is_script_sentence(ARABIC), T.is_script_sentence), (documents.is_long_sentence, T.is_long_sentence)):
        k = F.filter(T.sentences(T.squeeze(c)), lambda s: column(s))  # noqa: B023
        want = d.select("i", F.size(k).cast("bigint").alias("kept"), F.array_join(k, " ").alias("text")).collect()
        assert d.select("i", documents.kept_udf(spark, make)(c).alias("k")).select("i", "k.kept", "k.text").collect() == want
    for make, column in ((documents.main_script, T.main_script(c)), (lambda: documents.normalize_arabic, T.normalize_arabic(c, udfs.nfkc(spark)))):
        assert d.select("i", documents.text_udf(spark, make)(c).alias("x")).collect() == d.select("i", column.alias("x")).collect()


@pytest.mark.parametrize("name", ["keep_script_sentences", "keep_script_sentences_arabic", "keep_long_sentences", "lang_detect", "normalize_chain_nfkc"])
def test_texts_go_through_no_java_patterns(spark, sf, name):
    plan = catalog.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "regexp" not in plan and "RLIKE" not in plan


def test_letters_are_counted_in_one_pass(spark, sf):
    plan = catalog.QUERIES["gibberish_flags_detected"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "\\P{L}" not in plan


def test_addresses(spark):
    d = spark.createDataFrame([("http://blog.example.com/a",), ("HTTPS://u@x.Example.co.uk:8080?q",), ("http://1.2.3.4/x",), ("localhost",), (None,)], "url string")
    assert [r[0] for r in d.select(urls.registered_domain(F.col("url"))).collect()][:2] == ["example.com", "example.co.uk"]
    one = lambda *x: spark.createDataFrame([(v,) for v in x], "domain string")
    lists = urls.blocklist({"adult": one("example.com", "a.b"), "agressif": one("example.com", "example.co.uk")})
    got = {r["url"]: r["reason"] for r in urls.with_reason(d, lists).collect()}
    assert got[None] is None and got["http://blog.example.com/a"] == "adult" and list(got.values()).count("agressif") == 1
    assert urls.unblocked(d, lists).count() == 3
    assert urls.unblocked(d, urls.blocklist({"adult": one("blog.example.com")})).count() == 5


def test_address_dedup_takes_null_for_equal(spark):
    t = lambda *x: spark.createDataFrame([(v,) for v in x], "url string")
    assert [r[0] for r in urls.not_in(t("u1", None), t("u2", None)).collect()] == ["u1"]
    assert [r[0] for r in urls.not_in(t("u1", "u1"), t("u2")).collect()] == ["u1", "u1"]
    assert urls.union_urls([t("a", None), t("a", None, "b")]).count() == 3


def test_minhash_estimates_and_pairs(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(400)]
    base = [rng.sample(words, 60) for _ in range(6)]
    texts = [" ".join(b) for b in base] + [" ".join(b[:55] + rng.sample(words, 5)) for b in base] + ["", "", None]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "unique_id bigint, text string")
    sigs = M.signatures(d)
    found = {(r["id"], r["dup_id"]) for r in M.near_pairs(sigs).collect()}
    assert {(i, i + 6) for i in range(6)} <= found and all(a < b for a, b in found)
    sets = {r["unique_id"]: (set((t or "").split()), r["sig"]) for r in sigs.collect() for t in [texts[r["unique_id"]]]}
    errors = [abs(sum(x == y for x, y in zip(s, u)) / 32 - len(a & b) / len(a | b)) for i, (a, s) in sets.items() for j, (b, u) in sets.items() if i < j < 12]
    assert sum(errors) / len(errors) < 0.1
    members = {r["unique_id"]: r["rep"] for r in M.membership(sigs).collect()}
    assert members[13] == members[14] == 12  # null counts as empty
    assert sorted(r["unique_id"] for r in M.keep_one(d, sigs).collect()) == [0, 1, 2, 3, 4, 5, 12]
    with pytest.raises(ValueError):
        M.signatures(d.withColumnRenamed("unique_id", "x"))


def test_signatures_are_made_from_texts_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def told(t):
        seen.add(1)
        return t

    d = spark.createDataFrame([(i, LONG + f" {i // 2} end") for i in range(20)] + [(20, None)], "unique_id bigint, text string").repartition(2)
    sigs = M.signatures(d.withColumn("text", told.asNondeterministic()("text")))
    plan = sigs._jdf.queryExecution().executedPlan().toString()
    assert "regexp" not in plan and "sha1" not in plan
    assert {r["unique_id"] for r in M.keep_one(d, sigs).collect()} <= {*range(0, 20, 2), 20} and seen.value == 21


def test_tokens_are_hashed_as_said(spark, monkeypatch):
    monkeypatch.setattr(M, "HASHES_AT_ONCE", 3)
    texts = ["b-a b, a' _ ²x \u064b \U0001d51f c\u2028d", "", "?! ...", None, "one two three four five six one"]
    d = spark.createDataFrame(list(enumerate(texts)), "unique_id bigint, text string").coalesce(1)

    def least(tokens):
        h = [int(hashlib.sha1(t.encode()).hexdigest()[:8], 16) for t in tokens]
        return [min([(x * a + b) % M.PRIME for x in h], default=M.PRIME) for a, b in zip(M.A, M.B)]

    columns = {"word": M.word_tokens, "char": M.char_tokens}
    for kind, cut in columns.items():
        want = {r[0]: least(r[1]) for r in d.select("unique_id", cut(F.coalesce("text", F.lit("")))).collect()}
        assert {r[0]: r[1] for r in M.signatures(d, tokens=kind).collect()} == want
    got = {r[0]: r[1] for r in M.signatures(d, tokens="shingle").collect()}
    assert got[4] == least(["one two three four five", "two three four five six", "three four five six one"]) and got[1] == got[3] == least([""])


def test_shards_are_saved_and_compared(spark, tmp_path):
    rng = random.Random(2)
    base = [" ".join(rng.sample([f"w{i}" for i in range(300)], 40)) for _ in range(9)]
    d = spark.createDataFrame([(i, base[i % 9] if i % 2 else base[i % 9] + f" x{i}") for i in range(36)], "unique_id bigint, text string")
    sigs = M.signatures(d).withColumn("shard", M.shard_of(F.concat(F.lit("/h/shard_"), (F.col("unique_id") % 4).cast("string"), F.lit("/"))))
    path = str(tmp_path / "index")
    assert M.write_index(sigs, path) and not M.write_index(sigs, path)
    assert M.read_signatures(spark, path).count() == 36 and {r["shard"] for r in M.read_signatures(spark, path, "2").collect()} == {"2"}
    rows = {r["unique_id"]: (r["shard"], tuple(r["sig"])) for r in sigs.collect()}
    reps: dict = {}
    for i, x in sorted(rows.items()):
        reps.setdefault(x, i)
    same = lambda a, b: sum(x == y for x, y in zip(a, b)) / 32
    banded = lambda a, b: any(a[k : k + 4] == b[k : k + 4] for k in range(0, 32, 4))
    want = {(s, t, i, j) for (s, a), i in reps.items() for (t, b), j in reps.items() if (s > t or s == t and i > j) and banded(a, b) and same(a, b) > 0.5}
    got = M.shard_duplicates(spark, path)
    assert {tuple(r)[:4] for r in got.collect()} == want and got.count() == len(want) > 10
    one = M.shard_duplicates(spark, path, ("0",), ("3",))
    assert {tuple(r)[:4] for r in one.collect()} == {x for x in want if x[:2] == ("3", "0")}
    lists = M.near_lists(one.select("id", "dup_id"))
    assert files.write_lists(lists, str(tmp_path / "3x0")) and not files.write_lists(lists, str(tmp_path / "3x0"))
    assert spark.read.json(str(tmp_path / "3x0")).count() == lists.count()


def test_last_signature_of_an_id(spark):
    d = spark.createDataFrame([(1, "a b", 1), (1, "c d", 2), (2, "c d", 1)], "unique_id bigint, text string, n int")
    got = {r["unique_id"]: r["sig"] for r in M.signatures(d, order_col="n").collect()}
    assert len(got) == 2 and got[1] == got[2]


def test_numbers_symbols_and_chunks():
    assert D.split_marks("a، b") == ["a", "، ", "b"]
    assert D.split_long("ab cd ef", 5) == ["ab cd", "ef"] and D.split_long("abcdefg hi", 3) == ["abc", "def", "g", "hi"]
    assert D.expand_symbols("5%")[0] == D.expand_symbols("5 %")[0] == "5 في المئة"
    assert [s[0] for s in D.expand_symbols("5%")[1] + D.expand_symbols("5 %")[1]] == [1, 2]


def test_only_paired_documents_words_are_compared(spark, tmp_path, monkeypatch):
    """words are made once, as numbers, and only of documents in a pair."""
    from corpusloom.queries import dedup

    base = [f"w{i}" for i in range(40)]
    texts = [" ".join(base), " ".join([*base, "x", "y", "z", "q"]), "nothing like it", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    saved, save = {}, dedup.save
    monkeypatch.setattr(dedup, "save", lambda d, tag: saved.setdefault(tag, save(d, tag)))
    got = [tuple(r) for r in dedup.exact_jaccard(spark, str(tmp_path)).collect()]
    assert got == [(0, 1, 40 / 44)]
    assert sorted(r["doc_id"] for r in saved["words"].collect()) == [0, 1] and dict(saved["words"].dtypes)["w"] == "array<bigint>"


def test_chunks_lose_no_white_space(spark):
    """a long text that begins or ends with a blank, and one with a word longer than a chunk."""
    texts = ["\tab" + " cd" * 600, "ab " * 600 + "\t", "x" * 2500 + " y", " a b", " ", ""]
    assert ["".join(D.chunks(t)) for t in texts] == texts and all(len(c) <= D.MOST for t in texts for c in D.chunks(t)[::2])
    d = spark.createDataFrame([(i, t.translate(str.maketrans("abcdxy", "ابتثجح"))) for i, t in enumerate(texts)], "i int, text string")
    for tagger, rows in ((D.identity_tagger, len(texts)), (D.dictionary_tagger({}), 3)):
        for r in D.diacritize(d, tagger).orderBy("i").collect()[:rows]:
            squeezed = r["text"].strip(" ").replace("\t", " ").replace("  ", " ")
            assert (r["diacritized_text"], r["diac_error"]) == (squeezed, None)


def test_texts_are_taken_by_size(spark, monkeypatch):
    """a batch of many texts is worked on in parts; the rows are the same, in the same order."""
    import pandas as pd

    texts = ["abc", None, "x" * 50, "", "5% 12", "y"]
    parts = list(D.by_size(pd.Series(texts, dtype=object), 8))
    assert [t for p in parts for t in p] == texts and [len(p) for p in parts] == [2, 1, 3] and not list(D.by_size(pd.Series([], dtype=object), 8))
    monkeypatch.setattr(D, "TEXT_AT_ONCE", 30)
    d = spark.createDataFrame([(i, t) for i, t in enumerate(["ثمن 3 كتب 5%", None, ""] * 40)], "i int, text string").coalesce(1)
    got = D.diacritize(d).orderBy("i").collect()
    assert [r["diacritized_text"] for r in got] == ["ثمن 3 كتب 5%", None, ""] * 40
    got = D.span_rows(d).orderBy("i").collect()
    assert [len(r["numbers"]) for r in got] == [2, 0, 0] * 40 and [r["i"] for r in got] == list(range(120))


def test_diacritization_restores_and_reports(spark):
    rows = ["كتب 007 ولد", "ثمن ٣ كتب 5%", "% كتب", None, "كتب، ولد. " * 200]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, text string")
    got = D.diacritize(d, D.dictionary_tagger({"كتب": "كَتَبَ"})).orderBy("i").collect()
    assert got[0]["diacritized_text"] == "كَتَبَ 7 ولد" and got[1]["diacritized_text"] == "ثمن 3 كَتَبَ 5%"
    assert got[2]["diac_error"] and got[0]["diac_error"] is None and len(got) == 5


def test_no_row_of_diacritization_takes_others_along(spark):
    """A run of 5,000 digits, digits of several scripts, and a tagger that fails on one text."""
    def make():
        def tag(texts):
            if any("ثثث" in t for t in texts):
                raise RuntimeError("no")
            return list(texts)
        return tag

    rows = ["كتب " + "7" * 5_000, "0" * 5_000 + "٣", "ثثث", "كتب", "1234567890123456"]
    d = spark.createDataFrame(list(enumerate(rows)), "i int, text string").coalesce(1)
    got = D.diacritize(d, make).orderBy("i").collect()
    assert [r["diacritized_text"] for r in got] == [rows[0], "3", None, "كتب", rows[4]]
    assert got[2]["diac_error"] == "RuntimeError: no" and [r["diac_error"] for r in got].count(None) == 4
    assert len(D.span_rows(d).filter("i = 0").first()["numbers"]) == 1 and D.expand_numbers("007")[1][0][2] == "7" and D.expand_numbers("000")[1][0][2] == "0"


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(200, 200 + i) for i in range(1, 50)] + [(rng.randrange(300, 340), rng.randrange(300, 340)) for _ in range(30)] + [(5, 5)]
    root: dict[int, int] = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for u, v in edges:
        a, b = sorted((find(u), find(v)))
        root[b] = a
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    loops = {u for u, v in edges if u == v} - {x for e in edges if e[0] != e[1] for x in e}
    assert got == {x: find(x) for x in root if x not in loops}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_hot_keys_join_like_others(spark, monkeypatch):
    monkeypatch.setattr(keys, "HOT_PARTS", 10)
    rows = spark.range(2_000).select(F.when(F.col("id") < 1_200, 0).otherwise(F.col("id") % 50).alias("k"), "id")
    per = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("m"))
    assert sorted(map(tuple, keys.join_per_key(rows, per, "k", "n", 2_000).collect())) == sorted(map(tuple, rows.join(per, "k").collect()))


def test_rows_go_without_moving_the_rest(spark, monkeypatch):
    d = spark.createDataFrame([(i if i % 50 else None, "x" * i) for i in range(300)], "k bigint, t string")
    for gone in ([], [7], [*range(0, 300, 3), 999], list(range(300))):
        g = spark.createDataFrame([(i,) for i in gone], "k bigint")
        for slots in (keys.SLOTS, 3):
            monkeypatch.setattr(keys, "SLOTS", slots)
            assert sorted(len(r["t"]) for r in keys.without(d, g, "k").collect()) == [i for i in range(300) if i % 50 == 0 or i not in gone]


def test_row_keys_go_by_id(spark):
    d = spark.createDataFrame([(5, "a"), (None, "b"), (2, "c"), (5, "d"), (None, "b")], "i bigint, t string").repartition(3)
    got = keys.row_key(d, "i", "n").orderBy("n").collect()
    assert [r["i"] for r in got] == [2, 5, 5, None, None] and len({r["n"] for r in got}) == 5


def test_hidden_columns_come_back(spark):
    d = spark.createDataFrame([(1, 2, 3)], "_in0 int, `a.b` int, X int")
    own, named, back = keys.hidden(d)
    out = back(own.withColumn("x", F.lit(9)), "x")
    assert out.columns == ["_in0", "a.b", "x"] and tuple(out.first()) == (1, 2, 9) and named["a.b"] == "_in1"


def test_files(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t/a.txt").write_text("one\ntwo", "utf-8")
    (tmp_path / "t/b.TXT").write_text("no", "utf-8")
    got = files.read_texts(spark, str(tmp_path / "t")).collect()
    assert [(r["doc_id"], r["text"]) for r in got] == [("a.txt", "one\ntwo")]
    d = spark.range(5)
    assert files.write_once(d, str(tmp_path / "out")) and not files.write_once(d, str(tmp_path / "out"))
    assert files.read_folder(spark, str(tmp_path / "out")).count() == files.read_tree(spark, str(tmp_path / "out")).count() == 5


def test_files_without_ids_are_left_out(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (None, "b")], "unique_id bigint, text string").coalesce(1).write.parquet(str(tmp_path / "x/one"))
    spark.createDataFrame([("c",)], "text string").coalesce(1).write.parquet(str(tmp_path / "x/two"))
    flat = tmp_path / "flat"
    flat.mkdir()
    for k, part in enumerate(sorted((tmp_path / "x").glob("*/*.parquet"))):
        part.rename(flat / f"{k}.parquet")
    assert sorted(r["text"] for r in files.read_identified(spark, str(flat)).collect()) == ["a", "b"]
    assert files.read_tree(spark, str(flat)).count() == 3
    data = tmp_path / "root/news"
    data.mkdir(parents=True)
    for part in list(flat.glob("0.parquet")):
        part.rename(data / "p.parquet")
    got = files.read_datasets(spark, str(tmp_path / "root"))
    assert {r["dataset"] for r in got.collect()} == {"news"}


def test_suffix_rules(spark, tmp_path):
    (tmp_path / "list.dat").write_text("// comment\n\ncom\nCO.uk\n*.ck\n!www.ck\na.b.example\n", "utf-8")
    rules = files.read_suffixes(spark, str(tmp_path / "list.dat"))
    assert set(rules) == {"co.uk", "*.ck", "!www.ck", "a.b.example"}
    hosts = {"x.y.co.uk": "y.co.uk", "co.uk": "co.uk.", "a.b.ck": "a.b.ck", "b.ck": "b.ck.", "www.ck": "www.ck", "z.www.ck": "www.ck", "q.a.b.example": "q.a.b.example", "b.example": "b.example", "ck": "ck.", "u.v.com": "v.com"}
    d = spark.createDataFrame([(h, w) for h, w in hosts.items()], "h string, w string")
    assert d.filter(urls.registered_domain(F.concat(F.lit("http://"), "h", F.lit("/p")), rules) != F.col("w")).count() == 0


def test_reports(spark, tmp_path):
    flagged = spark.createDataFrame([("u1", "adult"), ("u2", None)], "url string, reason string")
    files.write_report(flagged, str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r")).collect()[0]["reason"] == "adult"
    files.write_stats(spark.createDataFrame([(3,)], "n int"), str(tmp_path / "s"))
    assert spark.read.json(str(tmp_path / "s")).first()["n"] == 3
    assert files.read_blocklist(spark, str(tmp_path / "s")).columns == ["domain"]


def test_small_inputs_are_spread(spark, sf):
    from corpusloom.plans import shared

    d = spark.read.parquet(f"{sf}/lineitem.parquet")
    assert shared.spread(d.limit(0)).count() == 0 and shared.spread(d).count() == d.count()


def test_stream_takes_each_row_once(spark, tmp_path):
    src, out, mark = (str(tmp_path / x) for x in ("src", "out", "mark"))
    d = spark.createDataFrame([(1, " ".join([LONG] * 9)), (2, "short")], "doc_id bigint, text string")
    for n in (1, 2):
        d.write.mode("append").parquet(src)
        incremental.start(incremental.clean_stream(incremental.read_stream(spark, src), LATIN), out, mark).awaitTermination()
        assert spark.read.parquet(out).count() == n
