"""Text functions on inline cases whose results follow from their definitions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import metrics, tashkeel as K, text as T, udfs
from corpusloom.functions.profiles import ARABIC, LATIN
from corpusloom.operators.gibberish import flag_gibberish


def results(spark, function, texts):
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["x"] for r in d.select("i", function(F.col("t")).alias("x")).orderBy("i").collect()]


CASES = [
    (T.sentences, {"abc... def. ghi": ["abc.", "", "def.", "ghi"], "a.... b": ["a.", ".", "b"], "": [""], "a? b!c": ["a?", "b!c"], None: None}),
    (T.mask_emails, {"نطاق spoof@PayPal.com": "نطاق Example@mail.com", "اa@b.com": "اa@b.com", "x@y.zz|": "Example@mail.com|", "": ""}),
    (T.mask_phones, {"call +1 (555) 123-4567 now": "call +999-999-9999 now", "+123": "+123", "0123456789": "0123456789"}),
    (T.cut_mark_runs, {"بعصاي!!!!!!": "بعصاي!!!", "......": "......", "؟؟؟؟": "؟؟؟؟", "!!!!...": "!!!...", "?!?!?!": "?!?"}),
    (T.blank_foreign_spans, {"ا" + "x" * 29 + "ا": "ا" + "x" * 29 + "ا", "ا" + "x" * 30 + "ا": "ا ا"}),
    (T.is_script_sentence, {"": False, "abc": False, "اا a": False, "ااا a": True, "123 456.": True}),
    (T.is_long_sentence, {"a b c d e f g": False, "a b c d e f g h": True, "": False}),
    (T.squeeze, {"  a \t\t b\n\n\nc 　": "a b\nc", "\n": ""}),
    (T.last_run_ratio, {"aaaab a": 1 / 7, "ab": 0.5, "abcd": 0.25, "": 0.0, "aaaa": 1.0, None: None, "𝔸𝔸b": 2 / 3, "x" * 100_000: 1.0}),
    (lambda c: T.has_long_last_run(c, 0.25), {"aaaab a": False, "ab": True, "abcd": False, "": False, "aaaa": True, None: None, "𝔸𝔸b": True, "bcdaaxyz": False, "bcdaaaxyz": True}),
    (lambda c: T.has_word_like(c, 5), {"با با با با": False, "با با با با با": True, "ا ا ا ا ا": False, "": False, None: None}),
    (T.main_script, {"": None, "12 !?": None, None: None, "پچژ گکی": "fa", "كتب الولد": "ar", "αβγ def": "greek", "שלום a": "hebrew", "жук bug": "cyrillic", "漢字 a": "han"}),
    (T.word_like_count, {"با با با با": 4, "با با با با با": 5, "ا ا ا": 0}),
    (lambda c: T.common_word_count(c, ARABIC), {"في من في": 2, "في من على": 3, "في، من على": 2}),
    (T.mark_share, {"abc!!": 0.4, "؟؟؟": 0.0, "": 0.0}),
    (T.shorten_elongations, {"أسسست": "أسست", "الللبنانية": "اللبنانية", "مبرووووك": "مبرووك"}),
    (T.normalize_arabic, {"وـوـو": "ووو", "?,;": "؟،؛", "1,000": "1،000", "(x)": "   "}),
    (T.core_letters, {"پ چ گ ڤ ۀ": "ب ج ك ف ه"}),
    (T.keep_core, {"هٰذا": "ه ذا", "كَتَبَ": "كتب"}),
    (lambda c: T.transliterate(T.transliterate(c, "ar2bw"), "bw2ar"), {"كَتَبَ الوَلَدُ": "كَتَبَ الوَلَدُ"}),
    (T.to_buckwalter, {"ﻻ": "lA", "ﻷﻹﻵ": "l>l<l|"}),
]


@pytest.mark.parametrize(("function", "cases"), CASES)
def test_cases(spark, function, cases):
    assert results(spark, function, list(cases)) == pytest.approx(list(cases.values())) if all(isinstance(v, float) for v in cases.values()) else results(spark, function, list(cases)) == list(cases.values())


def test_unknown_direction():
    with pytest.raises(ValueError):
        T.transliterate(F.lit("a"), "up")


def test_page_text():
    assert udfs.page_text("<p>a&amp;b<script>x</script><style>y</style><b>c</b><!-- d -->") == ("a&b c", 2)
    assert udfs.page_text(None) == (None, 0) and udfs.page_text("") == ("", 0) and udfs.page_text("plain")[0] == "plain"


def test_composed(spark):
    assert results(spark, udfs.nfkc(spark), ["ﬁ", "abc", None, "ﷺ", ""])[:3] == ["fi", "abc", None]


def test_pairs_and_back(spark):
    pairs = results(spark, K.pairs, ["كَتَبَ", "لِّ", "", "ًا"])
    assert [tuple(x) for x in pairs[0]] == [("<BOS>", "<BOS>"), ("k", "a"), ("t", "a"), ("b", "a"), ("<EOS>", "<EOS>")]
    assert [tuple(x) for x in pairs[1]][1:-1] == [("l", "<SK>")] and len(pairs[2]) == 2
    text = "كَتَبَ الوَلَدُ"
    assert results(spark, lambda c: T.from_buckwalter(K.combine(K.pairs(c))), [text]) == [text]
    ids = K.encode(K.pairs(F.col("t")))
    assert results(spark, lambda c: K.decode(ids["input_ids"], ids["target_ids"]), [text]) == [text]
    assert results(spark, lambda c: T.from_buckwalter(K.combine(K.without_case_endings(K.pairs(c)))), [text]) == ["كَتَب الوَلَدُ"]


def test_error_rates(spark):
    d = spark.createDataFrame([("a b c", "a x c"), ("", "a"), ("a", "")], "r string, h string")
    rates = metrics.error_rates(spark)
    got = [r["x"] for r in d.select(rates(metrics.words(F.col("r")), metrics.words(F.col("h"))).alias("x")).collect()]
    assert (got[0]["substitutions"], got[0]["distance"], got[0]["ref_length"]) == (1, 1, 3.0) and got[0]["error_rate"] == pytest.approx(100 / 3)
    assert got[1]["error_rate"] is None and got[2]["deletions"] == 1
    d = spark.createDataFrame([("كَتَبَ", "كَتَبُ")], "r string, h string")
    row = d.select(metrics.tag_distance(K.pairs(F.col("r")), K.pairs(F.col("h"))).alias("d"), K.mark_accuracy(K.pairs(F.col("r")), K.pairs(F.col("h"))).alias("a"), metrics.char_distance(F.lit("ab c"), F.lit("abd")).alias("c"), metrics.word_distance(F.lit("a b c"), F.lit("a x c")).alias("w")).first()
    assert (row["d"], row["c"], row["w"]) == (1, 1, 1) and row["a"] == pytest.approx(2 / 3)


def test_gibberish_reasons(spark):
    good = "the cat and the dog of the house is in the garden and to the left of it"
    texts = [None, "", "aaaaaa b", "a!b?c.d,e;f:", "xq zk", good, "0 1 2 3 4 5 6 7 8 9 the of and"]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = [r["gibberish_reason"] for r in flag_gibberish(d, LATIN).orderBy("i").collect()]
    assert got == ["null_text", "empty", "repeats", "marks", "no_words", None, "not_script"]


@pytest.mark.parametrize("near", [metrics.NEAR_SIGNS, 2])
def test_word_distance_of_any_number_of_words(spark, monkeypatch, near):
    """Over 20,000 different words; and words in common beyond the first characters."""
    monkeypatch.setattr(metrics, "NEAR_SIGNS", near)
    many = [f"w{i}" for i in range(20_500)]
    pairs = [(" ".join(many), "w7 w20300 x"), ("a b c d e f g", "a c b d x f g h"), ("a b c", "a b c"), ("a b", "x y z"), ("", "a b"), (None, "a")]
    d = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, r string, h string")
    got = [r["d"] for r in d.select("i", metrics.word_distance(F.col("r"), F.col("h")).alias("d")).orderBy("i").collect()]
    plain = [sum(metrics.edits(r.split(), h.split())) for r, h in pairs[:-1]]
    assert got == [*plain, None] and got[0] == 20_498


def test_registered_functions(spark):
    from corpusloom.functions import registry

    names = registry.register(spark, LATIN, "cl_")
    assert len(names) == len(set(names)) and "cl_html_text" in names
    said = "  call me\\t at a.b@c.de!!!!!! "
    got = spark.sql(
        "SELECT cl_mask_emails(t) AS a, cl_is_long_sentence(t, 4) AS b, cl_is_long_sentence(t, 5) AS c, cl_is_script_sentence(t, 0.99) AS d, cl_is_script_sentence(t, 0.5) AS e, "
        "cl_registered_domain('http://x.y.co.uk/') AS f, cl_core_letters(t) AS g, cl_nfkc('\\uFB01') AS h, cl_html_text('<p>x<script>y</script>').text AS i, cl_cut_mark_runs(t) AS j, "
        f"cl_to_buckwalter(cl_from_buckwalter('ktb')) AS k, cl_word_like_count(t) AS l FROM (SELECT '{said}' AS t)"
    ).first()
    assert got["a"].strip() == "call me\t at Example@mail.com!!!!!!" and (got["b"], got["c"], got["d"], got["e"]) == (True, False, False, True)
    assert (got["f"], got["g"].strip()[:4], got["h"], got["i"], got["k"]) == ("y.co.uk", "call", "fi", "x", "ktb") and got["j"].strip().endswith("de!!!") and got["l"] == 4


def test_composition_turns_marks_round(spark):
    got = results(spark, lambda c: T.normalize_arabic(c, udfs.nfkc(spark)), ["ب\u0651\u064e", "ﷺ ﻻ", None])
    assert got == ["ب\u064e\u0651", "   ", None] or got[0] == "ب\u064e\u0651"


def test_marked_word_error_rate(spark):
    """Marks count: a word with another mark is another word."""
    d = spark.createDataFrame([("كَتَبَ وَلَدٌ", "كَتَبَ وَلَدُ"), ("كَتَبَ", "كَتَبَ")], "r string, h string")
    rates = metrics.error_rates(spark)
    got = [r["x"]["distance"] for r in d.select(rates(*(metrics.words(K.combine(K.pairs(F.col(c)))) for c in "rh")).alias("x")).collect()]
    assert got == [1, 0]


def test_a_number_after_a_phone_number(spark):
    """of more digits than a number has, the first 15 are masked, as the SQL has it, and not only the number before a blank."""
    got = results(spark, T.mask_phones, ["+49 151 123 4567 4663622617512349 x", "+1234567890123456", "+123456"])
    assert got == ["+999-999-99993622617512349 x", "+999-999-99996", "+123456"]


def test_pages_with_a_name_cut_short(spark, tmp_path):
    """A title cut within an entity. The operator decodes it as HTML says, the queries as their SQL does."""
    duckdb = pytest.importorskip("duckdb")
    from corpusloom.queries import cleaning

    html = ["<title>a = &quot</title><p>b &quot;c&quot; &amp d &copy</p>", "&quot", None]
    assert udfs.page_text(html[0])[0] == 'a = " b "c" & d ©'
    spark.createDataFrame(list(enumerate(html)), "page_id long, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in cleaning.html_text(spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    assert got == dict(con.execute(f"select page_id, text from ({cleaning.ORACLE_SQL['html_text']}) where page_id < 2").fetchall()) | {2: None}
    changed = {r["page_id"]: r["html_changed"] for r in cleaning.clean_pages(spark, str(tmp_path)).collect()}
    assert changed[0] and not changed[1]


def test_encoding_and_case_endings_as_strings(spark, monkeypatch):
    """what goes by strings and arrays of numbers is what pairs give: orphans, doubled marks, ligatures, blanks with marks, in any batches."""
    import random

    monkeypatch.setattr(K, "IDS_AT_ONCE", 40)
    draw = random.Random(1)
    texts = ["".join(draw.choices("بتكلم  ءﻻٱـxَُِّْٰ\u064b\u064c\u064d\n", k=draw.randrange(60))) for _ in range(300)] + [None, "", "َب", "بِّ", "ب ّْبَ َب"]
    by_pairs = results(spark, lambda c: K.encode(K.pairs(c)), texts)
    assert results(spark, lambda c: K.encode_text(spark)(K.buckwalter(c)), texts)[:-5] == by_pairs[:-5]
    assert results(spark, lambda c: K.buckwalter(c), texts) == results(spark, lambda c: K.combine(K.pairs(c)), texts)
    ends = results(spark, lambda c: K.combine(K.without_case_endings(K.pairs(c))), texts)
    assert results(spark, lambda c: K.without_case_endings_text(K.buckwalter(c)), texts) == ends
    got = [tuple(r) if (r := x) else r for x in results(spark, lambda c: K.encode_text(spark)(K.buckwalter(c)), texts)[-5:]]
    assert got == [None if x is None or x[0] is None else tuple(x) for x in by_pairs[-5:]]


def test_histograms_count_every_character(spark):
    """histograms are of one string each, not of a search for each character."""
    d = spark.createDataFrame([("بًًxـyxـ😀",), ("",), (None,)], "t string")
    got = [tuple(r) for r in d.select(*(v.alias(k) for k, v in T.removal_counts(F.col("t")).items())).collect()]
    assert got == [({"ً": 2}, {"ـ": 2}, {"x": 2, "y": 1, "😀": 1}), ({}, {}, {}), (None, None, None)]
    plan = d.select(T.removal_counts(F.col("t"))["marks"])._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan
