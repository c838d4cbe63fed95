"""Language of pages: each kind of evidence alone, and pages that lack some."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import language as L

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return L.fit_languages(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang"))


def test_text_speaks(spark, model):
    languages, raw = model
    held = spark.read.parquet(f"{SF}/documents.parquet").filter(L.held_out("doc_id") & (F.length("text") > 200))
    pages = held.select(F.col("doc_id").alias("page_id"), F.lit("http://one.example/").alias("url"), F.concat(F.lit("<p>"), "text").alias("html"), "lang")
    got = L.identify_pages(pages, languages, raw).toPandas()
    assert (got["language"] == got["lang"]).mean() > 0.95 and got["confidence"].between(0, 1).all()


def test_other_evidence_decides_where_text_is_silent(spark, model):
    languages, raw = model
    words = {"de": "<p>der Hund und die Katze sind nicht in dem Garten, aber das Haus ist alt", "fr": "<p>le chat et le chien ne sont pas dans le jardin mais la maison est vieille"}
    rows = [(i, f"https://site{i % 7}.{lang}/{i}", f"<html lang='{lang}'>{words[lang]}") for i in range(140) for lang in ("de", "fr")]
    rows += [(900, "https://new.example/", "<html lang=fr>"), (901, "https://other.de/", ""), (902, "https://site3.fr/x", None), (903, None, None), (904, "not an address", "<!-- -->")]
    p = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({n: F.lit(1) for n in ("host", "_host", "said", "pages", "c0")})
    out = L.identify_pages(p, languages, raw)
    got = {r["page_id"]: r for r in out.collect()}
    assert got[900]["language"] == "fr" and got[901]["language"] == "de" and got[902]["language"] == "fr"
    assert out.count() == len(rows) and got[903]["host"] == "" and out.filter("_host <> 1 or c0 <> 1").count() == 0
    assert L.identify_pages(p.limit(0), languages, raw).count() == 0
    assert L.fit_languages(spark.read.parquet(f"{SF}/documents.parquet").limit(0)) == ([], b"")


def test_query(spark, sf):
    got = L.op2_language_id(spark, sf)
    assert got.count() == spark.read.parquet(f"{sf}/pages.parquet").count() and got.filter("language is null").count() == 0


def _many(spark, n: int):
    """Documents in ``n`` rare languages of own words and in a common one; the ids of a last language are all held out."""
    import random
    import zlib

    rng, rows = random.Random(4), []
    said = {f"l{chr(97 + i // 26)}{chr(97 + i % 26)}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(30)] for i in range(n)}
    ids = iter(range(10**6))
    for lang, words in said.items():
        rows += [(k, " ".join(rng.choices(words, k=80)), lang) for k in [next(i for i in ids if zlib.crc32(str(i).encode()) % 5) for _ in range(2)]]
    rows += [(next(ids), " ".join(rng.choices("the cat and a dog are not in this house".split(), k=80)), "en") for _ in range(3_000)]
    rows += [(next(i for i in ids if zlib.crc32(str(i).encode()) % 5 == 0), "held out words alone", "zz")]
    return said, spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


@pytest.mark.parametrize("most", [L.MOST_BROADCAST, 0])
def test_all_languages_are_told_apart_and_learnt(spark, monkeypatch, most):
    monkeypatch.setattr(L, "MOST_BROADCAST", most)
    said, docs = _many(spark, 230 if most else 30)
    languages, raw = L.fit_languages(docs, max_rows=100)
    assert languages == sorted([*said, "en", "zz"])
    rows = [(i, "http://one.example/", f"<html lang={lang}><p>{' '.join(words * 2)}") for i, (lang, words) in enumerate(said.items())]
    rows += [(1_000 + i, "http://one.example/", x) for i, x in enumerate(("<p>" + "ЖЩ " * 300, "<p>" + "9#" * 300, ""))]
    got = {r["page_id"]: r for r in L.identify_pages(spark.createDataFrame(rows, "page_id bigint, url string, html string"), languages, raw).collect()}
    assert len(got) == len(rows)
    assert [(got[i]["declared"], got[i]["language"]) for i in range(len(said))] == [(lang, lang) for lang in said]
    assert all(r["language"] != "zz" and abs(sum(r["posterior"]) - 1) < 1e-9 for r in got.values())


def test_against_a_plain_fusion(spark):
    """Counts, smoothing and fusion by dictionaries, page by page."""
    import math
    import random
    import zlib
    from collections import Counter

    rng = random.Random(9)
    words = {"de": "der hund und katze nicht haus alt".split(), "en": "the dog and cat not house old".split(), "fr": "le chien et chat pas maison vieille".split()}
    ids = iter(i for i in range(10**4) if zlib.crc32(str(i).encode()) % 5)
    docs = [(next(ids), " ".join(rng.choices(ws, k=25)), lang) for lang, ws in words.items() for _ in range(12)]
    pages = []
    for i in range(160):
        lang = rng.choice(list(words))
        host = rng.choice([f"a{rng.randrange(4)}.one.{lang}", f"b.two.{lang}", "www.three.com", f"c{rng.randrange(3)}.three.com"])
        tag = rng.choice([f" lang={lang}", "", " lang=xx", " lang='en'"])
        pages.append((i, rng.choice([f"https://{host}/p", f"http://user@{host}:80?q", None if i % 40 == 0 else f"https://{host}"]), f"<html{tag}><p>" + " ".join(rng.choices(words[lang], k=rng.randrange(0, 12)))))
    languages, raw = L.fit_languages(spark.createDataFrame(docs, "doc_id bigint, text string, lang string"))
    got = {r["page_id"]: r for r in L.identify_pages(spark.createDataFrame(pages, "page_id bigint, url string, html string"), languages, raw).collect()}

    def slots(text: str) -> list[int]:
        b = text.lower().encode()
        return [((((b[i] << 16) | (b[i + 1] << 8) | b[i + 2]) * 2654435761) % (1 << 32)) >> 16 for i in range(len(b) - 2)]

    def softmax(logs: dict) -> dict:
        top = max(logs.values())
        e = {k: math.exp(v - top) for k, v in logs.items()}
        return {k: v / sum(e.values()) for k, v in e.items()}

    counts = {lang: Counter(s for _, t, g in docs if g == lang for s in slots(t)) for lang in languages}
    totals = {lang: sum(c.values()) for lang, c in counts.items()}

    def evidence(html: str) -> dict:
        i = slots(html.replace(html[: html.index(">") + 1], " ", 1).replace("<p>", " ", 1))
        weight = L.TRIGRAM_WEIGHT * min(1.0, L.MOST_TRIGRAMS / max(1, len(i)))
        return {g: weight * sum(math.log((counts[g][s] + L.SMOOTH) / (L.SMOOTH * L.SLOTS + totals[g])) for s in i) for g in languages}

    seen = []
    for i, url, html in pages:
        host = (url or "").split("://")[-1].split("@")[-1].split("/")[0].split("?")[0].split(":")[0] if url else ""
        tag = html[: html.index(">")].split("lang=")[-1].strip("'") if "lang=" in html else ""
        logs = evidence(html)
        seen.append((i, host, ".".join(host.split(".")[-2:]), host.split(".")[-1], tag if tag in languages else "", logs, softmax(logs)))

    def summed(place: int) -> tuple[Counter, dict]:
        n, c = Counter(r[place] for r in seen), {}
        for r in seen:
            for g in languages:
                c.setdefault(r[place], Counter())[g] += r[6][g]
        return n, c

    (host_n, host_c), (domain_n, domain_c), (_, suffix_c), (_, tag_c) = (summed(k) for k in (1, 2, 3, 4))
    total = {g: sum(r[6][g] for r in seen) for g in languages}
    share = lambda table, key, g: math.log((table[key][g] + L.TABLE_STRENGTH / len(table)) / (total[g] + L.TABLE_STRENGTH))
    for i, host, domain, suffix, tag, logs, said in seen:
        out = {}
        for g in languages:
            alpha = (total[g] + 1 / len(languages)) / (len(seen) + 1)
            d = (domain_c[domain][g] - said[g] + L.DOMAIN_STRENGTH * alpha) / (domain_n[domain] - 1 + L.DOMAIN_STRENGTH)
            h = (max(host_c[host][g] - said[g], 0.0) + L.HOST_STRENGTH * max(d, 1e-9)) / (host_n[host] - 1 + L.HOST_STRENGTH)
            out[g] = math.log(h) + share(tag_c, tag, g) + share(suffix_c, suffix, g) + logs[g]
        want = softmax(out)
        assert (got[i]["host"], got[i]["declared"]) == (host, tag)
        assert list(got[i]["posterior"]) == pytest.approx([want[g] for g in languages], abs=1e-6)
        assert got[i]["language"] == max(want, key=want.get)
    assert len(got) == len(pages)


def test_a_very_long_page(spark, model):
    languages, raw = model
    p = spark.createDataFrame([(1, "http://a.example/", "<p>" + "der Hund und die Katze sind nicht im Haus " * 60_000), (None, None, None)], "page_id bigint, url string, html string")
    got = {r["page_id"]: r["language"] for r in L.identify_pages(p, languages, raw).collect()}
    assert got[1] == "de" and len(got) == 2
