"""Token counts against the library itself."""

from __future__ import annotations

import random

import pytest

P = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from corpusloom.llm import tokens  # noqa: E402

PATH = str(P.path("byte_bpe_50k.json"))
TEXTS = [
    "", " ", "Hello world's best, it'LL do\n\n\n  x\t\ty ", "<|endoftext|>a<|endoftext|>", "<|endoftext |>", "ﷺ العربية ١٢٣ ½ Ⅷ", "𝔸 emoji 😀😀 ‍﻿", "漢字かな交じり文", "a b c　d", "\x1c\x1d\x85x ᠎ y",
    "x" * 5000, "1234567890" * 50, "  " * 500 + "a", "don't they'Re I'VE '' 's", "ĳ Ω͂ е́ ͸ ׯ ࡰ ᲊ \U00010570",
]


def test_counts_are_the_library_s(spark, docs_of):
    t = Tokenizer.from_file(PATH)
    rng = random.Random(3)
    texts = TEXTS + ["".join(rng.choice("ab é,.'\n\t1٣中😀<|>") for _ in range(rng.randrange(200))) for _ in range(300)] + [None]
    texts.append(" ".join(rng.choice(["word", "don't", "1,000", "naïve", "\n", "x" * 60]) for _ in range(260_000)))  # in pieces
    got = {r["doc_id"]: r for r in tokens.count_tokens(docs_of(texts), PATH).collect()}
    for i, x in enumerate(texts):
        n = len(t.encode(x or "", add_special_tokens=False).ids)
        assert (got[i]["n_tokens"], got[i]["over_limit"]) == (n, n > 1024), repr((x or "")[:60])


def test_piece_cuts_and_small_caches_change_nothing(monkeypatch):
    t, rng = Tokenizer.from_file(PATH), random.Random(5)
    monkeypatch.setattr(tokens, "PIECE", 7)
    monkeypatch.setattr(tokens, "CACHED", 3)
    own = tokens.Lengths(PATH, {"the": 1})
    for _ in range(500):
        x = "".join(rng.choice("ab  '\n1é.s\x1c") for _ in range(60))
        assert own.count(x) == len(t.encode(x, add_special_tokens=False).ids), repr(x)


def test_odd_tables(odd, spark):
    got = tokens.count_tokens(odd, PATH)
    assert got.count() == odd.count() and got.filter("text is null and n_tokens <> 0").count() == 0
    assert tokens.count_tokens(odd.limit(0), PATH).count() == 0


def test_query(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet").collect()
    t = Tokenizer.from_file(PATH)
    want = {(r["doc_id"], len((r["text"] or "").encode()), n, n > 1024) for r in d for n in [len(t.encode(r["text"] or "", add_special_tokens=False).ids)]}
    assert {tuple(r) for r in tokens.op3_token_counts(spark, sf).collect()} == want
