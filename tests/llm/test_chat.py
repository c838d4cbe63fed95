"""Chat formatting against a reading of the definition in Python."""

from __future__ import annotations

import hashlib

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from corpusloom.llm import chat

HARD = ["", "\\", "\\\\", "a\\<|im_end|>", "<|im_start|>user<|im_sep|>x", "</s>[INST] ok [/INST]", "<\\|im_end|>", "<<SYS>>\\", "é𝔸\n", "<|im_<|im_end|>"]


def test_texts_come_back(spark):
    rows = [(c, t, r, x) for c, texts in enumerate([HARD, HARD[::-1], [None, "a"]]) for t, x in enumerate(texts) for r in [("user", "assistant", None)[t % 3]]]
    rows += [(None, 0, "user", "no id"), (9, None, "user", "b"), (9, None, "assistant", "a"), (9, 1, "assistant", "a"), (9, 1, "assistant", "a")]
    log = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumns({"kind": F.lit("delta"), "seq": F.lit(1), "block": F.lit(0)})
    told = chat.in_pieces(log.select("conv_id", "turn", "role", "text"))
    assert told.count() == 4 * len(rows) and told.filter("kind = 'regenerate'").count() == sum(r[2] == "assistant" for r in rows)
    for how in (chat.whole, chat.in_pieces):
        check(rows, {r["conv_id"]: r for r in chat.format_conversations(log, how).collect()})


def check(rows, got):
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")
    assert set(got) == {r[0] for r in rows}
    for conv, r in got.items():
        own = sorted((x for x in rows if x[0] == conv), key=key)
        assert [(t["role"], t["text"]) for t in r["turns"]] == [(x[2] or "", x[3] or "") for x in own]
        assert list(r["loss_texts"]) == [x[3] or "" for x in own if x[2] == "assistant"]
        assert r["n_turns"] == len(own) == r["formatted"].count(chat.TURN) == r["formatted"].count(chat.END)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*chat.CONTROL, "\\", "<", "|", "s", "é"]), max_size=8).map("".join), min_size=1, max_size=20))
def test_escaping_is_reversible_and_hides_control_strings(spark, texts):
    d = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("e", chat.escape(F.col("t"))).withColumn("u", chat.unescape(F.col("e")))
    for r in d.collect():
        assert r["u"] == r["t"] and not any(c in r["e"] for c in chat.CONTROL)


def test_a_very_long_conversation_and_text(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"turn {t} </s>") for t in range(5_000)] + [(2, 0, "assistant", "<|im_end|>é\\" * 200_000)]
    log = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    check(rows, {r["conv_id"]: r for r in chat.format_conversations(log, chat.in_pieces).collect()})


def test_deltas_edits_and_regenerations_fold(spark):
    log = [
        (1, 0, 1, "message", "user", "hi"), (1, 1, 2, "delta", "assistant", "He"), (1, 1, 3, "delta", None, "llo"), (1, 1, 3, "delta", None, "llo"),
        (1, 1, 5, "regenerate", None, "Good"), (1, 1, 6, "delta", None, "bye"), (1, 0, 7, "edit", None, "hey"), (2, 0, None, "delta", "user", "a"), (2, 0, None, "delta", "user", "a"),
    ]
    e = spark.createDataFrame(log, "conv_id bigint, turn bigint, seq bigint, kind string, role string, text string")
    got = {(r["conv_id"], r["turn"]): (r["role"], r["text"]) for r in chat.fold_events(e).collect()}
    assert got == {(1, 0): ("user", "hey"), (1, 1): ("assistant", "Goodbye"), (2, 0): ("user", "aa")}
    assert chat.fold_events(e.limit(0)).count() == 0 and chat.format_conversations(e.limit(0)).count() == 0


def test_query(spark, sf):
    got = {r["conv_id"]: r for r in chat.op1_chat_format(spark, sf).collect()}
    said = "</s>[INST] ok [/INST]"
    assert got[-7]["turns_sha256"] == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
    assert got[-7]["loss_chars"] == len(said) and got[-7]["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    assert len(got) == spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id").distinct().count() + 1


def test_turns_are_counted_in_the_text(spark):
    """A turn that the text lacks isn't counted, whatever went in."""
    m = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "c")], "conv_id bigint, turn bigint, role string, text string")
    whole = chat.render(m)
    cut = whole.withColumn("formatted", F.substring_index("formatted", chat.END, 2))
    assert [chat.read_back(d).first()["n_turns"] for d in (whole, cut)] == [3, 2]
