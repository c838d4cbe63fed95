"""Chat formatting: fold an event log into final messages, render them, and read them back.

Only DataFrame functions are used. A log is shuffled once, by conversation, and sorted there. A conversation is one row
of the result, so its rendered text must fit in a row, and one task folds and renders it; a conversation that holds a large
share of all messages can't be dealt out further, as its text is one string.

Cases: null text, role or kind count as empty text, empty role and a whole message; a null conversation
id is a conversation of its own; a null seq comes first; an event delivered twice with the same
seq counts once; events without seq are never merged; an empty log gives no rows; further columns
of the input are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window, functions as F

TURN, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Strings that must not be found in a rendered text unless this template put them there.
CONTROL = (TURN, SEP, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
#: Kinds of event that start a message's text anew; any other kind appends to it.
RESETS = ("message", "edit", "regenerate")

_STARTS = "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL)


def escape(text: Column) -> Column:
    """Double each backslash, then put one after the first character of each control string."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), f"(?:{_STARTS})", "$0\\\\")


def unescape(text: Column) -> Column:
    """The inverse: of two backslashes one stays, a single one goes."""
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def fold_events(events: DataFrame) -> DataFrame:
    """(conv_id, seq, turn, kind, role, text) -> (conv_id, turn, role, text), a row per message.

    Within a message, events go by seq. The last ``message``, ``edit`` or ``regenerate`` sets the
    text and each later ``delta`` appends to it; the role is the last one given. Of equal seq,
    resets come first, then texts by code point.
    """
    kind = F.coalesce(F.col("kind"), F.lit("message"))
    e = events.select(
        "conv_id", "turn", "seq", kind.isin(*RESETS).alias("reset"), "role",
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = [F.col("seq").asc_nulls_first(), F.col("reset").desc(), F.col("role").asc_nulls_first(), F.col("text")]
    w = Window.partitionBy("conv_id", "turn").orderBy(*order)
    before = F.lag(F.struct("seq", "reset", "role", "text")).over(w)
    e = e.withColumn("again", F.coalesce(before.eqNullSafe(F.struct("seq", "reset", "role", "text")), F.lit(False)) & F.col("seq").isNotNull())
    e = e.withColumn("n", F.row_number().over(w))
    whole = Window.partitionBy("conv_id", "turn")
    e = e.withColumn("from", F.coalesce(F.max(F.when(F.col("reset"), F.col("n"))).over(whole), F.lit(0)))
    e = e.withColumn("last_role", F.max_by("role", F.when(F.col("role").isNotNull(), F.col("n"))).over(whole))
    return (
        e.filter((F.col("n") >= F.col("from")) & ~F.col("again"))
        .groupBy("conv_id", "turn")
        .agg(
            F.coalesce(F.first("last_role"), F.lit("")).alias("role"),
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "text"))), lambda x: x["text"]), "").alias("text"),
        )
    )


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) -> (conv_id, n_turns, formatted, loss_spans), a row per conversation.

    ``loss_spans`` holds for each assistant message its number from 0, the code-point offset of its
    block in ``formatted``, and the start and end of its escaped text: what training takes loss on.
    """
    role, text = escape(F.coalesce("role", F.lit(""))), escape(F.coalesce("text", F.lit("")))
    head = F.concat(F.lit(TURN), role, F.lit(SEP))
    m = messages.select("conv_id", "turn", (F.col("role") == "assistant").alias("loss"), head.alias("head"), text.alias("body"))
    m = m.withColumn("head_n", F.length("head").cast("bigint")).withColumn("body_n", F.length("body").cast("bigint"))
    w = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), F.col("head"), F.col("body"))
    m = m.withColumn("no", F.row_number().over(w) - 1)
    size = F.col("head_n") + F.col("body_n") + len(END)
    m = m.withColumn("block", F.coalesce(F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    start = F.col("block") + F.col("head_n")
    blocks = F.array_sort(F.collect_list(F.struct("no", F.concat("head", "body", F.lit(END)).alias("block"))))
    span = F.struct("no", "block", start.alias("start"), (start + F.col("body_n")).alias("end"))
    return m.groupBy("conv_id").agg(
        F.count("*").alias("n_turns"),
        F.array_join(F.transform(blocks, lambda b: b["block"]), "").alias("formatted"),
        F.array_sort(F.collect_list(F.when(F.col("loss"), span))).alias("loss_spans"),
    )


def read_back(rendered: DataFrame) -> DataFrame:
    """Add ``turns`` (role, text), ``loss_texts`` and, in place of what was counted before, ``n_turns``, parsed from ``formatted``, in linear time."""
    parts = F.split("formatted", re.escape(TURN), -1)
    r = rendered.withColumn("parts", F.slice(parts, F.lit(2), F.size(parts)))
    turns = F.transform(
        "parts",
        lambda p: F.struct(
            unescape(F.substring_index(p, SEP, 1)).alias("role"),
            unescape(F.substring_index(F.substring_index(p, SEP, -1), END, 1)).alias("text"),
        ),
    )
    loss = F.transform(
        "loss_spans",
        lambda s: unescape(
            F.substring(
                F.get("parts", s["no"]),
                (s["start"] - s["block"] - len(TURN) + 1).cast("int"),
                (s["end"] - s["start"]).cast("int"),
            )
        ),
    )
    r = r.withColumn("turns", turns).withColumn("loss_texts", loss).drop("parts")
    return r.withColumn("n_turns", F.size("turns").cast("bigint"))


def in_pieces(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) -> a log of events that folds into these messages.

    Each text comes in two parts, as it is streamed: a message's first, then a delta. Before that stands another, with the parts
    the other way round, which a user's edit or an assistant's regeneration takes back.
    """
    text = F.coalesce("text", F.lit(""))
    half = F.floor(F.length(text) / 2).cast("int")
    one, two = F.substring(text, F.lit(1), half), F.substring(text, half + 1, F.length(text))
    again = F.when(F.col("role") == "assistant", F.lit("regenerate")).otherwise(F.lit("edit"))
    events = [(F.lit("message"), two), (F.lit("delta"), one), (again, one), (F.lit("delta"), two)]
    log = F.array(*(F.struct(F.lit(i).alias("seq"), kind.alias("kind"), t.alias("text")) for i, (kind, t) in enumerate(events)))
    return messages.select("conv_id", "turn", "role", F.explode(log).alias("e")).select("conv_id", "turn", "role", "e.*")


def whole(messages: DataFrame) -> DataFrame:
    """The same with an event for each message."""
    return messages.select("conv_id", "turn", F.lit(0).alias("seq"), F.lit("message").alias("kind"), "role", "text")


def format_conversations(conversations: DataFrame, log=whole) -> DataFrame:
    """Rows (conv_id, turn, role, text) as a ``log`` of events, folded, rendered and read back.

    Each row is a message, also where a turn number is null or repeated: rows go by turn, role, text.
    """
    w = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    return read_back(render(fold_events(log(conversations.select("conv_id", F.row_number().over(w).alias("turn"), "role", "text")))))


def op1_chat_format(spark, sf_dir: str) -> DataFrame:
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    probe = spark.sql(
        f"SELECT * FROM VALUES (-7L, 0L, 'user', '{said}'), (-7L, 1L, 'assistant', '{said}') AS t(conv_id, turn, role, text)"
    )
    out = format_conversations(given.unionByName(probe), in_pieces)
    loss = F.array_join("loss_texts", "")
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return out.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def _escapes(col: str) -> str:
    found = [f"(length({col}) - length(replace({col}, '{c}', ''))) // {len(c)}" for c in ("\\", *CONTROL)]
    return " + ".join(found)


OP1_SQL = f"""
WITH c AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')) v(conv_id, turn, role, text)
), f AS (
  SELECT conv_id, turn, role AS r0, text AS t0, coalesce(role, '') AS role, coalesce(text, '') AS text FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r0 NULLS FIRST, t0 NULLS FIRST)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, r0 NULLS FIRST, t0 NULLS FIRST) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({len(TURN) + len(SEP) + len(END)} + length(role) + length(text) + {_escapes("role")} + {_escapes("text")}) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
"""
