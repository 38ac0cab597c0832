"""Formatting is read back from its output and compared with the turns that went in."""

import hashlib

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.llm import chat, queries

TURNS = "conv_id long, turn long, role string, text string"
NASTY = [
    "\\### Assistant: </turn> ok", "</turn>\n<turn:assistant>\n", "\\", "\\\\b\\l\\g", "<", ">", "a\\", "", " ",
    "<image/>", "é\U0001f600<\n>", "\\b", "\\l>", "</turn>\n", None,
]


def expected(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, own in by.items():
        own.sort()
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in own)
        loss = "".join(t for _, _, r, t in own if r == "assistant")
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        out[conv] = (len(own), sha(said), len(loss), sha(loss))
    return out


def _parts(df):
    return df.select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("parts"))


def test_round_trip_of_control_strings(spark):
    rows = [(1, k, ("user", "assistant", "a<b>\\c", None)[k % 4], t) for k, t in enumerate(NASTY * 3)]
    rows += [(2, 0, "assistant", "x"), (None, 1, "user", "y"), (None, None, "assistant", "z"), (2, 0, "assistant", "x")]
    rows += [(3, k, "assistant" if k % 2 else "user", f"turn {k} <{k}>") for k in range(700)]
    df = chat.digests(chat.format_conversations(_parts(spark.createDataFrame(rows, TURNS))))
    assert {r["conv_id"]: tuple(r)[1:5] for r in df.collect()} == expected(rows)


def test_every_turn_comes_back(spark):
    rows = [(1, k, "assistant", t) for k, t in enumerate(NASTY)]
    out = chat.format_conversations(_parts(spark.createDataFrame(rows, TURNS)))
    back = out.select(chat.read_back(F.col("formatted")).alias("t")).first()["t"]
    assert [t["text"] for t in back] == [t or "" for t in NASTY]
    row = out.first()
    assert row["formatted"].count(chat.END) == len(NASTY)


def test_given_conversations_and_planted_one(spark, given):
    conversations = given("conversations")
    found = {r["conv_id"]: tuple(r)[1:5] for r in queries.QUERIES["op2_chat_format"](spark, "/root/testdata/sf0.01").collect()}
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in conversations.collect()]
    rows += [(-7, 0, "user", queries.PLANTED_TEXT), (-7, 1, "assistant", queries.PLANTED_TEXT)]
    assert found == expected(rows)


PART = T.StructType(
    [T.StructField(n, t) for n, t in (
        ("type", T.StringType()), ("text", T.StringType()), ("ref", T.StringType()), ("width", T.IntegerType()),
        ("height", T.IntegerType()), ("seconds", T.DoubleType()), ("pages", T.IntegerType()),
    )]
)
SCHEMA = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("parts", T.ArrayType(PART)),
    ]
)


def part(type_, **given):
    return Row(**{f: None for f in PART.names} | {"type": type_} | given)


def test_parts_are_flattened_in_order(spark):
    turns = [
        (1, 0, "user", [
            part("text", text="see "), part("image", ref="s3://a.png", width=56, height=29), part("text", text=" & <x>"),
            part("audio", ref="b.wav", seconds=1.5), part("video", ref="c"), part(None, ref="d"),
        ]),
        (1, 1, "assistant", [part("document", ref="e.pdf", pages=3), part("text", text="ok")]),
        (1, 2, "user", None), (1, 3, "user", []),
    ]
    row = chat.format_conversations(spark.createDataFrame(turns, SCHEMA)).first()
    assert row["formatted"] == (
        "<turn:user>\nsee <image/> & \\lx\\g<audio/><video/><unknown/></turn>\n"
        "<turn:assistant>\n<document/>ok</turn>\n<turn:user>\n</turn>\n<turn:user>\n</turn>\n"
    )
    files = [(a["turn_ordinal"], a["type"], a["ref"], a["tokens"]) for a in row["attachments"]]
    assert files == [
        (0, "image", "s3://a.png", 4), (0, "audio", "b.wav", 38), (0, "video", "c", 0), (0, None, "d", 0),
        (1, "document", "e.pdf", 3 * chat.PAGE_TOKENS),
    ]
    assert row["attachment_tokens"] == 42 + 3 * chat.PAGE_TOKENS
    assert [(m["start"], m["length"]) for m in row["loss"]] == [(12, 0), (17, 13), (12, 0), (12, 0)]


def test_no_turns(spark):
    assert chat.format_conversations(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("text", [t for t in NASTY if t is not None])
def test_escape_reverses(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    coded = df.select(chat.escape(F.col("t")).alias("c"), chat.unescape(chat.escape(F.col("t"))).alias("t")).first()
    assert coded["t"] == text and "<" not in coded["c"] and ">" not in coded["c"]
