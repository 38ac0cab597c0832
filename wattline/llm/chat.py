r"""Chat formatting with typed content parts.

A turn's content is an array of parts: ``type`` (text, image, audio, document),
``text``, ``ref``, ``width``, ``height``, ``seconds``, ``pages``. A visitor over
the array flattens the parts, in order, into text and placeholders, and records
for every attachment its place, type, reference and expanded token count. An
unknown type is an attachment of no tokens. All of it is built-in expressions;
the only shuffles bring a conversation's turns together, first in runs of turns,
then the runs, so that a very long conversation arrives as a few strings.

The template is ``<turn:role>\n`` + content + ``</turn>\n``. Inside roles and
texts ``\``, ``<`` and ``>`` become ``\b``, ``\l`` and ``\g``: no control string
can occur there, and the change reverses exactly.

Defined cases: a null text, role or part list is empty; rows without a turn come
first; equal turns are ordered by role, then text; repeated rows all count; rows
without a conversation id form one conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.expressions import let

#: Turns that are joined before the conversation is.
RUN_TURNS = 256

#: Image patch edge in pixels, audio tokens a second, tokens a document page.
PATCH = 28
AUDIO_RATE = 25
PAGE_TOKENS = 512

PART = (
    "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
)

END = "</turn>\n"


def escape(text: Column) -> Column:
    for raw, code in (("\\", "\\b"), ("<", "\\l"), (">", "\\g")):
        text = F.replace(text, F.lit(raw), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for raw, code in (("<", "\\l"), (">", "\\g"), ("\\", "\\b")):
        text = F.replace(text, F.lit(code), F.lit(raw))
    return text


def text_part(text: Column) -> Column:
    """A part list that holds one text."""
    return F.array(
        F.struct(
            F.lit("text").alias("type"),
            text.alias("text"),
            *[F.lit(None).cast(t).alias(n) for n, t in (
                ("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"),
            )],
        )
    )


def _tokens(part: Column) -> Column:
    """Tokens that an attachment's placeholder expands to."""
    cells = F.ceil(part["width"] / PATCH) * F.ceil(part["height"] / PATCH)
    return F.coalesce(
        F.when(part["type"] == "image", cells)
        .when(part["type"] == "audio", F.ceil(part["seconds"] * AUDIO_RATE))
        .when(part["type"] == "document", F.lit(PAGE_TOKENS) * part["pages"])
        .cast("long"),
        F.lit(0).cast("long"),
    )


def _is_text(part: Column) -> Column:
    return part["type"].eqNullSafe("text")


def content(parts: Column) -> Column:
    """The parts as one escaped string with placeholders."""
    return F.array_join(
        F.transform(
            parts,
            lambda p: F.when(_is_text(p), escape(F.coalesce(p["text"], F.lit("")))).otherwise(
                F.concat(F.lit("<"), escape(F.coalesce(p["type"], F.lit("unknown"))), F.lit("/>"))
            ),
        ),
        "",
    )


def attachments(parts: Column) -> Column:
    """Every part that is not text, in order, with its reference and tokens."""
    return F.transform(
        F.filter(parts, lambda p: ~_is_text(p)),
        lambda p: F.struct(p["type"].alias("type"), p["ref"].alias("ref"), _tokens(p).alias("tokens")),
    )


def format_conversations(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """One row per conversation of ``turns (conv_id, turn, role, parts)``.

    ``formatted`` is the whole text; ``loss`` has, for every turn, the stretch of
    the turn's own text that is trained on (zero-based, in code points, length 0
    for other roles); ``attachments`` lists references in order with their turn's
    ordinal, and ``attachment_tokens`` adds up what they expand to.
    """
    role = F.coalesce("role", F.lit(""))
    head = F.concat(F.lit("<turn:"), escape(role), F.lit(">\n"))
    rows = turns.select("conv_id", "turn", role.alias("role"), F.coalesce("parts", F.array().cast(f"array<{PART}>")).alias("parts"))
    drawn = rows.select(
        "conv_id",
        "turn",
        "role",
        head.alias("head"),
        content(F.col("parts")).alias("body"),
        attachments(F.col("parts")).alias("files"),
    )
    one = F.struct(
        "turn",
        "role",
        F.concat("head", "body", F.lit(END)).alias("text"),
        F.struct(
            F.length("head").alias("start"),
            F.when(F.col("role") == trained_role, F.length("body")).otherwise(0).alias("length"),
        ).alias("loss"),
        F.col("files"),
    )
    run = F.floor(F.col("turn") / RUN_TURNS).alias("run")
    runs = (
        drawn.groupBy("conv_id", run)
        .agg(F.array_sort(F.collect_list(one)).alias("own"))
        .select(
            "conv_id",
            F.struct(
                "run",
                F.array_join(F.col("own.text"), "").alias("text"),
                F.col("own.loss").alias("loss"),
                F.col("own.files").alias("files"),
            ).alias("part"),
        )
    )
    whole = runs.groupBy("conv_id").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    files = F.flatten(
        F.transform(
            F.flatten(F.col("parts.files")),
            lambda own, k: F.transform(
                own, lambda a: F.struct(k.alias("turn_ordinal"), a["type"], a["ref"], a["tokens"])
            ),
        )
    )
    return whole.select(
        "conv_id",
        F.array_join(F.col("parts.text"), "").alias("formatted"),
        F.flatten(F.col("parts.loss")).alias("loss"),
        files.alias("attachments"),
    ).withColumn(
        "attachment_tokens",
        F.aggregate("attachments", F.lit(0).cast("long"), lambda total, a: total + a["tokens"]),
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted text: role, text (placeholders stay) and the raw turn."""
    raw = F.slice(F.split(formatted, END), 1, F.size(F.split(formatted, END)) - 1)
    return F.transform(
        raw,
        lambda t: F.struct(
            unescape(F.substring_index(F.substring(t, 7, 1 << 30), ">\n", 1)).alias("role"),
            unescape(
                F.substring(t, F.length(F.substring_index(t, ">\n", 1)) + 3, F.length(t))
            ).alias("text"),
            t.alias("raw"),
        ),
    )


def digests(conversations: DataFrame) -> DataFrame:
    """What ``format_conversations`` made, read back from the formatted text."""

    def measured(turns: Column) -> Column:
        trained = F.array_join(
            F.zip_with(
                turns,
                "loss",
                lambda t, m: unescape(F.substring(t["raw"], m["start"] + 1, m["length"])),
            ),
            "",
        )
        said = F.array_join(
            F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
        )
        return F.struct(
            F.size(turns).cast("long").alias("n_turns"),
            F.sha2(said, 256).alias("turns_sha256"),
            F.length(trained).cast("long").alias("loss_chars"),
            F.sha2(trained, 256).alias("loss_sha256"),
        )

    return conversations.select(
        "conv_id",
        let(read_back(F.col("formatted")), measured).alias("m"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.col("attachment_tokens"),
    ).select("conv_id", "m.*", "formatted_chars", "attachment_tokens")
