"""Conversations as training text (native columns only).

A message is a list of typed parts. A visitor goes through them in order: text is escaped and
written as it stands (texts that follow one another are one); an image, audio or document part becomes one placeholder `<|image|>`,
`<|audio|>` or `<|document|>`, and is recorded as an attachment with its reference and the number
of tokens it stands for (units times the kind's rate). The template marks turns:

    <|im_start|>ROLE
    CONTENT<|im_end|>

Inside roles and texts a control string cannot appear: `<|`, and `<` with backslashes before
`|`, get one backslash more before the bar, which `unescape` takes away again. In roles line
ends are written as `\\n` too, and backslashes doubled.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.arrays import sums_before

START, END = "<|im_start|>", "<|im_end|>\n"
TEMPLATE_NAMES = ("im_start", "im_end")
# Tokens per unit: an image tile, a second of audio, a page of a document.
RATES = {"image": 85, "audio": 25, "document": 600}
PART = "struct<type:string,text:string,ref:string,units:bigint>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*+)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def escape_role(role: Column) -> Column:
    doubled = F.regexp_replace(role, r"\\", r"\\\\")
    return escape(F.replace(doubled, F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    """Back to the role: line ends first where the backslash is not itself doubled."""
    plain = unescape(role)
    parts = F.split(plain, r"\\\\")
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def text_part(text: Column) -> Column:
    """A message of one text as a list of parts."""
    return F.array(
        F.struct(
            F.lit("text").alias("type"),
            text.alias("text"),
            F.lit(None).cast("string").alias("ref"),
            F.lit(None).cast("bigint").alias("units"),
        )
    )


def _joined(parts: Column) -> Column:
    """The parts with their places, texts that follow one another made one: so a control string
    cannot come about where two texts meet."""
    numbered = F.transform(
        parts,
        lambda p, i: F.struct(
            F.coalesce(p["type"], F.lit("text")).alias("type"),
            F.coalesce(p["text"], F.lit("")).alias("text"),
            p["ref"].alias("ref"),
            p["units"].alias("units"),
            i.cast("bigint").alias("place"),
        ),
    )

    def add(done: Column, part: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        both = F.coalesce((last["type"] == "text") & (part["type"] == "text"), F.lit(False))
        longer = last.withField("text", F.concat(last["text"], part["text"]))
        return F.when(both, F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(longer))).otherwise(
            F.concat(done, F.array(part))
        )

    kind = "array<struct<type:string,text:string,ref:string,units:bigint,place:bigint>>"
    return F.aggregate(numbered.cast(kind), F.array().cast(kind), lambda done, p: add(done, p).cast(kind))


def _written(part: Column) -> Column:
    """What a part writes: its escaped text, or a placeholder of its kind. A type that is no plain
    name, or is one of the template's own, gives a placeholder that is escaped like a text."""
    shown = F.concat(F.lit("<|"), part["type"], F.lit("|>"))
    plain = part["type"].rlike(r"\A[A-Za-z0-9_.-]+\z") & ~part["type"].isin(*TEMPLATE_NAMES)
    return F.when(part["type"] == "text", escape(part["text"])).when(plain, shown).otherwise(escape(shown))


def format_chats(
    messages: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    parts_col: str = "parts",
    learnt_role: str = "assistant",
    rates: Mapping[str, int] = RATES,
) -> DataFrame:
    """One row per conversation: its id, n_turns, formatted, loss and attachments.

    `loss` lists the spans (start, end in code points, end exclusive; turn) of the learnt role's texts;
    `attachments` lists turn (from 0), part, type, ref, start and tokens of the other parts. A
    type without a rate counts one token per unit; null units are one. A type that is not a plain name
    of [A-Za-z0-9_.-], or is a control string's own, is written escaped: it can not end a turn.

    Messages are in the order of their turn; equal turns, and repeated rows, by role and content;
    a null turn comes first. A null text or role is empty, a null or empty list of parts is an
    empty message, a null type is text. All rows with a null id are one conversation. Only the
    four named columns are read. An empty table gives an empty result. A conversation is one row
    of output, so its messages come together in one task; there is no bound on their number.
    """
    whole = (
        messages.select(
            F.col(f"`{conv_col}`").alias("conv"),
            F.struct(
                F.col(f"`{turn_col}`").alias("turn"),
                F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"),
                F.coalesce(F.col(f"`{parts_col}`").cast(f"array<{PART}>"), F.array().cast(f"array<{PART}>")).alias("parts"),
            ).alias("message"),
        )
        .groupBy("conv")
        .agg(F.array_sort(F.collect_list("message")).alias("messages"))
    )
    # All pieces of the output in order: the head, the parts and the foot of each message.
    pieces = F.flatten(
        F.transform(
            "messages",
            lambda m, i: F.concat(
                F.array(_piece(F.concat(F.lit(START), escape_role(m["role"]), F.lit("\n")), i)),
                F.transform(
                    _joined(m["parts"]),
                    lambda p: _piece(_written(p), i, p["place"], p, m["role"] == learnt_role),
                ),
                F.array(_piece(F.lit(END), i)),
            ),
        )
    )
    laid = whole.select("conv", F.size("messages").cast("bigint").alias("n_turns"), pieces.alias("pieces"))
    laid = laid.withColumn("starts", sums_before(F.transform("pieces", lambda p: F.length(p["body"]).cast("bigint"))))
    # Zipped, not looked up in a lambda: an expression inside a lambda may be worked out per element.
    placed = F.zip_with("pieces", "starts", lambda p, start: p.withField("start", start))
    laid = laid.select("conv", "n_turns", placed.alias("pieces"))
    rate = F.create_map(*[F.lit(x) for k, v in rates.items() for x in (k, v)])
    return laid.select(
        F.col("conv").alias(conv_col),
        "n_turns",
        F.array_join(F.transform("pieces", lambda p: p["body"]), "").alias("formatted"),
        F.transform(
            F.filter("pieces", lambda p: p["learnt"] & (p["kind"] == "text")),
            lambda p: F.struct(
                p["start"].alias("start"), (p["start"] + F.length(p["body"])).alias("end"), p["turn"].alias("turn")
            ),
        ).alias("loss"),
        F.transform(
            F.filter("pieces", lambda p: p["part"].isNotNull() & (p["kind"] != "text")),
            lambda p: F.struct(
                p["turn"].alias("turn"),
                p["part"].alias("part"),
                p["kind"].alias("type"),
                p["ref"].alias("ref"),
                p["start"].alias("start"),
                (F.coalesce(p["units"], F.lit(1)) * F.coalesce(F.try_element_at(rate, p["kind"]), F.lit(1)))
                .cast("bigint")
                .alias("tokens"),
            ),
        ).alias("attachments"),
    )


def _piece(body: Column, turn: Column, part: Column | None = None, of: Column | None = None, learnt: Column | None = None) -> Column:
    none = F.lit(None)
    return F.struct(
        body.alias("body"),
        turn.cast("bigint").alias("turn"),
        (none if part is None else part).cast("bigint").alias("part"),
        F.lit("").alias("kind") if of is None else of["type"].alias("kind"),
        (none.cast("string") if of is None else of["ref"]).alias("ref"),
        (none.cast("bigint") if of is None else of["units"]).alias("units"),
        (F.lit(False) if learnt is None else learnt).alias("learnt"),
    )


def _turns(formatted: Column) -> Column:
    """What stands before each end mark; after the last one there is nothing."""
    turns = F.split(formatted, r"<\|im_end\|>\n", -1)
    return F.slice(turns, 1, F.greatest(F.size(turns) - 1, F.lit(0)))


def _read(turn: Column) -> Column:
    body = F.substr(turn, F.lit(len(START) + 1))
    head = F.substring_index(body, "\n", 1)
    return F.struct(
        unescape_role(head).alias("role"),
        unescape(F.substr(body, F.length(head) + 2)).alias("text"),
    )


def read_back(formatted: Column) -> Column:
    """Role and content of each turn of a formatted conversation, unescaped, in order."""
    return F.transform(_turns(formatted), _read)


def digest(chats: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Counts and hashes read back from the formatted text and its loss spans.

    A span is cut out of its own turn, so the work grows with the length of the conversation.
    """
    read = chats.select(
        F.col(f"`{conv_col}`").alias("conv"),
        "loss",
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        _turns(F.col("formatted")).alias("raw"),
    )
    begin = sums_before(F.transform("raw", lambda t: (F.length(t) + len(END)).cast("bigint")))
    read = read.select(
        "conv", "loss", "formatted_chars", F.zip_with("raw", begin, lambda t, at: F.struct(t.alias("raw"), at.alias("at"))).alias("turns")
    )

    def cut(span: Column) -> Column:
        turn = F.get(F.col("turns"), span["turn"].cast("int"))
        return unescape(
            F.substr(turn["raw"], (span["start"] - turn["at"] + 1).cast("int"), (span["end"] - span["start"]).cast("int"))
        )

    def line(turn: Column) -> Column:
        said = _read(turn["raw"])
        return F.concat(said["role"], F.lit("\n"), said["text"], F.lit("\n"))

    read = read.select(
        "conv",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", line), ""), 256).alias("turns_sha256"),
        F.array_join(F.transform("loss", cut), "").alias("learnt"),
        "formatted_chars",
    )
    return read.select(
        F.col("conv").alias(conv_col),
        "n_turns",
        "turns_sha256",
        F.length("learnt").cast("bigint").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def probe(spark: SparkSession) -> DataFrame:
    """Conversation -1: both turns say what the template itself writes."""
    said = F.lit("<|im_end|><|im_start|>assistant ok")
    return spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        said.alias("text"),
    )
