"""Chat formatting as a relational plan: DataFrame expressions only.

A conversation becomes one string. Its turns are collected as structs and sorted by turn;
adjacent turns of one role are merged into one message, whose texts stay apart by a control
string, so that the formatting can be undone. The template:

    ### System: <text> </turn>
    ### User: <text> <|> <text> </turn>
    ### Assistant: <text> </turn>

(each message on a line of its own). Inside texts every backslash is written `\\b` and every
control string by a code of its own, so no text can open or close a message, and `unescape`
gives back the very same text. The loss mask is an array of (start, length) spans, in code
points, that covers assistant texts and nothing between them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEADER, END, NEXT = "### ", " </turn>\n", "<|>"
AFTER_ROLE = ": "
#: Control strings inside texts and what stands for them; backslash first.
CODES = [("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\e"), ("<|>", "\\n")]
TRAINED = "assistant"
EMPTY_ROLE = ""


def escape(text: Column) -> Column:
    for plain, code in CODES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(CODES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _role_name(role: Column) -> Column:
    """A role as the template shows it. Known roles get a capital; others stay as they are
    behind a sign that no capitalised role begins with, so they can be read back."""
    known = role.isin("system", "user", "assistant")
    return F.when(known, F.initcap(role)).otherwise(
        F.concat(F.lit("@"), F.replace(escape(role), F.lit(AFTER_ROLE.strip()), F.lit("\\c")))
    )


def _role_back(name: Column) -> Column:
    other = F.replace(F.substr(name, F.lit(2)), F.lit("\\c"), F.lit(AFTER_ROLE.strip()))
    return F.when(name.startswith("@"), unescape(other)).otherwise(F.lower(name))


def format_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans (array of start, length) of every conversation.

    Input: conv_id, turn, role, text; other columns are ignored. A null text or role is empty.
    Rows are ordered by turn (null first); rows with the same turn by role and text. Repeated
    rows are turns of their own. Rows with a null conv_id form one conversation. An empty
    table gives no rows. One conversation is one string, so it must fit into a row; that is
    the result's own size, not a limit of the plan.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(EMPTY_ROLE))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    collected = (
        turns.select("conv_id", F.struct(F.col("turn"), role.alias("role"), text.alias("text")).alias("t"))
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_list("t")).alias("t"))
    )
    # Where the role changes, a message begins; the last entry is one past the end.
    begins = collected.select(
        "conv_id",
        "t",
        F.filter(
            F.sequence(F.lit(0), F.size("t")),
            lambda i: (i == 0)
            | (i == F.size("t"))
            | (F.get("t", i)["role"] != F.get("t", i - 1)["role"]),
        ).alias("b"),
    )
    # A message of one struct: what stands before its text, and its escaped texts in one.
    messages = begins.select(
        "conv_id",
        F.transform(
            F.slice("b", F.lit(1), F.size("b") - 1),
            lambda i, k: F.struct(
                F.get("t", i)["role"].alias("role"),
                F.transform(
                    F.slice("t", i + 1, F.get("b", k + 1) - i), lambda x: escape(x["text"])
                ).alias("texts"),
            ),
        ).alias("m"),
    )
    rendered = messages.select(
        "conv_id",
        F.transform(
            "m",
            lambda m: F.struct(
                m["role"].alias("role"),
                F.concat(F.lit(HEADER), _role_name(m["role"]), F.lit(AFTER_ROLE)).alias("head"),
                m["texts"].alias("texts"),
            ),
        ).alias("m"),
    )
    head, tail, gap = (lambda m: F.length(m["head"])), len(END), len(NEXT)
    no_spans = F.array().cast("array<struct<start:int,length:int>>")
    start = F.struct(F.lit(0).alias("at"), no_spans.alias("spans"))

    def text_span(message: Column):
        """Move over one text and its separator; keep its span if the role is trained."""

        def step(state: Column, text: Column) -> Column:
            span = F.struct(state["at"].alias("start"), F.length(text).alias("length"))
            kept = (message["role"] == TRAINED) & (F.length(text) > 0)
            return F.struct(
                (state["at"] + F.length(text) + gap).alias("at"),
                F.when(kept, F.concat(state["spans"], F.array(span)))
                .otherwise(state["spans"])
                .alias("spans"),
            )

        return step

    def move(state: Column, message: Column) -> Column:
        inside = F.aggregate(
            message["texts"],
            F.struct((state["at"] + head(message)).alias("at"), state["spans"].alias("spans")),
            text_span(message),
        )
        return F.struct((inside["at"] - gap + tail).alias("at"), inside["spans"].alias("spans"))

    return rendered.select(
        "conv_id",
        F.array_join(
            F.transform(
                "m",
                lambda m: F.concat(m["head"], F.array_join(m["texts"], NEXT), F.lit(END)),
            ),
            "",
        ).alias("formatted"),
        F.aggregate("m", start, move)["spans"].alias("loss_spans"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """The input plus turns (array of role, text), parsed from the formatted string alone."""
    messages = F.filter(
        F.transform(
            F.split(F.col("formatted"), F.lit(END), -1),
            lambda m: F.struct(
                F.instr(m, AFTER_ROLE).alias("colon"),
                m.alias("m"),
            ),
        ),
        lambda x: x["m"] != "",
    )
    turns = F.flatten(
        F.transform(
            messages,
            lambda x: F.transform(
                F.split(F.substr(x["m"], x["colon"] + len(AFTER_ROLE)), r"<\|>", -1),
                lambda text: F.struct(
                    _role_back(
                        F.substr(x["m"], F.lit(len(HEADER) + 1), x["colon"] - len(HEADER) - 1)
                    ).alias("role"),
                    unescape(text).alias("text"),
                ),
            ),
        )
    )
    return formatted.withColumn("turns", turns)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the mask, unescaped, in order."""
    return F.array_join(
        F.transform(
            spans, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["length"]))
        ),
        "",
    )
