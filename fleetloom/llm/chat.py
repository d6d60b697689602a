"""Conversations as training examples, one for every assistant turn.

Every assistant turn becomes an example of its own: all turns before it are context and
only that reply is trainable. A conversation that does not end with an assistant turn
also gives one example without a trainable part, so no turn is lost.

Turns are taken by ``turn``, then role, then text; a null turn comes first, a null role or
text counts as empty, and repeated rows are turns of their own. A row without a conv_id
belongs with no other: it is a conversation of one turn, so such rows are never brought
together, however many there are. A long conversation gives text in proportion to the square of its
turns; that is the nature of the format.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
ASSISTANT = "assistant"


def escaped(text: Column) -> Column:
    """``text`` without any control string: a backslash stands before ``\\`` and inside ``<|``."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def escaped_role(role: Column) -> Column:
    """As ``escaped``, with line ends marked too, since one ends the role."""
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\\n"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def examples(conversations: DataFrame) -> DataFrame:
    """conv_id, example, n_turns, text, loss_start, loss_chars.

    ``text`` holds the context and the reply, as marked turns. The trainable part is
    ``substring(text, loss_start, loss_chars)``, in code points from 1; both are null where
    nothing is trainable.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    sorted_turns = conversations.where("conv_id is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    sorted_turns = sorted_turns.unionByName(conversations.where("conv_id is null").select("conv_id", F.array(turn).alias("turns")))

    def marked(t: Column) -> Column:
        head = F.concat(F.lit(START), escaped_role(t["role"]), F.lit("\n"))
        reply = escaped(t["text"])
        return F.struct(
            F.concat(head, reply, F.lit(END)).alias("text"),
            (t["role"] == ASSISTANT).alias("target"),
            F.length(head).alias("head"),
            F.length(reply).alias("reply"),
        )

    parts = sorted_turns.select("conv_id", F.transform("turns", marked).alias("parts"))
    last = F.size("parts")
    numbered = F.transform("parts", lambda p, i: F.struct(i.alias("at"), p["target"].alias("target"), p["head"].alias("head"), p["reply"].alias("reply")))
    targets = F.filter(numbered, lambda p: p["target"] | (p["at"] == last - 1))
    one = parts.select("conv_id", "parts", F.posexplode(targets).alias("example", "target"))
    whole = F.concat_ws("", F.transform(F.slice("parts", 1, F.col("target.at") + 1), lambda p: p["text"]))
    return one.select("conv_id", "example", (F.col("target.at") + 1).alias("n_turns"), whole.alias("text"), "target").select(
        "conv_id",
        "example",
        "n_turns",
        "text",
        F.when(F.col("target.target"), F.length("text") - len(END) - F.col("target.reply") + 1).alias("loss_start"),
        F.when(F.col("target.target"), F.col("target.reply")).alias("loss_chars"),
    )


def turns_in(text: Column) -> Column:
    """The turns marked in an example's text, as an array of role and text."""
    pieces = F.filter(F.split(text, r"<\|im_end\|>\n"), lambda p: p != "")

    def read(piece: Column) -> Column:
        body = F.substr(piece, F.lit(len(START) + 1))
        role = F.regexp_extract(body, r"^((?:[^\\\n]|\\[\s\S])*)\n", 1)
        return F.struct(unescaped(role).alias("role"), unescaped(F.substr(body, F.length(role) + 2)).alias("text"))

    return F.transform(pieces, read)


def read_back(made: DataFrame) -> DataFrame:
    """A row per conversation with its turns and its trainable texts, read from the examples.

    conv_id, turns (of the longest example), replies (of all examples, in order),
    formatted_chars (of all examples together).
    """
    reply = F.struct("example", unescaped(F.substr("text", F.col("loss_start"), F.col("loss_chars"))).alias("reply"))
    trainable, chars = F.col("loss_start").isNotNull(), F.length("text").cast("bigint")
    several = made.where("conv_id is not null").groupBy("conv_id").agg(
        F.max_by("text", "n_turns").alias("longest"),
        F.sort_array(F.collect_list(F.when(trainable, reply))).alias("replies"),
        F.sum(chars).alias("formatted_chars"),
    )
    # A conversation without a conv_id has one turn, and so one example.
    single = made.where("conv_id is null").select(
        "conv_id", F.col("text").alias("longest"), F.array_compact(F.array(F.when(trainable, reply))).alias("replies"), chars.alias("formatted_chars")
    )
    whole = several.unionByName(single)
    return whole.select("conv_id", turns_in(F.col("longest")).alias("turns"), F.col("replies.reply").alias("replies"), "formatted_chars")


def digest(conversations: DataFrame) -> DataFrame:
    """Counts and SHA-256 of the turns and of the trainable text of every conversation."""
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.concat_ws("", "replies")
    return read_back(examples(conversations)).select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.concat_ws("", lines).cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
