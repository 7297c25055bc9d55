"""Operator 8: chat formatting by prefix-target expansion (native)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    """No ``<|`` is left in a text: a backslash becomes ``\\b`` and ``<|`` becomes ``<\\p``. Reversible."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<|"), F.lit("<\\p"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\p"), F.lit("<|")), F.lit("\\b"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    """As ``escape``; a line feed, which ends the role, becomes ``\\n``."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def chat_examples(turns: DataFrame, target: str = "assistant") -> DataFrame:
    """One example for every turn of role ``target``: ``(conv_id, example, formatted, loss_start, loss_chars)``.

    ``formatted`` holds all turns up to and with the target, each as ``<|im_start|>role, line feed, text, <|im_end|>,
    line feed``; ``loss_start`` (zero-based) and ``loss_chars`` mark the target's text in it, in code points, the only
    trainable part. A conversation that does not end in a target turn has a last example with all its turns and no
    trainable part (loss_start null), so no turn is lost.

    Turns are ordered by ``turn``, nulls first, ties by role and text; a null role or text is empty. Rows with a null
    conv_id are one conversation. A conversation is gathered in one row, as an example must be; nothing else is.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    part = F.struct(
        "turn",
        role.alias("role"),
        text.alias("raw"),
        F.concat(F.lit(START), escape_role(role), F.lit("\n")).alias("head"),
        escape(text).alias("body"),
    )
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(part)).alias("t"))
    size = F.size("t")
    ends = F.filter(F.sequence(F.lit(1), size), lambda i: (F.element_at("t", i)["role"] == target) | (i == size))
    one = whole.select("conv_id", "t", F.posexplode(ends).alias("example", "k"))
    tail = F.lit(END + "\n")
    before = F.array_join(F.transform(F.slice("t", 1, F.col("k") - 1), lambda x: F.concat(x["head"], x["body"], tail)), "")
    last = F.element_at("t", F.col("k"))
    one = one.select("conv_id", "example", F.concat(before, last["head"]).alias("context"), last["body"].alias("body"), (last["role"] == target).alias("is_target"))
    return one.select(
        "conv_id",
        F.col("example").cast("long").alias("example"),
        F.concat("context", "body", tail).alias("formatted"),
        F.when(F.col("is_target"), F.char_length("context")).cast("long").alias("loss_start"),
        F.when(F.col("is_target"), F.char_length("body")).otherwise(0).cast("long").alias("loss_chars"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of an example, read back from its text: an array of (role, text)."""
    pieces = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda p: p != "")
    return F.transform(
        pieces,
        lambda p: F.struct(
            unescape_role(F.substring_index(F.substr(p, F.lit(len(START) + 1)), "\n", 1)).alias("role"),
            unescape(F.substr(p, F.lit(2) + F.char_length(F.substring_index(p, "\n", 1)))).alias("text"),
        ),
    )


def chat_digest(examples: DataFrame) -> DataFrame:
    """Per conversation, all read back from the examples: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    The longest example holds all turns; the loss text is what the masks of all examples cover, in order.
    ``formatted_chars`` counts the code points of all examples.
    """
    loss = unescape(F.substr("formatted", (F.col("loss_start") + 1).cast("int"), F.col("loss_chars").cast("int")))
    rows = examples.select("conv_id", "example", F.coalesce(F.when(F.col("loss_start").isNotNull(), loss), F.lit("")).alias("loss"), F.char_length("formatted").cast("long").alias("chars"), "formatted")
    got = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("example", "loss"))).alias("parts"), F.max_by("formatted", "example").alias("last"), F.sum("chars").alias("formatted_chars"))
    got = got.select("conv_id", read_turns(F.col("last")).alias("turns"), F.array_join(F.transform("parts", lambda p: p["loss"]), "").alias("loss"), "formatted_chars")
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return got.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
