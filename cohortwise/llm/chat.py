"""Chat formatting: one training example per assistant turn.

A turn is written as ``<s>[INST]role[/INST]text</s>``. Control strings inside a
role or text get one more backslash after their first character, which is taken
off again when the output is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The marks of a turn and what is escaped.
OPEN, MIDDLE, CLOSE = "<s>[INST]", "[/INST]", "</s>"
PLAIN = r"([<\[])(\\*/?(?:s>|INST\]))"
ESCAPED = r"([<\[])\\(\\*/?(?:s>|INST\]))"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(PLAIN), F.lit(r"$1\\$2"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(ESCAPED), F.lit("$1$2"))


def prefix_examples(turns: DataFrame, trained: str = "assistant") -> DataFrame:
    """``turns(conv_id, turn, role, text)`` to ``(conv_id, example, formatted,
    loss_start, loss_length, trainable)``.

    Every turn of the trained role gives an example of all preceding turns and
    that turn; the loss covers its escaped text alone (start from 0, in code
    points). A conversation that ends otherwise gives one more example, without
    loss, so that no turn is lost.

    Null roles and texts are empty. Turns of equal number are ordered by role and
    text; a null number comes first; repeated rows stay. Rows with a null
    conversation id form one conversation. Other columns are not read. A
    conversation is held in one row, as its examples are.
    """
    part = F.struct(
        F.col("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    talks = turns.select("conv_id", part.alias("part")).groupBy("conv_id")
    talks = talks.agg(F.array_sort(F.collect_list("part")).alias("parts"))
    written = F.transform(
        "parts",
        lambda p: F.struct(
            F.concat(F.lit(OPEN), escaped(p["role"]), F.lit(MIDDLE)).alias("head"), escaped(p["text"]).alias("body")
        ),
    )
    talks = talks.select("conv_id", "parts", written.alias("written"))
    last = F.size("parts")
    ends = F.filter(F.sequence(F.lit(1), last), lambda i: (F.element_at("parts", i)["role"] == trained) | (i == last))
    examples = talks.select("conv_id", "parts", "written", F.posexplode(ends).alias("example", "end"))
    target = F.element_at("written", F.col("end"))
    before = F.transform(
        F.slice("written", F.lit(1), F.col("end") - 1), lambda w: F.concat(w["head"], w["body"], F.lit(CLOSE))
    )
    context = F.concat(F.array_join(before, ""), target["head"])
    trainable = F.element_at("parts", F.col("end"))["role"] == trained
    return examples.select(
        "conv_id",
        "example",
        F.concat(context, target["body"], F.lit(CLOSE)).alias("formatted"),
        F.length(context).cast("bigint").alias("loss_start"),
        F.when(trainable, F.length(target["body"])).otherwise(0).cast("bigint").alias("loss_length"),
        trainable.alias("trainable"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of an example, as an array of (role, text)."""
    blocks = F.split(formatted, CLOSE)
    blocks = F.slice(blocks, F.lit(1), F.size(blocks) - 1)

    def turn(block: Column) -> Column:
        inner = F.substr(block, F.lit(len(OPEN) + 1))
        at = F.instr(inner, F.lit(MIDDLE))
        role, text = F.substr(inner, F.lit(1), at - 1), F.substr(inner, at + len(MIDDLE))
        return F.struct(unescaped(role).alias("role"), unescaped(text).alias("text"))

    return F.transform(blocks, turn)


def loss_text(formatted: Column, start: Column, length: Column) -> Column:
    """The trained text of an example, as it was before formatting."""
    return unescaped(F.substr(formatted, (start + 1).cast("int"), length.cast("int")))


def read_back(examples: DataFrame) -> DataFrame:
    """Digests of conversations out of their examples."""
    loss = F.struct("example", loss_text(F.col("formatted"), F.col("loss_start"), F.col("loss_length")).alias("text"))
    talks = examples.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("whole"),
        F.array_sort(F.collect_list(F.when(F.col("trainable"), loss))).alias("losses"),
        F.sum(F.length("formatted")).cast("bigint").alias("formatted_chars"),
    )
    turns = read_turns(F.col("whole"))
    joined = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    losses = F.array_join(F.transform("losses", lambda x: x["text"]), "")
    return talks.select(
        "conv_id",
        F.size(turns).cast("bigint").alias("n_turns"),
        F.sha2(joined, 256).alias("turns_sha256"),
        F.length(losses).cast("bigint").alias("loss_chars"),
        F.sha2(losses, 256).alias("loss_sha256"),
        "formatted_chars",
    )
