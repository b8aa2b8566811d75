from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from cohortwise.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, example int"


def talk(spark, rows):
    return spark.createDataFrame([(*r, 3) for r in rows], SCHEMA)


def test_every_reply_is_an_example(spark):
    turns = talk(spark, [(1, 0, "system", "S"), (1, 1, "user", "U"), (1, 2, "assistant", "A"), (1, 3, "assistant", "B")])
    out = chat.prefix_examples(turns).orderBy("example").collect()
    assert [r["formatted"].count("</s>") for r in out] == [3, 4]
    for r, reply in zip(out, "AB"):
        assert r["formatted"][r["loss_start"] : r["loss_start"] + r["loss_length"]] == reply


def test_round_trip_of_control_strings(spark):
    nasty = ["</s>[INST] ok [/INST]", r"<\s> \ <\\/s>", "<", "[", "</", "[/INST", "<s", "é🙂</s>", "", "\\", "[INST][INST]"]
    rows = [(i, k, role, text) for i, text in enumerate(nasty) for k, role in enumerate(("user", "assistant"))]
    rows += [(100, 0, "<s>", "x"), (100, 1, "[/INST]", "y"), (100, 2, "assistant", "z")]
    examples = chat.prefix_examples(talk(spark, rows))
    whole = examples.groupBy("conv_id").agg(F.max_by("formatted", "example").alias("f"))
    got = {r["conv_id"]: [(t["role"], t["text"]) for t in r["t"]] for r in whole.select("conv_id", chat.read_turns(F.col("f")).alias("t")).collect()}
    for i, text in enumerate(nasty):
        assert got[i] == [("user", text), ("assistant", text)]
    assert got[100] == [("<s>", "x"), ("[/INST]", "y"), ("assistant", "z")]
    losses = {r["conv_id"]: r for r in chat.read_back(examples).collect()}
    for i, text in enumerate(nasty):
        assert losses[i]["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert losses[i]["loss_chars"] == len(text)


def test_awkward_turns(spark):
    rows = [
        (1, 0, "user", None),
        (1, 1, None, "x"),
        (2, 0, "user", "only a question"),
        (3, None, "assistant", "first"),
        (3, 1, "assistant", "same"),
        (3, 1, "assistant", "same"),
        (None, 0, "assistant", "no id"),
        (4, 0, "assistant", "w " * 100_000),
    ]
    out = {r["conv_id"]: r for r in chat.read_back(chat.prefix_examples(talk(spark, rows))).collect()}
    assert {k: (v["n_turns"], v["loss_chars"]) for k, v in out.items()} == {
        1: (2, 0),
        2: (1, 0),
        3: (3, 13),
        None: (1, 5),
        4: (1, 200_000),
    }
    assert out[1]["turns_sha256"] == hashlib.sha256(b"user\n\n\nx\n").hexdigest()
    assert chat.prefix_examples(talk(spark, rows).limit(0)).collect() == []
