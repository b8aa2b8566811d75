from __future__ import annotations

import itertools
import os

import pytest
from pyspark.sql import functions as F

from cohortwise.functions import labels as L, names as N, params as P, scores as S, vectors as V


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def prompt_rule(row: dict[str, int], base: str) -> str:
    present = [c.lower() for c, v in row.items() if v == 1]
    if row.get("No Finding") == 1 or not present:
        return base.lower()
    if len(present) == 1:
        tail = present[0]
    elif len(present) == 2:
        tail = f"{present[0]} and {present[1]}"
    else:
        tail = f"{', '.join(present[:-1])}, and {present[-1]}"
    return f"{base.lower()} depicting visible {tail}"


def test_prompt_on_every_one_hot_row(spark):
    classes = ["Edema", "Mass, left", "No Finding", "Pleural Thickening"]
    rows = list(itertools.product([0, 1], repeat=4))
    df = spark.createDataFrame(rows, [f"`{c}`".strip("`") for c in classes])
    got = df.select(L.prompt_from_one_hot(classes).alias("p"), *[F.col(f"`{c}`") for c in classes]).collect()
    assert len(got) == 16
    for r in got:
        row = dict(zip(classes, r[1:]))
        assert r.p == prompt_rule(row, "A photo of a lung xray")


def test_prompt_without_exact_one_is_the_base(spark):
    df = spark.createDataFrame([(2, 0)], ["Mass", "Edema"])
    assert df.select(L.prompt_from_one_hot(["Mass", "Edema"], "Scan")).first()[0] == "scan"


def test_prompt_null_and_empty_labels(spark):
    empty = F.array().cast("array<string>")
    assert one(spark, L.text_prompt(empty, "Scan")) == "scan"
    assert one(spark, L.text_prompt(F.lit(None).cast("array<string>"), "Scan")) == "scan"


@pytest.mark.parametrize("base", ["", "/a", "/a/", "a//", "a"])
@pytest.mark.parametrize("name", ["b.png", "/b.png", "c/b.png", ""])
def test_join_path_as_the_standard_library(spark, base, name):
    if base and not name:
        expected = base if base.endswith("/") else base + "/"
    else:
        expected = os.path.join(base, name)
    assert one(spark, N.join_path(F.lit(base), F.lit(name))) == expected


@pytest.mark.parametrize(
    "path,expected",
    [
        ("/x/SUB012-A-0783-T1.nii.gz", 12),
        ("SUB1234.nii.gz", 234),
        ("/x/7", 7),
        ("/x/abc.png", None),
        ("/x/", None),
    ],
)
def test_scan_number(spark, path, expected):
    assert one(spark, N.scan_number(F.lit(path))) == expected


def test_zero_pad_keeps_long_numbers(spark):
    assert [one(spark, N.zero_pad(F.lit(n), 3)) for n in (1, 999, 12345)] == ["001", "999", "12345"]


def test_names(spark):
    assert one(spark, N.patient_id(F.lit("/a/b/0001_002.x.png"))) == "0001_002"
    assert one(spark, N.parent_name(F.lit("/a/normal/1.png"))) == "normal"
    assert one(spark, N.short_name(F.lit("torch.optim.Adam"))) == "Adam"
    assert one(spark, N.short_name(F.lit("plain"), lower=True)) == "plain"
    loaded = N.model_name(F.lit("x.Pipe.from_pretrained"), F.lit("hub/base-v1"))
    assert one(spark, loaded) == "base-v1"


def test_label_predicates_on_nulls_and_duplicates(spark):
    df = spark.createDataFrame([(1, ["A"]), (2, ["A", "A"]), (3, ["A", "B"]), (4, ["B"]), (5, None)], "k int, l array<string>")
    got = df.select(
        "k", L.label_any(F.col("l"), "A").alias("any"), L.mixed_positive(F.col("l"), "A").alias("mixed"),
        L.within(F.col("l"), ["A"]).alias("within"),
    ).collect()
    assert [tuple(r) for r in got] == [
        (1, 1, False, True), (2, 1, False, True), (3, 1, True, False), (4, 0, False, False), (5, 0, False, True),
    ]


@pytest.mark.parametrize("text,expected", [("3", 3), ("3.9", 3), ("-3.9", -3), ("x", None), (None, None), ("1e2", 100)])
def test_int_target(spark, text, expected):
    assert one(spark, L.int_target(F.lit(text).cast("string"))) == expected


def test_metaclass_is_a_substring_test(spark):
    df = spark.createDataFrame([("Pneumonia|Mass",), ("Non-Pneumonia",), ("Mass",)], ["l"])
    assert [r[0] for r in df.select(L.metaclass(F.col("l"), "Pneumonia")).collect()] == [
        "Pneumonia", "Pneumonia", "Non-Pneumonia"]
    assert one(spark, L.metaclass(F.lit("x"), "y", "rest")) == "rest"


def test_merge_last_wins_and_clean(spark):
    a = F.create_map(F.lit("lr"), F.lit("1"), F.lit("_target_"), F.lit("t"), F.lit("sampling_method"), F.lit("m"))
    b = F.create_map(F.lit("lr"), F.lit("2"), F.lit("use_sampling"), F.lit("False"))
    merged = P.merge(a, b)
    assert one(spark, merged) == {"lr": "2", "_target_": "t", "sampling_method": "m", "use_sampling": "False"}
    assert one(spark, P.clean(merged)) == {"lr": "2", "use_sampling": "False"}
    on = P.merge(merged, F.create_map(F.lit("use_sampling"), F.lit("true")))
    assert one(spark, P.clean(on)) == {"lr": "2", "use_sampling": "true", "sampling_method": "m"}


def test_run_name_by_mode(spark):
    common = {"random_state": "7", "date": "2024-01-02", "timestamp": "03-04-05", "postfix": "x"}

    def name(**params):
        pairs = [F.lit(x) for kv in {**common, **params}.items() for x in kv]
        return one(spark, P.run_name(F.create_map(*pairs), F.lit("densenet")))

    tail = ";seed=7;2024-01-02-03-04-05;x"
    assert name(type="train", optimizer="torch.optim.AdamW", lr="0.1", criterion="a.B", use_pretrained="False") == (
        "densenet;optimizer=adamw;lr=0.1;weight_decay=0.0;criterion=b;pretrained=false" + tail)
    assert name(type="train", optimizer="S", lr="1", weight_decay="0.2", criterion="c", use_sampling="true",
                sample_to_value="10", model_name="Own") == (
        "Own;optimizer=s;lr=1;weight_decay=0.2;criterion=c;sample_to_value=10;pretrained=true" + tail)
    assert name(type="eval", mode="evaluate", pretrained_model="m1") == "densenet;pretrained_model=m1" + tail
    assert name(type="diff", mode="diffusion") == "densenet" + tail


def test_run_name_lowers_a_hub_model(spark):
    params = F.create_map(*[F.lit(x) for kv in {"type": "diff", "mode": "diffusion", "random_state": "1", "date": "d",
                                                "timestamp": "t", "postfix": "p"}.items() for x in kv])
    model = N.model_name(F.lit("x.from_pretrained"), F.lit("hub/Base-V1"))
    assert one(spark, P.run_name(params, model)) == "base-v1;seed=1;d-t;p"


def test_rename_metric(spark):
    renames = {"FrechetInceptionDistance": "FID"}
    assert one(spark, P.rename_metric(F.lit("FrechetInceptionDistance"), renames)) == "fid"
    assert one(spark, P.rename_metric(F.lit("SSIM"), renames)) == "ssim"
    assert one(spark, P.rename_metric(F.lit("SSIM"), {})) == "ssim"


def test_argmax_takes_the_first_maximum(spark):
    assert one(spark, S.argmax(F.array(F.lit(1.0), F.lit(3.0), F.lit(3.0)))) == 1


def test_softmax_and_loss_are_stable(spark):
    big = F.array(F.lit(1000.0), F.lit(1000.0))
    assert one(spark, S.softmax(big)) == [0.5, 0.5]
    assert one(spark, S.cross_entropy(big, F.lit(1))) == pytest.approx(0.6931471805599453)


def test_scale_flags_values_above_the_maximum(spark):
    assert one(spark, V.scale(F.array(F.lit(0.0), F.lit(255.0)))) == [-1024.0, 1024.0]
    assert one(spark, V.scale(F.array(F.lit(256.0)))) is None


def test_channels(spark):
    v = F.array(*[F.lit(float(i)) for i in range(1, 8)])
    assert one(spark, V.channel_mean(v)) == [2.0, 5.0, 7.0]
    assert one(spark, V.channel_repeat(F.array(F.lit(1.0), F.lit(2.0)), 2)) == [1.0, 1.0, 2.0, 2.0]
    assert one(spark, V.channel_mean(F.array().cast("array<double>"))) == []


def test_pipeline_length_and_result(spark):
    load, train = [V.scale, V.channel_mean], [V.channel_repeat]
    assert len(V.pipeline_steps(load, train)) == len(load) + 1
    steps = V.pipeline_steps(load, train, use_train=True)
    assert len(steps) == len(load) + len(train) + 1
    df = spark.createDataFrame([([0.0, 127.5, 255.0],)], "v array<double>")
    out = V.apply_steps(df, "v", steps)
    assert out.first().v == [0.0, 0.0, 0.0]
    assert out.dtypes == [("v", "array<float>")]
