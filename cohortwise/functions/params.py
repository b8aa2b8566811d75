"""Column functions over run parameters held as ``map<string,string>``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from cohortwise.functions.common import let
from cohortwise.functions.names import model_name, short_name

# Fixed value: parameters that describe the object to build, not the run
TECHNICAL_KEYS = ("_target_",)


def merge(first: Column, *others: Column) -> Column:
    """Maps merged left to right; on equal keys the later one wins."""
    return reduce(_merge_two, others, first)


def _merge_two(first: Column, second: Column) -> Column:
    def joined(later: Column) -> Column:
        return F.map_concat(F.map_filter(first, lambda k, _: ~F.map_contains_key(later, k)), later)

    return let(second, joined)


def base_params(date: Column, postfix: Column, random_state: Column, timestamp: Column, use_transforms: Column) -> Column:
    """Parameters every run has."""
    values = {
        "date": date, "postfix": postfix, "random_state": random_state, "timestamp": timestamp,
        "use_transforms": use_transforms,
    }
    return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v.cast("string"))])


def collect(
    base: Column, model: Column, criterion: Column, optimizer: Column, dataset: Column, preprocessing: Column
) -> Column:
    """All parameters of a run from those of its parts, later parts winning.

    The names of model, criterion and optimizer are added, read off their targets;
    ``dataset`` is the name of the dataset.
    """

    def target(part: Column) -> Column:
        return F.try_element_at(part, F.lit("_target_"))

    def entry(name: str, value: Column) -> Column:
        return F.create_map(F.lit(name), value)

    hub_path = F.try_element_at(model, F.lit("pretrained_model_name_or_path"))
    named = [entry("model_name", model_name(target(model), hub_path)), model]
    for name, part in (("criterion", criterion), ("optimizer", optimizer)):
        known = F.coalesce(*[F.try_element_at(p, F.lit(name)) for p in (model, base)], short_name(target(part)))
        named += [entry(f"{name}_name", known), part]
    return clean(merge(base, *named, entry("dataset_name", dataset), preprocessing))


def clean(
    params: Column,
    switches: Mapping[str, str] | None = None,
    technical: Sequence[str] = TECHNICAL_KEYS,
) -> Column:
    """Drop technical keys, and each key whose switch parameter is ``false``.

    ``switches`` maps a parameter to the name of the parameter that turns it on.
    """
    switches = {"sampling_method": "use_sampling"} if switches is None else switches

    def dropped(p: Column) -> Column:
        keys = F.array(*[F.lit(k) for k in technical]).cast("array<string>")
        for key, switch in switches.items():
            off = F.coalesce(F.lower(F.try_element_at(p, F.lit(switch))) == "false", F.lit(False))
            keys = F.concat(keys, F.when(off, F.array(F.lit(key))).otherwise(F.array().cast("array<string>")))
        return keys

    def kept(p: Column) -> Column:
        return let(dropped(p), lambda keys: F.map_filter(p, lambda k, _: ~F.array_contains(keys, k)))

    return let(params, kept)


def rename_metric(name: Column, renames: Mapping[str, str]) -> Column:
    """Renamed metric in lower case; names without a rename keep their own."""
    if not renames:
        return F.lower(name)
    table = F.create_map(*[F.lit(x) for pair in renames.items() for x in pair])
    return F.lower(F.coalesce(F.try_element_at(table, name), name))


def run_name(p: Column, model: Column) -> Column:
    """Run name built from the parameters of a run.

    Train runs (by tag ``type`` or by ``mode``) list optimizer, learning rate,
    weight decay and criterion, the sample size when sampling is on, and whether
    weights are pretrained. Evaluation runs list the loaded model. All runs end
    in seed, date with timestamp, and postfix.
    """

    def get(key: str, default: str | None = None) -> Column:
        value = F.try_element_at(p, F.lit(key))
        return value if default is None else F.coalesce(value, F.lit(default))

    kind, mode = get("type", "train"), get("mode", "")
    sampled = F.when(
        F.lower(get("use_sampling", "false")) == "true",
        F.concat(F.lit(";sample_to_value="), get("sample_to_value", "")),
    ).otherwise(F.lit(""))
    train = F.concat(
        F.lit(";optimizer="), short_name(get("optimizer"), lower=True),
        F.lit(";lr="), get("lr"),
        F.lit(";weight_decay="), get("weight_decay", "0.0"),
        F.lit(";criterion="), short_name(get("criterion"), lower=True),
        sampled,
        F.lit(";pretrained="), F.lower(get("use_pretrained", "true")),
    )
    evaluate = F.concat(F.lit(";pretrained_model="), get("pretrained_model", ""))
    middle = (
        F.when((kind == "train") | (mode == "train"), train)
        .when((kind == "eval") | (mode == "evaluate"), evaluate)
        .otherwise(F.lit(""))
    )
    return F.concat(
        F.coalesce(get("model_name"), F.lower(model)), middle,
        F.lit(";seed="), get("random_state"),
        F.lit(";"), get("date"), F.lit("-"), get("timestamp"),
        F.lit(";"), get("postfix"),
    )
