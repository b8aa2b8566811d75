"""Column functions over label strings and label arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Fixed values
NO_FINDING = "No Finding"
PROMPT_BASE = "A photo of a lung xray"
PROMPT_LINK = "depicting visible"


def split_labels(labels: Column) -> Column:
    """``A|B|C`` as an array."""
    return F.split(labels, r"\|")


def split_mixed(labels: Column) -> Column:
    """Label string split on both ``|`` and ``,``."""
    return F.split(labels, r"[|,]")


def has_label(labels: Column, label: str) -> Column:
    """Whether the array holds the label; a null array holds none."""
    return F.coalesce(F.array_contains(labels, label), F.lit(False))


def label_any(labels: Column, label: str) -> Column:
    """1 when the label is present, alone or with others, else 0."""
    return has_label(labels, label).cast("int")


def mixed_positive(labels: Column, label: str) -> Column:
    """Whether the label occurs together with any other label."""
    return has_label(labels, label) & (F.size(F.array_remove(labels, label)) > 0)


def within(labels: Column, allowed: Sequence[str]) -> Column:
    """Whether no label lies outside the allowed ones."""
    extra = F.array_except(labels, F.array(*[F.lit(a) for a in allowed]))
    return F.coalesce(F.size(extra) == 0, F.lit(True))


def one_hot(labels: Column, classes: Sequence[str]) -> list[Column]:
    """One 0/1 column per class, named after it."""
    return [label_any(labels, c).alias(c) for c in classes]


def metaclass(labels: Column, positive: str, negative: str | None = None) -> Column:
    """Two-way label by substring: the positive name or the negative one."""
    negative = f"Non-{positive}" if negative is None else negative
    return F.when(labels.contains(positive), F.lit(positive)).otherwise(F.lit(negative))


def contains_any(labels: Column, wanted: Sequence[str]) -> Column:
    """Whether the string contains at least one of the wanted parts."""
    found = F.lit(False)
    for part in wanted:
        found = found | labels.contains(part)
    return found


def int_target(value: Column) -> Column:
    """Integer target, fractions cut off; null where the value is no number."""
    return value.try_cast("double").try_cast("int")


def text_prompt(labels: Column, base: str = PROMPT_BASE) -> Column:
    """Prompt text naming each label once, in array order.

    No label, or the no-finding label, gives the base text alone. One name
    stands bare, two are linked by "and", more by commas and a last "and".
    """
    labels = F.array_distinct(labels)
    count = F.size(labels)
    names = (
        F.when(count == 1, F.element_at(labels, 1))
        .when(count == 2, F.array_join(labels, " and "))
        .otherwise(
            F.concat(
                F.array_join(F.slice(labels, F.lit(1), count - 1), ", "),
                F.lit(", and "),
                F.element_at(labels, -1),
            )
        )
    )
    bare = labels.isNull() | (count == 0) | has_label(labels, NO_FINDING)
    return F.lower(F.when(bare, F.lit(base)).otherwise(F.concat(F.lit(f"{base} {PROMPT_LINK} "), names)))


def prompt_from_one_hot(classes: Sequence[str], base: str = PROMPT_BASE) -> Column:
    """Prompt text from 0/1 columns named after the classes."""
    present = F.array_compact(F.array(*[F.when(F.col(f"`{c}`") == 1, F.lit(c)) for c in classes]))
    return text_prompt(present, base)
