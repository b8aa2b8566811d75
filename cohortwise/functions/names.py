"""Column functions over paths and names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def join_path(base: Column, name: Column) -> Column:
    """Base folder and file name as one path; an absolute name stands alone."""
    return (
        F.when(name.startswith("/") | (base == ""), name)
        .when(base.endswith("/"), F.concat(base, name))
        .otherwise(F.concat(base, F.lit("/"), name))
    )


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def parent_name(path: Column) -> Column:
    """Name of the folder a file lies in."""
    return F.substring_index(F.substring_index(path, "/", -2), "/", 1)


def patient_id(path: Column) -> Column:
    """Base name up to its first dot."""
    return F.substring_index(base_name(path), ".", 1)


def scan_number(path: Column) -> Column:
    """Integer in the last three characters of the first ``-`` field, else null."""
    return F.right(F.substring_index(patient_id(path), "-", 1), F.lit(3)).try_cast("int")


def zero_pad(number: Column, width: int) -> Column:
    """Number with leading zeros; longer numbers are kept whole."""
    return F.format_string(f"%0{width}d", number)


def short_name(dotted: Column, lower: bool = False) -> Column:
    """Last part of a dotted name."""
    last = F.substring_index(dotted, ".", -1)
    return F.lower(last) if lower else last


def model_name(target: Column, pretrained_path: Column) -> Column:
    """Short model name; models loaded by path are named by its last part."""
    short = short_name(target, lower=True)
    return F.when(short == "from_pretrained", base_name(pretrained_path)).otherwise(short)
