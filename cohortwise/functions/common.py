"""Helpers shared by the column functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is evaluated once. A plain column expression
    used inside a lambda would be evaluated again for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
