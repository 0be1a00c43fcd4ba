"""A value that is worked out once and used many times within one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated a single time.

    Common subexpressions of rules that are tried one after another are not shared by the planner.
    """
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))
