"""Batched Python functions that are made when a session first uses them, so that tasks can import their modules."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def batched(schema: str) -> Callable[[Callable], Callable[..., Column]]:
    """Makes a function of pandas series one of columns, with results of the type ``schema``."""

    def decorate(function: Callable) -> Callable[..., Column]:
        @functools.wraps(function)
        def apply(*columns: Column) -> Column:
            return F.pandas_udf(function, schema)(*columns)

        return apply

    return decorate
