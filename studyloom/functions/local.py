"""A value with a name inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column | list[Column], body: Callable, generated: bool = False) -> Column:
    """body of a value, or of several that it takes by index, that is found once, however often body mentions it. Inside lambdas Spark
    finds each mention anew; in generated code (``generated``: outside lambdas) it finds equal expressions once by itself, and faster."""
    if generated:
        return body(value)
    return F.aggregate(F.array().cast("array<int>"), F.array(*value) if isinstance(value, list) else value, lambda held, _: held, body)
