"""Naming an intermediate value inside one expression."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often ``body`` uses it.

    Written out twice inside a lambda, a long expression would run once per array element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
