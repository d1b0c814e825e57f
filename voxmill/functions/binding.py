"""Naming the value of a column expression inside another expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)
