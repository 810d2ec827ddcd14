"""Values of column expressions that are computed once and used many times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of the value as a lambda variable: written into other lambdas as an expression, it would be computed for each of their elements."""
    return F.element_at(F.transform(F.array(value), body), 1)


def free(name: str, taken: list[str]) -> str:
    """``name``, with underscores before it until no column has it."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name
