"""Naming a column exactly, and binding one once to use it many times in an expression.

Nested arithmetic such as a hash round mentions its input several times. Written naively the
expression tree doubles at every step; binding the input to a lambda variable keeps it linear.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def named(name: str) -> Column:
    """The column of exactly this name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated a single time per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def first_match(cases: Iterable[tuple[Column, Column]]) -> Column:
    """The value of the first case whose condition holds; NULL if none does."""
    (condition, value), *rest = cases
    chosen = F.when(condition, value)
    for condition, value in rest:
        chosen = chosen.when(condition, value)
    return chosen
