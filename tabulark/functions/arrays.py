"""Helpers for array expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` (a one-element transform).
    Without it, an expression used inside a lambda is redone for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)
