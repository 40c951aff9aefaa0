"""Binding a value inside one expression."""

from __future__ import annotations

from pyspark.sql import functions as F


def let(value, body):
    """``body`` of a value that is computed once per row: a lambda that names an outer
    column would see its expression again for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)
