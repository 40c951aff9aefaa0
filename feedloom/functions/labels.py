"""Congestion labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label codes for the model, levels for the series, missing label.
ORDINAL = {"None": 0, "Mild": 1, "Medium": 2, "Heavy": 3}
LEVEL = {"None": 1, "Mild": 2, "Medium": 3, "Heavy": 4, "NaN": 1}
MISSING = "NaN"


def lookup(c, mapping: dict) -> Column:
    """Value of ``c`` in a literal map; unknown keys give NULL."""
    c = F.col(c) if isinstance(c, str) else c
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), c)


def ordinal(c, mapping: dict = ORDINAL) -> Column:
    return lookup(c, mapping)


def level(c, mapping: dict = LEVEL) -> Column:
    """Level of a label; a missing label counts as the lowest level."""
    c = F.col(c) if isinstance(c, str) else c
    return lookup(F.coalesce(c, F.lit(MISSING)), mapping)


def is_known(c) -> Column:
    """Keeps rows whose label was observed."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNotNull() & (c != MISSING)


def show_missing(c) -> Column:
    """NULL label shown as the literal text the older table holds."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c, F.lit(MISSING))
