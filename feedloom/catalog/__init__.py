"""Registered queries over the given tables, each beside its SQL where one exists."""

from feedloom.catalog.base import ORACLE, QUERIES
from feedloom.catalog import basics, files, geo, model, payloads, shape, streams, wide  # noqa: F401

__all__ = ["ORACLE", "QUERIES"]
