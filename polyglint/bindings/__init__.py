"""Importing this package registers every query."""

from . import aggregates, graphs, models, scalars, stages, texts  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
