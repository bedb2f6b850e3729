"""Registered queries and their SQL twins."""

from . import association, modelling, pages, series, tables  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
