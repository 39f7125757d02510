"""Registered queries: every operator on the given tables, with its SQL twin where one exists."""

from __future__ import annotations

from . import alerts, flows, learning, sources, streams  # noqa: F401
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
