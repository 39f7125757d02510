"""Severity, action and priority by class: built-in dictionaries or a caller's own table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import constants as K
from ..functions.labels import action_of, severity_of
from ..functions.scalars import col, priority
from ..plans.bounded import lookup_join


def with_severity(df: DataFrame, c: str, dim: DataFrame | None = None) -> DataFrame:
    """Add ``gravite``. A given table holds the columns ``c`` and ``gravite``."""
    if dim is None:
        return df.withColumn("gravite", severity_of(col(c)))
    unknown = F.when(F.coalesce(col(c), F.lit("")) == "", K.LOWEST_SEVERITY).otherwise(K.DEFAULT_SEVERITY)
    return lookup_join(df, dim.select(c, "gravite"), [c]).withColumn("gravite", F.coalesce("gravite", unknown))


def with_action(df: DataFrame, c: str, dim: DataFrame | None = None) -> DataFrame:
    """Add ``action_recommandee``, with the general advice for unknown classes."""
    if dim is None:
        return df.withColumn("action_recommandee", action_of(col(c)))
    joined = lookup_join(df, dim.select(c, "action_recommandee"), [c])
    return joined.withColumn("action_recommandee", F.coalesce("action_recommandee", F.lit(K.DEFAULT_ACTION)))


def with_priority(df: DataFrame, c: str = "gravite") -> DataFrame:
    return df.withColumn("priorite", priority(col(c)))


def valid_sessions(events: DataFrame, dim: DataFrame, key: str, ts: str, expires: str) -> DataFrame:
    """Events whose dimension row (one per key) is still valid at the event time."""
    return lookup_join(events, dim, [key], "inner").filter(F.col(expires) > F.col(ts))
