"""IDS event log: one JSON object per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .schemas import EVE_SCHEMA

_CORRUPT = "_corrupt"


def parse_eve(lines: DataFrame, column: str = "value") -> DataFrame:
    """Parse lines; blank and malformed ones disappear. Works on batch and stream alike.

    A line's event is exploded from an array of one: a filter or a column that follows then takes the
    parsed event, where a plain column would be parsed again for each of them.
    """
    schema = T.StructType([*EVE_SCHEMA.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    event = F.from_json(F.col(column), schema, options)
    return (
        lines.filter(F.trim(column) != "")
        .select(F.explode(F.array(event)).alias("e"))
        .filter(F.col("e").isNotNull() & F.col(f"e.{_CORRUPT}").isNull())
        .select("e.*")
        .drop(_CORRUPT)
    )


def read_eve(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_eve(spark.read.text(path))
