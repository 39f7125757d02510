"""Text, number and key helpers as Column expressions."""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

from pyspark.sql import Column, DataFrame, functions as F

from . import constants as K

BLANKS = " \t\n\r\x0b\x0c\xa0"
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def col(name: str) -> Column:
    """Column by exact name, dots and slashes included."""
    return F.col(f"`{name}`")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often the body uses it.

    Repeating a long expression in every branch of a rule would evaluate it again each time and
    blow the generated code past the compiler's limit.
    """
    return F.transform(F.array(value), body)[0]


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def text(c: Column, default: str = "") -> Column:
    return F.coalesce(c.cast("string"), F.lit(default))


def lookup(c: Column, mapping: dict, default: Column | None = None) -> Column:
    """Value of a small fixed dictionary, ``default`` (or null) when the key is absent."""
    entries = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    found = F.try_element_at(entries, c)
    return found if default is None else F.coalesce(found, default)


def first_match(c: Column, keywords: list[tuple[tuple[str, ...], str]], default: Column) -> Column:
    """Class of the first rule whose keywords all occur in ``c``."""
    branches = F
    for words, result in keywords:
        hit = F.lit(True)
        for word in words:
            hit = hit & c.contains(word)
        branches = branches.when(hit, result)
    return branches.otherwise(default)


def parse_number(c: Column) -> Column:
    """Plain decimal text as double; anything else (also nan and inf) is null."""
    value = F.regexp_extract(strip(c.cast("string")), NUMBER, 0).try_cast("double")
    return F.nullif(F.nullif(value, F.lit(float("inf"))), F.lit(float("-inf")))


def parse_integer(c: Column) -> Column:
    return F.regexp_extract(strip(text(c)), r"^[+-]?[0-9]+$", 0).try_cast("int")


def lenient_double(c: Column, default: float = 0.0) -> Column:
    return F.coalesce(parse_number(F.translate(c.cast("string"), ",", ".")), F.lit(float(default)))


def occurrences(c: Column) -> Column:
    return F.greatest(F.coalesce(parse_number(c), F.lit(1.0)), F.lit(0.0))


def first_present(df: DataFrame, names: list[str], default: str = "") -> Column:
    """First non-empty value among the named columns, names compared without case."""
    known = {c.strip().lower(): c for c in df.columns}
    hits = [F.nullif(col(known[n.strip().lower()]).cast("string"), F.lit("")) for n in names if n.strip().lower() in known]
    return F.coalesce(*hits, F.lit(default))


def parse_time(c: Column) -> Column:
    """Timestamp from either register format: plain date-time or ISO with an offset."""
    raw = strip(c.cast("string"))
    iso = F.regexp_replace(raw, r"([+-]\d{2})(\d{2})$", "$1:$2")
    return iso.try_cast("timestamp")


def mask_recipient(c: Column) -> Column:
    def masked(value: Column) -> Column:
        at = F.instr(value, "@")
        start = F.substring(value, F.lit(1), F.least(at - 1, F.lit(2)))
        return (
            F.when(value == "", "")
            .when(at > 0, F.concat(start, F.lit("***"), F.substring(value, at, F.length(value))))
            .when(F.length(value) <= 4, "****")
            .otherwise(F.concat(F.lit("***"), F.right(value, F.lit(4))))
        )

    return let(strip(text(c)), masked)


def pseudonym(c: Column) -> Column:
    return F.sha2(F.lower(strip(c.cast("string"))), 256)


def event_id(fields: dict[str, Column]) -> Column:
    """Stable id: SHA-256 of the ten identifying fields as JSON in key order, absent ones empty."""
    return F.sha2(F.to_json(F.struct(*[text(fields[k]).alias(k) for k in sorted(fields)])), 256)


def risk_score(score: Column, level: Column) -> Column:
    """Score between 0 and 100; a missing one falls back to the level, fractions become percent."""
    key = F.translate(F.upper(strip(text(level))), K.ACCENTED, K.PLAIN)
    given = let(parse_number(score), lambda value: F.when(value <= 1, value * 100).otherwise(value))
    filled = F.coalesce(given, lookup(key, K.RISK_LEVEL_SCORES, F.lit(0)).cast("double"))
    return F.greatest(F.least(filled, F.lit(100.0)), F.lit(0.0))


def normalize_severity(c: Column) -> Column:
    return let(
        strip(text(c)),
        lambda v: F.when(v == "", K.DEFAULT_SEVERITY).otherwise(lookup(v, K.SEVERITY_VARIANTS, v)),
    )


def normalize_status(c: Column) -> Column:
    value = text(c)
    return lookup(value, K.STATUS_VARIANTS, value)


def priority(severity: Column) -> Column:
    return lookup(severity, K.SEVERITY_PRIORITY, F.lit(99))


def thousands(c: Column) -> Column:
    """Integer with a blank between thousands."""
    return F.translate(F.format_number(c.cast("bigint"), 0), ",", " ")
