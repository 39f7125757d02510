"""Label clean-up and label predicates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import constants as K
from .scalars import first_match, let, lookup, strip, text

DASHES = "�–—"


def _plain_dashes(c: Column) -> Column:
    return F.translate(c, DASHES, "-" * len(DASHES))


def normalize_label_v1(c: Column) -> Column:
    """Profiling variant: every dash gets a blank on both sides."""
    spaced = F.regexp_replace(_plain_dashes(strip(c.cast("string"))), r"\s*-\s*", " - ")
    return let(spaced, lambda v: lookup(v, {"Web Attack - Sql Injection": "Web Attack - SQL Injection"}, v))


def normalize_label(c: Column) -> Column:
    """Default variant: missing labels are named, blanks collapse, web attacks get one spelling."""
    value = F.regexp_replace(_plain_dashes(strip(text(c, K.MISSING_LABEL))), r"\s+", " ")

    def named(v: Column) -> Column:
        # a later pattern outranks an earlier one
        branches = F
        for pattern, label in reversed(K.WEB_LABEL_PATTERNS.items()):
            branches = branches.when(v.rlike(f"(?i){pattern}"), label)
        return branches.otherwise(v)

    return let(value, named)


def canonical_attack(c: Column) -> Column:
    """Scoring variant: known spellings first, then keywords, else the text itself."""
    value = strip(F.regexp_replace(F.translate(_plain_dashes(text(c)), "_", " "), r"\s+", " "))
    known = {name.lower(): name for name in K.CLASSES}

    def named(v: Column) -> Column:
        by_words = let(F.lower(v), lambda low: F.coalesce(lookup(low, known), first_match(low, K.LABEL_KEYWORDS, F.lit(None))))
        return F.coalesce(by_words, v)

    return let(value, named)


def is_attack(c: Column) -> Column:
    return F.upper(c) != "BENIGN"


def is_benign(c: Column) -> Column:
    key = F.translate(F.upper(strip(text(c))), K.ACCENTED, K.PLAIN)
    return key.rlike(f"^({'|'.join(K.BENIGN_KEYS)})$|BENIGN")


def short_name(c: Column, rules: list[tuple[str, str]] = K.SHORT_NAMES) -> Column:
    """Short name of a capture file, the file stem when no rule applies."""
    words = [((part,), name) for part, name in rules]
    return let(F.lower(c), lambda low: first_match(low, words, F.regexp_replace(c, r"\.[^.]*$", "")))


def slug(c: Column) -> Column:
    base = F.regexp_replace(F.regexp_replace(c, r"\.pcap_ISCX\.csv", ""), r"\.csv", "")
    return F.lower(F.translate(base, "- ", "__"))


def severity_of(c: Column) -> Column:
    known = K.CLASS_SEVERITY | {"": K.LOWEST_SEVERITY}
    return lookup(canonical_attack(c), known, F.lit(K.DEFAULT_SEVERITY))


def action_of(c: Column) -> Column:
    return lookup(canonical_attack(c), K.CLASS_ACTION, F.lit(K.DEFAULT_ACTION))
