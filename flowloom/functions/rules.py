"""Classification rules for flows and IDS alerts as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from . import constants as K
from .labels import canonical_attack
from .scalars import col, first_match, first_present, lenient_double, let, lookup, parse_integer


def _number(df: DataFrame, names: list[str]) -> Column:
    """First present field as a finite double; numeric columns are used as they are."""
    known = {c.strip().lower(): c for c in df.columns}
    hits = [known[n.lower()] for n in names if n.lower() in known]
    if len(hits) == 1 and isinstance(df.schema[hits[0]].dataType, T.NumericType):
        value = col(hits[0]).cast("double")
        return F.when(F.abs(value) < float("inf"), value).otherwise(0.0)
    return lenient_double(first_present(df, names))


def rule_class(df: DataFrame) -> Column:
    """Class of a flow from its rates, port, packet count and duration."""
    inputs = F.struct(*[_number(df, fields).alias(name) for name, fields in K.RULE_FIELDS.items()])

    def decide(v: Column) -> Column:
        port_in = lambda ports: v["port"].isin([float(p) for p in ports])
        many = v["fwd"] > K.BRUTE_FORCE_PACKETS
        return (
            F.when((v["packets"] > K.DDOS_PACKETS_PER_S) | (v["bytes"] > K.DDOS_BYTES_PER_S), "DDoS")
            .when(port_in(K.SSH_PORTS) & many, "SSH-Patator")
            .when(port_in(K.FTP_PORTS) & many, "FTP-Patator")
            .when((v["duration"] < K.SCAN_DURATION) & (v["fwd"] > 0) & (v["fwd"] <= K.SCAN_PACKETS), "PortScan")
            .when(port_in(K.WEB_PORTS) & (v["packets"] > K.HULK_PACKETS_PER_S), "DoS Hulk")
            .otherwise("BENIGN")
        )

    return let(inputs, decide)


def resolve_class(df: DataFrame, prediction: Column | None = None) -> DataFrame:
    """Add ``classe`` and ``mode``: given label first, then model, then rules."""
    given = [canonical_attack(col(n)) for n in K.LABEL_FIELDS if n in df.columns]
    none = F.lit(None).cast("string")
    staged = df.withColumns(
        {
            "_label": F.coalesce(*[F.nullif(g, F.lit("")) for g in given], none),
            "_model": F.nullif(canonical_attack(prediction), F.lit("")) if prediction is not None else none,
        }
    )
    mode = F.when(F.col("_label").isNotNull(), "label").when(F.col("_model").isNotNull(), "model").otherwise("rules")
    chosen = F.coalesce("_label", "_model", rule_class(df))
    return staged.withColumns({"classe": chosen, "mode": mode}).drop("_label", "_model")


def in_scaled_range(cols: list[str]) -> Column:
    """True when every feature already lies in the scaled interval."""
    checks = [lenient_double(col(c)).between(K.SCALED_LOW, K.SCALED_HIGH) for c in cols]
    return reduce(lambda a, b: a & b, checks)


def ids_class(signature: Column, category: Column) -> Column:
    def named(v: Column) -> Column:
        unnamed = F.when(v["name"] == "", K.UNNAMED_ALERT).otherwise(v["name"])
        text_of = F.lower(F.concat_ws(" ", v["name"], v["category"]))
        return let(text_of, lambda low: first_match(low, K.IDS_KEYWORDS, unnamed))

    names = F.struct(canonical_attack(signature).alias("name"), canonical_attack(category).alias("category"))
    return let(names, named)


def ids_severity(c: Column) -> Column:
    return lookup(parse_integer(c), K.IDS_LEVELS, F.lit(K.LOWEST_SEVERITY))
