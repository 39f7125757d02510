"""Explicit schemas of the raw inputs."""

from pyspark.sql import types as T

from ..functions.constants import FLOW_FEATURES

FLOW_SCHEMA = T.StructType(
    [T.StructField(name, T.DoubleType()) for name in FLOW_FEATURES] + [T.StructField("Label", T.StringType())]
)


def _texts(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Severity is text on purpose: unreadable levels must survive parsing.
_ALERT = _texts("signature", "signature_id", "rev", "category", "severity")
EVE_SCHEMA = T.StructType(
    [
        *_texts(
            "event_type", "timestamp", "flow_id", "src_ip", "src_port", "dest_ip", "dest_port", "proto", "signature"
        ).fields,
        T.StructField("alert", _ALERT),
    ]
)
