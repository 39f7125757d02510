"""Network-flow and intrusion-alert analytics as plain Spark DataFrame operators."""

__version__ = "0.1.0"
