"""Spark-native analytics for fleet engine-health reports."""

from fleethealth.schema import Settings  # noqa: F401

__version__ = "0.1.0"
