"""Spark operators for daily panels: many measures per entity and day."""

__version__ = "0.1.0"
