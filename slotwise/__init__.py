"""Slot-partitioned search, change tables and event-stream analytics on Spark."""

__version__ = "0.1.0"
