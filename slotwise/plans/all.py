"""Importing this module registers every query."""

import importlib

MODULES = ["event_queries", "search_queries", "table_queries", "stream_queries"]

for _name in MODULES:
    importlib.import_module(f"slotwise.plans.{_name}")
