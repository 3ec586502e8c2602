"""Keyed event-log analytics on Spark."""
