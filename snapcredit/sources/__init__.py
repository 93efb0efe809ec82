"""Readers, partitioned sinks, the month spine and backfill."""
