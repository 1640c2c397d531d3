"""Clickstream sessions on Spark: shaping, quality, sessions, enrichment, facts and sinks."""
