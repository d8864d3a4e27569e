"""Layered order tables on Spark: raw files, typed tables, quality gates, daily summary, run analytics."""
