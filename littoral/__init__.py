"""Spark-first analytics engine for site/day monitoring series."""
