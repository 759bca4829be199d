"""Spark-first analytics for rankings built from many noisy count sources."""
