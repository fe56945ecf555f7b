"""Nested-record analytics tables on Spark: load, unnest, rank, build, check."""
