"""Transient-alert lakehouse on Spark: landing, bronze and silver tables."""
