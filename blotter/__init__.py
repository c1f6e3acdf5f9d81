"""Incident star-schema mart on Spark."""
