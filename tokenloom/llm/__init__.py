"""Operators of a training-data pipeline: filtering, deduplication, decontamination, scoring, sharding and encoding."""
