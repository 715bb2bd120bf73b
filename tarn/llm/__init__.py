"""Operators for preparing training data: formatting, filtering, deduplication, scoring, mixing and sharding."""
