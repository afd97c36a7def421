"""Operators of a training-data pipeline: cleaning, scoring, deduplication, sharding and packing of documents."""
