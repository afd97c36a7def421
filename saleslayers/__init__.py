"""Layered sales analytics on Spark: raw CSV drops to dimensions, a fact table and reports."""
