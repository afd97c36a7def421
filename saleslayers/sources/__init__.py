"""Readers: CSV files, tables, archives, landing folders."""
