"""Readers, writers and keyed tables kept as Parquet folders."""
