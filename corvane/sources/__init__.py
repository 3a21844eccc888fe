"""Readers: Parquet tables, JSON catalogs, archives, lock files and source trees."""
