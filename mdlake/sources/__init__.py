"""Readers for landed files and the partitioned parquet tables the jobs maintain."""
