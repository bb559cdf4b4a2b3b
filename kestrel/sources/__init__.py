"""Readers and writers: delimited text, JSON, Parquet, file-name keyed scans, HTML extracts."""
