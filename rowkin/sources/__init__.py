"""Scans that turn files into raw records, and sinks for results.

Every scan gives ``source_file STRING, file_type STRING, line_number BIGINT, raw MAP<STRING,STRING>``.
"""
