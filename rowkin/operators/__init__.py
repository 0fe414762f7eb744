"""Matching, grouping, profiling and viewing operators over DataFrames."""
