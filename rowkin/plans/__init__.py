"""Whole record-matching flows built from the operators."""
