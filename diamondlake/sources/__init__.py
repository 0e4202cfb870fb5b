"""Landed documents and tables in, layers out."""
