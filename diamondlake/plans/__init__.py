"""Chained jobs, registered queries and their SQL counterparts."""
