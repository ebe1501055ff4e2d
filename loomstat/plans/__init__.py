"""Whole jobs and the catalog of queries."""
