"""Whole jobs, and the queries that check them."""
