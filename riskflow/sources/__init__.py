"""Readers for transactions, the company registry and its cache."""
