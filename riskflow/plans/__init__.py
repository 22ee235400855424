"""Whole loads and the catalogue of registered queries."""
