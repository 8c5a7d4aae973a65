"""Composed reports and the registered queries."""
