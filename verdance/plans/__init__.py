"""Whole programs: products, the daily pipeline, registered queries."""
