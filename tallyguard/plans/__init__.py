"""Whole flows, the job entry points and the catalogue of checked queries."""
