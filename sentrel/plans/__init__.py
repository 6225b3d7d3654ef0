"""Compositions of the jobs, and the registry of checked queries."""
