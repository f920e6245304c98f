"""Reusable DataFrame operators: keyed reductions, lookups, projections, contracts, windows."""
