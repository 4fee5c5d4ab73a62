"""Derived inputs, the registered queries with their SQL oracles, and the daily jobs."""
