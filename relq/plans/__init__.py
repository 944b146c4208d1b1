"""Composite reports, the registered driver queries and their oracle SQL."""
