"""Queries: operators wired to input views, with their SQL."""
