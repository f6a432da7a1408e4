"""Continuous versions of the jobs."""
