"""Operators on event and fact frames; each works on tables and on streams."""
