"""Whole jobs made of the operators: fact table, KPIs, trends, report."""
