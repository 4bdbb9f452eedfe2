"""Reusable DataFrame operators: contract, quality rules, silver, merge, ranking."""
