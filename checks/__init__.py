"""Registered queries over the sample tables and their reference SQL."""
