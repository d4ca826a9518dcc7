"""Declared feeds, dimensions, facts, their checks, reports and the full load."""
