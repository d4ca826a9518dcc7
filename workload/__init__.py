"""Queries over the supplied test tables, each with an independent SQL statement."""
