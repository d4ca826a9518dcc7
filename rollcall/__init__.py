"""rollcall: school-accountability analytics as Spark DataFrame and Column operators.

Yearly report files land as raw tables, are cleaned into typed tables, modelled as a
star schema, and checked at every layer.  Everything is a lazy Spark plan unless a
docstring says otherwise.
"""
