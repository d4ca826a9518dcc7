"""DataFrame operators.  Import the module that is needed:

``shape`` projections, filters, unions, reshaping; ``dedup`` business keys; ``conform``
schema merging and backfill; ``history`` slowly changing attributes; ``star`` keys,
lookups and facts; ``summary`` aggregations and reports; ``quality`` checks.
"""
