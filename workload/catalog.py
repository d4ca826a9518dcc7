"""Imports every query module, which registers its queries."""

from workload import feed_queries  # noqa: F401
from workload import operator_queries  # noqa: F401
from workload import check_queries  # noqa: F401
from workload import report_queries  # noqa: F401
from workload import load_queries  # noqa: F401
