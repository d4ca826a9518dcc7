"""Reconciliation of a typed table from the job that writes it."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rollcall.operators.dedup import dedup_large
from rollcall.operators.shape import union_with_drift
from rollcall.plans import feeds
from rollcall.plans.spec import Feed


def feed_parts(name: str, raw: Mapping[str, DataFrame]) -> list[tuple[Feed, DataFrame]]:
    """The keyed feeds of a typed table with the raw rows each reads."""
    if name == "sat":
        raise ValueError("sat rows are filled and distinct as a whole; there is no key to reconcile on")
    if name == "act":
        return [(feeds.act, union_with_drift([raw[t] for t in feeds.ACT_TABLES if t in raw]))]
    if name == "direct_certification":
        parts = (feeds.direct_certification_district, feeds.direct_certification_school)
        return [(feed, raw[feed.name]) for feed in parts if feed.name in raw]
    return [(feeds.SINGLE_FEEDS[name], raw[name])]


class Observed:
    """A typed table whose rows are counted: raw ones by a pass of their own, because the
    de-duplication may read them more than once, kept and typed ones on their way."""

    def __init__(self, name: str, raw: Mapping[str, DataFrame]):
        self.name = name
        self.counts: dict[str, list[Observation]] = {"kept": [], "typed": []}
        self.raw = 0
        frames = []
        for feed, rows in feed_parts(name, raw):
            prepared = feed.prepared(rows)
            self.raw += prepared.count()
            kept = self._counted(dedup_large(prepared, feed.key), "kept")
            frames.append(kept.select(*[f.column() for f in feed.fields]))
        self.table = self._counted(union_with_drift(frames), "typed")

    def _counted(self, df: DataFrame, step: str) -> DataFrame:
        seen = Observation()
        self.counts[step].append(seen)
        return df.observe(seen, F.count(F.lit(1)).alias("rows"))

    def rows(self, step: str) -> int:
        """Rows that passed ``step``; to be asked after the table was written."""
        return sum(seen.get["rows"] for seen in self.counts[step])


def write_reconciled(name: str, raw: Mapping[str, DataFrame], write: Callable[[DataFrame], int]) -> DataFrame:
    """Build and write a typed table; the report row that raw rows minus copies were written.

    ``write`` returns the rows it wrote.  No written table is read again: kept and typed rows
    are counted by the tasks of the write.
    """
    observed = Observed(name, raw)
    written = write(observed.table)
    before, kept, typed = observed.raw, *(observed.rows(step) for step in ("kept", "typed"))
    removed = before - kept
    difference = abs(before - removed - written) + abs(typed - written)
    row = ("reconcile", name, "pass" if difference == 0 else "fail", float(written), f"{before} - {removed}", difference)
    schema = "check string, subject string, status string, observed double, expected string, n long"
    return observed.table.sparkSession.createDataFrame([row], schema)
