"""Declared feeds: how one raw table becomes one typed table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame

from rollcall.functions.cleanse import TFS, clean_decimal, clean_double, clean_int
from rollcall.operators.dedup import LINEAGE, dedup_large
from rollcall.operators.shape import col_of, has_column, with_missing


@dataclass(frozen=True)
class Field:
    """One output column: raw column(s) and the function that builds the value."""

    name: str
    raw: tuple[str, ...]
    build: Callable[..., Column]

    def column(self) -> Column:
        return self.build(*[col_of(r) for r in self.raw]).alias(self.name)


def text(name: str, raw: str) -> Field:
    return Field(name, (raw,), lambda c: c)


def count(name: str, raw: str, codes: Sequence[str] = TFS, strip_zeros: bool = False) -> Field:
    return Field(name, (raw,), lambda c: clean_int(c, codes, strip_zeros))


def measure(name: str, raw: str, codes: Sequence[str] = TFS) -> Field:
    return Field(name, (raw,), lambda c: clean_double(c, codes))


def rate(name: str, raw: str, scale: int, codes: Sequence[str] = TFS) -> Field:
    """Percentage as ``decimal(5, scale)``."""
    return Field(name, (raw,), lambda c: clean_decimal(c, 5, scale, codes))


def derived(name: str, build: Callable[..., Column], *raw: str) -> Field:
    return Field(name, raw, build)


class MissingKeyColumn(ValueError):
    """A raw table lacks a column of its business key."""


LINEAGE_FIELDS = (text("source_year", "source_year"), text("source_file", "source_file"))


@dataclass(frozen=True)
class Feed:
    """Raw key, output fields and the key the result must be unique on.

    Every key column has to be in the raw table, because rows that differ in one it lacks
    would count as copies.  Of each group in ``spellings`` one column suffices.
    """

    name: str
    key: tuple[str, ...]
    fields: tuple[Field, ...]
    silver_key: tuple[str, ...]
    prepare: Callable[[DataFrame], DataFrame] | None = field(default=None)
    spellings: tuple[tuple[str, ...], ...] = ()

    def require_key(self, raw: DataFrame) -> None:
        respelled = {c for group in self.spellings for c in group}
        groups = [*((c,) for c in self.key if c not in respelled), *self.spellings]
        absent = [group for group in groups if not any(has_column(raw, c) for c in group)]
        if absent:
            raise MissingKeyColumn(f"{self.name}: no column {', '.join(' or '.join(group) for group in absent)}")

    def raw_columns(self) -> list[str]:
        names = dict.fromkeys(self.key)
        for f in self.fields:
            names.update(dict.fromkeys(f.raw))
        return list(names)

    def prepared(self, raw: DataFrame) -> DataFrame:
        """The raw rows that count, reduced to the columns the feed reads.

        The lineage columns stay even where the output lacks them: they decide which
        copy of a row is the newest.
        """
        self.require_key(raw)
        needed = dict.fromkeys([*self.raw_columns(), *LINEAGE])
        raw = with_missing(raw, needed)
        if self.prepare is not None:
            raw = self.prepare(raw)
        return raw.select(*[col_of(c) for c in needed])

    def build(self, raw: DataFrame) -> DataFrame:
        rows = dedup_large(self.prepared(raw), self.key)
        return rows.select(*[f.column() for f in self.fields])
