"""Column functions that turn raw report text into typed values.

Raw columns are strings.  Suppressed cells carry a code instead of a number; every
function maps the codes to NULL and then casts with ``try_cast``, so one unexpected
cell never fails a job.  ``unparsed`` tells which cells were lost that way.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The suppression codes of the source reports.
TFS = ("TFS",)
TFS_NA = ("TFS", "N/A")
TFS_NA_STAR = ("TFS", "N/A", "*")


def _as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def suppress(c: Column | str, codes: Iterable[str] = TFS) -> Column:
    """``c`` with suppression codes replaced by NULL."""
    c = _as_column(c)
    return F.when(~c.isin(*codes), c)


def strip_zero_fraction(c: Column | str) -> Column:
    """``'15.0'`` and ``'15.'`` become ``'15'``; other text is unchanged."""
    return F.regexp_replace(_as_column(c), r"\.0*$", "")


def strip_decimal_suffix(c: Column | str) -> Column:
    """Identifier read as a number: ``'601.0'`` becomes ``'601'``."""
    return F.regexp_replace(_as_column(c), r"\.0$", "")


def clean_int(c: Column | str, codes: Iterable[str] = TFS, strip_zeros: bool = False) -> Column:
    """Suppressed count as int; ``strip_zeros`` also accepts ``'15.0'``."""
    value = suppress(c, codes)
    if strip_zeros:
        value = strip_zero_fraction(value)
    return value.try_cast("int")


def clean_double(c: Column | str, codes: Iterable[str] = TFS) -> Column:
    """Suppressed measure as double; pass ``codes=()`` for a plain cast."""
    codes = tuple(codes)
    value = suppress(c, codes) if codes else _as_column(c)
    return value.try_cast("double")


def clean_decimal(
    c: Column | str, precision: int, scale: int, codes: Iterable[str] = TFS
) -> Column:
    """Suppressed rate as decimal, rounded half up; overflow becomes NULL."""
    return suppress(c, codes).try_cast(T.DecimalType(precision, scale))


def unparsed(c: Column | str, cleaned: Column, codes: Iterable[str] = TFS) -> Column:
    """True where ``c`` holds text that is no code and still came out NULL."""
    c = _as_column(c)
    return c.isNotNull() & ~c.isin(*codes) & cleaned.isNull()


def typed_null(data_type: str | T.DataType) -> Column:
    return F.lit(None).cast(data_type)


def merge_columns(*cs: Column | str) -> Column:
    """First non-NULL of several spellings of the same column."""
    return F.coalesce(*[_as_column(c) for c in cs])


def first_present(available: Iterable[str], candidates: Iterable[str], data_type="string") -> Column:
    """Merge those ``candidates`` that exist among ``available``, in candidate order.

    Names are compared without case, as Spark resolves them.  No candidate at all gives
    a typed NULL.
    """
    have = {name.lower() for name in available}
    found = [F.col(f"`{name}`") for name in candidates if name.lower() in have]
    return F.coalesce(*found) if found else typed_null(data_type)


def composite_key(*parts: Column | str, sep: str = "_", fallback: Column | str | None = None) -> Column:
    """Join key parts with ``sep``; NULL parts are skipped.

    With ``fallback`` a row whose first part is NULL takes the fallback value instead.
    """
    columns = [_as_column(p) for p in parts]
    key = F.concat_ws(sep, *columns)
    if fallback is None:
        return key
    return F.when(columns[0].isNull(), _as_column(fallback)).otherwise(key)
