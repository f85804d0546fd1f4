"""Column expressions that parse dirty text without failing the job (ANSI mode is on)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.specs import MONEY


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_money(c: Column | str) -> Column:
    return _col(c).try_cast(MONEY)


def iso_date(c: Column | str, fmt: str | None = None) -> Column:
    """Text to date, null if it is none."""
    return F.try_to_date(_col(c), fmt) if fmt else _col(c).try_cast("date")


def iso_timestamp(c: Column | str) -> Column:
    return _col(c).try_cast("timestamp_ntz")


def item(c: Column | str, i: int) -> Column:
    """The i-th element (from 0), null beyond the end."""
    return F.get(_col(c), F.lit(i))


def blank_to(c: Column | str, default: str) -> Column:
    c = _col(c)
    return F.when(c == "", default).otherwise(c)


def repair_quotes(c: Column | str) -> Column:
    """Undo doubled quotes, then drop the enclosing pair."""
    return F.regexp_replace(F.regexp_replace(_col(c), '""', '"'), '^"|"$', "")


def split_names(c: Column | str) -> Column:
    """An ordered list kept in one string, split on commas with any spacing around them."""
    return F.split(F.trim(_col(c)), r"\s*,\s*")


def months_before(as_of: date | str, months: int) -> Column:
    return F.add_months(F.lit(str(as_of)).cast("date"), -months)
