"""Column helpers: text, dates, exact decimals. All stay inside whole-stage codegen."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, functions as F

from lakestead.fixed_values import NOTE_SEPARATOR, WHITESPACE


# ---- text -----------------------------------------------------------------------------------
def strip(c: Column) -> Column:
    """Trim every kind of whitespace, not only spaces."""
    return F.btrim(c, F.lit(WHITESPACE))


def is_blank(c: Column) -> Column:
    return F.coalesce(strip(c), F.lit("")) == ""


def concat_null_as_empty(*parts: Column) -> Column:
    return F.concat(*[F.coalesce(p, F.lit("")) for p in parts])


def location_key(state: Column, city: Column) -> Column:
    return concat_null_as_empty(state, F.lit("-"), city)


def join_notes(notes: list[Column]) -> Column:
    """Join the notes that are not NULL; NULL when there is none."""
    return F.nullif(F.concat_ws(NOTE_SEPARATOR, *notes), F.lit(""))


def iso_timestamp(c: Column) -> Column:
    """ISO text of a timestamp; the fraction is six digits, or left out when zero."""
    text = F.translate(c.cast("string"), " ", "T")
    return F.when(F.length(text) > 19, F.rpad(text, 26, "0")).otherwise(text)


# ---- dates ----------------------------------------------------------------------------------
def moment(value: dt.datetime | None) -> Column:
    """A timestamp constant that does not depend on any time zone."""
    text = None if value is None else value.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def date_key(d: Column) -> Column:
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_start(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "month")


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later.cast("date"), earlier.cast("date"))


def to_timestamp_or_null(c: Column) -> Column:
    """The cast itself allows blanks around the value."""
    return c.try_cast("timestamp_ntz")


# ---- numbers --------------------------------------------------------------------------------
def money(c: Column, precision: int = 12) -> Column:
    return c.cast(f"decimal({precision},2)")


def clamp(c: Column, low: Column, high: Column) -> Column:
    return F.greatest(low, F.least(high, c))


def zero_as_null(c: Column) -> Column:
    return F.nullif(c, F.lit(0).cast("decimal(10,2)"))


def ratio(numerator: Column, denominator: Column, out: str) -> Column:
    """Exact decimal quotient rounded half up once; NULL for a zero denominator."""
    return F.try_divide(
        numerator.cast("decimal(27,2)"), denominator.cast("decimal(19,2)")
    ).cast(out)


def percent(numerator: Column, denominator: Column, out: str = "decimal(12,2)") -> Column:
    return F.try_divide(
        numerator.cast("decimal(24,2)") * F.lit(100).cast("decimal(3,0)"),
        denominator.cast("decimal(24,2)"),
    ).cast(out)


def total(c: Column) -> Column:
    """Exact sum of amounts up to decimal(18,2). The cents are added up in two whole numbers, which take less room than a
    wide decimal where sums of tasks move, and are safe for 2^33 rows of any amounts."""
    cents = (c.cast("decimal(18,2)") * F.lit(100)).cast("bigint")
    high, low = F.sum(F.shiftright(cents, 30)), F.sum(cents.bitwiseAND(F.lit((1 << 30) - 1).cast("bigint")))
    whole = high.cast("decimal(20,0)") * F.lit(1 << 30).cast("decimal(10,0)") + low.cast("decimal(20,0)")
    return (whole * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(38,2)")


def mean(c: Column, out: str, add: Callable[[Column], Column] = F.sum) -> Column:
    """Mean of an exact column, rounded once (the built-in one rounds at four extra digits)."""
    return F.try_divide(add(c), F.count(c).cast("decimal(19,0)")).cast(out)
