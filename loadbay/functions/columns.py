"""Scalar column expressions: coercion, rounding, calendar parts, durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadbay import schemas as S


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_double(c: str | Column) -> Column:
    """Text to double; anything unparseable, and a parsed NaN, becomes NULL."""
    return F.nanvl(col(c).try_cast("double"), F.lit(None).cast("double"))


def parse_int(c: str | Column) -> Column:
    """Text to bigint, truncating toward zero; missing or bad text becomes 0."""
    return F.coalesce(parse_double(c).try_cast("bigint"), F.lit(0).cast("bigint"))


def parse_timestamp(c: str | Column, fmt: str | None = None) -> Column:
    """Text to zone-less timestamp, NULL where it does not parse."""
    if fmt is None:
        return col(c).try_cast("timestamp_ntz")
    return F.try_to_timestamp(col(c), F.lit(fmt)).cast("timestamp_ntz")


def round_half_even(c: str | Column, digits: int) -> Column:
    """NumPy-style rounding: scale, round half to even, scale back."""
    scale = float(10 ** digits)
    return F.rint(col(c).cast("double") * scale) / scale


def not_negative(c: str | Column) -> Column:
    """Clip at zero from below, keeping NULL."""
    return F.when(col(c) < 0, F.lit(0.0)).otherwise(col(c))


def seconds_between(start: str | Column, end: str | Column) -> Column:
    return F.timestamp_diff("MICROSECOND", col(start), col(end)) / F.lit(1e6)


def ratio(a: str | Column, b: str | Column) -> Column:
    """a / b, NULL when b is zero."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def total(c: str | Column) -> Column:
    """Sum where the sum of nothing is 0."""
    return F.coalesce(F.sum(col(c)), F.lit(0))


def micros(c: str | Column) -> Column:
    """Seconds as a whole number of microseconds, to be summed without rounding."""
    return F.rint(col(c) * F.lit(1e6)).cast("decimal(18,0)")


def from_micros(c: Column) -> Column:
    return c.cast("double") / F.lit(1e6)


def sum_seconds(c: str | Column) -> Column:
    """Sum of a seconds column, 0 if empty.

    Added up as decimals of whole microseconds (28 digits), so the result does not depend on
    how rows are spread over tasks, whatever the total.
    """
    return F.coalesce(from_micros(F.sum(micros(c))), F.lit(0.0))


def mean_seconds(c: str | Column) -> Column:
    """Mean of a seconds column, NULL if empty; order-independent like the sum."""
    return ratio(F.sum(micros(c)), F.count(col(c))) / F.lit(1e6)


def calendar(ts: str | Column) -> dict[str, Column]:
    """The seven calendar features of a timestamp, in table order."""
    ts = col(ts)
    day = F.to_date(ts)
    weekend = F.weekday(day).isin(5, 6)
    return {
        "date": day,
        "hour": F.hour(ts),
        "day_of_week": F.weekday(day),
        "weekday_name": F.date_format(day, "EEEE"),
        "week_number": F.weekofyear(day),
        "month": F.month(day),
        "is_weekend": F.coalesce(weekend, F.lit(False)).cast("int"),
    }


def process_category(c: str | Column) -> Column:
    """Leading code of a process text: what precedes the first ' - ', stripped."""
    return F.regexp_replace(F.split(col(c), " - ", 2)[0], r"^\s+|\s+$", "")


def is_system_name(c: str | Column) -> Column:
    return col(c).isin(*S.SYSTEM_NAMES) | col(c).rlike(S.SYSTEM_PATTERN)


def all_present(*names: str) -> Column:
    """True where none of the named columns is NULL."""
    cond = F.lit(True)
    for name in names:
        cond = cond & F.col(name).isNotNull()
    return cond
