"""Wall-clock arithmetic on TIMESTAMP_NTZ, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000


def _epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def instant(text: str) -> Column:
    """Literal wall-clock time, e.g. the ``now`` of a report."""
    return F.lit(text).cast("timestamp_ntz")


def seconds(n: float) -> Column:
    return F.expr(f"INTERVAL '{n:.6f}' SECOND") if n < 60 else F.make_dt_interval(secs=F.lit(float(n)))


def floor_div(x: Column, n: int) -> Column:
    """Whole-number quotient rounded down, exact for any BIGINT."""
    n_lit = F.lit(n).cast("bigint")
    return F.call_function("div", x - F.pmod(x, n_lit), n_lit)


def epoch_micros(ts: Column) -> Column:
    return F.call_function("div", ts.cast("timestamp_ntz") - _epoch(), F.expr("INTERVAL '0.000001' SECOND"))


def bucket_of(ts: Column, step: int) -> Column:
    """Number of the left-closed bucket of ``step`` seconds, counted from midnight 1970."""
    return floor_div(epoch_micros(ts), step * MICROS)


def bucket_start(bucket_id: Column, step: int) -> Column:
    return _epoch() + bucket_id * F.expr(f"INTERVAL '{step}' SECOND")


def as_instant(ts: Column) -> Column:
    """Zoned timestamp whose UTC reading is the wall clock, for operators that need one."""
    return F.timestamp_micros(epoch_micros(ts))


def from_instant(at: Column) -> Column:
    return _epoch() + F.unix_micros(at) * F.expr("INTERVAL '0.000001' SECOND")


def day_of_week(ts: Column) -> Column:
    """Monday = 0 … Sunday = 6."""
    return F.weekday(ts)


def is_weekend(ts: Column) -> Column:
    return F.coalesce(day_of_week(ts).isin(5, 6), F.lit(False)).cast("int")


def is_peak_hour(hour: Column) -> Column:
    return F.coalesce(hour.between(9, 17), F.lit(False)).cast("int")


def is_listed_peak_hour(hour: Column) -> Column:
    return F.coalesce(hour.isin(9, 10, 11, 14, 15, 16), F.lit(False)).cast("int")


def calendar_parts(ts: Column, missing: int | None = None) -> dict[str, Column]:
    """Hour … year and Monday-based weekday; ``missing`` replaces nulls when given."""
    parts = {
        "hour": F.hour(ts),
        "minute": F.minute(ts),
        "second": F.second(ts),
        "day": F.dayofmonth(ts),
        "month": F.month(ts),
        "year": F.year(ts),
        "day_of_week": day_of_week(ts),
    }
    if missing is not None:
        parts = {name: F.coalesce(part, F.lit(missing)) for name, part in parts.items()}
    return {name: part.cast("int") for name, part in parts.items()}


def time_of_day(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm:ss")


def parse_timestamp(text: Column, strict: bool = False) -> Column:
    """Text to wall-clock time; unreadable text is null unless ``strict``."""
    return text.cast("timestamp_ntz") if strict else text.try_cast("timestamp_ntz")


def from_date_and_time(date: Column, time: Column, strict: bool = False) -> Column:
    return parse_timestamp(F.when(date.isNotNull() & time.isNotNull(), F.concat_ws(" ", date, time)), strict)


def shift_zone(ts: Column, to: str = "Asia/Kolkata", source: str = "UTC") -> Column:
    return F.convert_timezone(F.lit(source), F.lit(to), ts)


def hours_between(later: Column, earlier: Column) -> Column:
    return (epoch_micros(later) - epoch_micros(earlier)) / F.lit(3600.0 * MICROS)


def whole_days_between(later: Column, earlier: Column) -> Column:
    return floor_div(epoch_micros(later) - epoch_micros(earlier), 86400 * MICROS)
