"""Date arithmetic. Reporting dates are always arguments, there is no hidden clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_diff(start: Column | str, end: Column | str) -> Column:
    """Calendar days between two dates or timestamps: midnights crossed, not elapsed 24 h blocks."""
    return F.datediff(F.to_date(end), F.to_date(start))


def hours_between(start: Column, end: Column) -> Column:
    """Elapsed hours with microsecond precision. Zone-less timestamps are read in the session zone."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return micros / F.lit(3_600_000_000.0)


def iso_timestamp(text: Column | str) -> Column:
    """ISO-8601 text (``Z`` or numeric offset) to a timestamp, null where it does not parse.

    A text without a date is null: the cast alone would put a bare time of day on today's date.
    """
    c = (F.col(text) if isinstance(text, str) else text).cast("string")
    return F.when(c.rlike(r"^\s*\d{4}"), c.try_cast("timestamp"))


def trailing(col: Column | str, anchor: Column, amount: int, unit: str = "day") -> Column:
    """Predicate for ``[anchor - amount units, anchor]``, both ends included."""
    c = F.col(col) if isinstance(col, str) else col
    start = {
        "day": lambda: F.date_sub(anchor, amount),
        "month": lambda: F.add_months(anchor, -amount),
    }[unit]()
    return c.between(start, anchor)


def business_days(start: Column | str, end: Column | str) -> Column:
    """Weekdays after ``start`` up to and including ``end``; negative when ``end`` comes first.

    Closed form over whole weeks since a Monday, so no calendar has to be joined.
    """

    def weekdays_until(d: Column | str) -> Column:
        n = F.datediff(F.to_date(d), F.lit("1970-01-05").cast("date"))
        return F.floor(n / 7) * 5 + F.least(F.pmod(n, F.lit(7)) + 1, F.lit(5))

    return (weekdays_until(end) - weekdays_until(start)).cast("int")
