"""Month arithmetic."""

from pyspark.sql import functions as F

from unitgrid.functions.numbers import col

# The widenings tried for a month, in days.
WIDENINGS = (0, 15, 30)


def month_start(year, month):
    return F.make_date(col(year).cast("int"), col(month).cast("int"), F.lit(1))


def month_end(year, month, how="last_day"):
    """Exclusive end of a month: its last day (which drops that day) or the first of the next month."""
    start = month_start(year, month)
    return F.last_day(start) if how == "last_day" else F.add_months(start, 1)


def window_bounds(year, month, widening=0):
    """Start and exclusive end of a month widened by some days on both sides."""
    return (F.date_sub(month_start(year, month), widening),
            F.date_add(F.last_day(month_start(year, month)), widening))


def month_id(year="year", month="month"):
    return col(year).cast("long") * 12 + col(month).cast("long")


def month_sequence(first, last):
    """Array of month starts between two dates, inclusive."""
    return F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month"))
