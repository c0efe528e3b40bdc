"""Month-over-month trends. Tables have one row per unit and month, so windows are short."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from unitgrid.functions.dates import month_id
from unitgrid.functions.numbers import growth_pct, ratio


def _per_unit(unit, order):
    return Window.partitionBy(*unit).orderBy(*order)


def trends_rows(df, value="TNL", unit=("gid_3", "year"), order=("month",)):
    """Trailing mean of up to three existing rows and growth over the previous existing row."""
    w = _per_unit(unit, order)
    return df.withColumns({
        f"{value}_MA3": F.avg(value).over(w.rowsBetween(-2, 0)),
        f"{value}_MOM_GROWTH_PCT": growth_pct(F.col(value), F.lag(value).over(w)),
    })


def ma3_rows(df, value="TNL", unit=("gid_3", "year"), order=("month",), name="ma3"):
    return df.withColumn(name, F.avg(value).over(_per_unit(unit, order).rowsBetween(-2, 0)))


def growth_rows(df, value="TNL", unit=("gid_3", "year"), order=("month",), name="growth_pct"):
    return df.withColumn(name, growth_pct(F.col(value), F.lag(value).over(_per_unit(unit, order))))


def trends_contiguous(df, value="ntl_sum", unit=("gid_3",)):
    """Mean of exactly three consecutive months, growth only over the month just before; NULL otherwise."""
    w = Window.partitionBy(*unit).orderBy("_id")
    one, two = F.lag("_id", 1).over(w), F.lag("_id", 2).over(w)
    prev, prev2 = F.lag(value, 1).over(w), F.lag(value, 2).over(w)
    joined = F.col("_id") - one == 1
    return df.withColumn("_id", month_id()).withColumns({
        "ntl_ma3": F.when(joined & (one - two == 1), (F.col(value) + prev + prev2) / 3.0),
        "ntl_mom_growth_pct": F.when(joined & (prev != 0), 100.0 * (ratio(F.col(value), prev) - 1.0)),
    }).drop("_id")
