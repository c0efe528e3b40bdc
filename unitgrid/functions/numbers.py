"""Numeric guards and roundings."""

from pyspark.sql import functions as F

# Integer coding of day images.
INT16_NODATA = -32768
INT16_LIMIT = 32767

_DIGITS = r"(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity)"
_VALUE = rf"^\s*[+-]?({_DIGITS})\s*$"
_NUMBER = rf"^\s*[+-]?({_DIGITS}|(?i:nan))\s*$"
_NUMERIC_TYPES = ("double", "float", "bigint", "int", "smallint", "tinyint")
INF = float("inf")


def col(c):
    return F.col(c) if isinstance(c, str) else c


def null_if_nan(c):
    """NaN becomes NULL; missing is never a number here."""
    c = col(c)
    return F.when(~F.isnan(c), c)


def parse_double(c):
    """Text to double: bad text and NaN give NULL, infinities are kept."""
    return F.when(col(c).rlike(_VALUE), F.trim(col(c)).try_cast("double"))


def is_numeric(df, name):
    kind = dict(df.dtypes)[name]
    return kind in _NUMERIC_TYPES or kind.startswith("decimal")


def as_double(df, name):
    """Column `name` as double: parsed when it is text, NaN blanked when it is a number already."""
    if dict(df.dtypes)[name] in ("double", "float"):
        return null_if_nan(F.col(name).cast("double"))
    return F.col(name).cast("double") if is_numeric(df, name) else parse_double(F.col(name).cast("string"))


def is_bad_number(c):
    """True for a non-null text that is not a number (nor a spelling of NaN)."""
    return col(c).isNotNull() & ~col(c).rlike(_NUMBER)


def is_finite(c):
    """False for NULL, NaN and infinities."""
    c = col(c).cast("double")
    return F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(INF)), F.lit(False))


def round_half(c, digits):
    """Round half away from zero after scaling by a power of ten, the way SQL engines round doubles.

    Spark's `round` reads the shortest decimal form instead, so -67.1078125, whose scaled double lies below the tie, differs.
    """
    c = col(c).cast("double")
    scaled = c * F.lit(10.0 ** digits)
    return F.when(F.abs(scaled) < F.lit(INF), F.round(scaled) / F.lit(10.0 ** digits)).otherwise(c)


def ratio(a, b):
    """a / b, NULL when b is zero or NULL."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def growth_pct(current, previous):
    """Percentage change; +/-Inf on a zero base with a change, NULL on 0/0 or a missing side."""
    return (F.when(previous != 0, ratio(current - previous, previous) * 100.0)
            .when(current > 0, F.lit(INF)).when(current < 0, F.lit(-INF)))


def quantise(c, scale=10000):
    """Round half-even to a scaled int16 value, clipped; NULL becomes the nodata code."""
    q = F.rint(col(c).cast("double") * F.lit(float(scale)))
    low, high = F.lit(float(-INT16_LIMIT)), F.lit(float(INT16_LIMIT))
    return (F.when(q.isNull() | F.isnan(q), F.lit(float(INT16_NODATA)))
            .when(q < low, low).when(q > high, high).otherwise(q).cast("short"))


def overflows(c, scale=10000):
    """True where quantise had to clip."""
    q = F.abs(F.rint(col(c).cast("double") * F.lit(float(scale))))
    return F.coalesce((q > INT16_LIMIT) & ~F.isnan(q), F.lit(False))


def dequantise(c, scale=10000):
    return F.when(col(c) != INT16_NODATA, col(c).cast("double") * F.lit(1.0 / scale))
