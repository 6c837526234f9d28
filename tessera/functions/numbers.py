"""Number expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def missing(c: Column) -> Column:
    """Null or NaN."""
    return c.isNull() | F.isnan(c)


def round_half_even_2(x: Column) -> Column:
    """x >= 0 rounded to two places by its binary value, half to even, as IEEE libraries do.

    round() decides on the shortest decimal text, which differs only where that text ends in a 5 at the third place. There
    the sign of x - tie is found without error: x is split in two halves whose products with 200 are exact."""
    tie = x.cast("decimal(38,6)").cast("string").rlike(r"\.\d\d5000$")
    c = x * F.lit(134217729.0)
    high = c - (c - x)
    low = x - high
    m = F.round(x * 200.0, 0)
    side = (high * 200.0 - m) + low * 200.0
    k = F.floor(m / 2)
    up = (side > 0) | ((side == 0) & (k % 2 == 1))
    return F.when(tie, (k + up.cast("long")) / 100.0).otherwise(F.round(x, 2))


def json_number(x: Column) -> Column:
    """The JSON text of a double with at most two decimal places: no exponent, at least one place."""
    return F.regexp_replace(x.cast("decimal(38,2)").cast("string"), "0$", "")
