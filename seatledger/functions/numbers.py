"""Number rounding and text.

Spark's ``round`` and ``format_string`` look at the shortest decimal text of a
double, so 25.025 rounds up although the stored value lies below the tie.  The
helpers here compare the stored value with the tie exactly.  They do it by
scaling with powers of two, which is exact, and by subtracting numbers that lie
within a factor of two of each other, which is exact as well.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_cents(x: Column) -> Column:
    """Two decimals, nearest to the stored value, exact ties to even."""
    size = F.abs(x)
    low = F.floor(size * 100).cast("double")
    tie = 2 * low + 1
    # sign of 200 * size - tie, as (128 + 64 + 8) * size - tie
    lead = (size * 128 - tie) + size * 64
    rest = size * -8
    up = F.when(lead > rest, 1.0).when(lead == rest, low % 2).otherwise(0.0)
    # From 1e13 on the steps above are no longer exact; decimals are (doubles from 2**53 on are whole).
    wide = F.bround(size.cast("decimal(38, 10)"), 2).cast("double")
    near = F.when(size < 1e13, (low + up) / 100).when(size < 2.0**53, wide).otherwise(size)
    return F.when(x < 0, -near).otherwise(near)


def fixed_0(x: Column) -> Column:
    """Text without decimals, ties away from zero."""
    size = F.abs(x)
    low = F.floor(size).cast("double")
    whole = low + F.when(size - low >= 0.5, 1.0).otherwise(0.0)
    return _signed(x, F.format_string("%d", whole.cast("long")))


def fixed_1(x: Column) -> Column:
    """Text with one decimal, nearest to the stored value, ties away from zero."""
    size = F.abs(x)
    low = F.floor(size * 10).cast("double")
    up = F.when(size * 16 - (2 * low + 1) >= size * -4, 1.0).otherwise(0.0)
    tenths = (low + up).cast("long")
    text = F.format_string("%d.%d", F.floor(tenths / 10).cast("long"), (tenths % 10).cast("long"))
    return _signed(x, text)


def zero_padded(prefix: str, number: Column, width: int) -> Column:
    """``order_000042``; longer numbers stay whole."""
    digits = F.when(number < 10**width, F.substring((number + 10**width).cast("string"), 2, width)).otherwise(
        number.cast("string")
    )
    return F.concat(F.lit(prefix), digits)


def _signed(x: Column, text: Column) -> Column:
    signed = F.when(x < 0, F.concat(F.lit("-"), text)).otherwise(text)
    return F.when(F.isnan(x), F.lit("NaN")).otherwise(signed)


def rupees(x: Column) -> Column:
    """``81857.97 -> ₹81,857.97``, ``1234567 -> ₹12,34,567``, null gives ``₹0``.

    Digits are grouped 3-2-2 from the right; at most two decimals, none padded.
    """
    amount = F.coalesce(x, F.lit(0.0)).try_cast("decimal(38,2)")
    text = F.abs(amount).cast("string")
    whole, cents = F.split_part(text, F.lit("."), F.lit(1)), F.split_part(text, F.lit("."), F.lit(2))
    grouped = F.regexp_replace(whole, r"(?<=\d)(?=(\d\d)*\d{3}$)", ",")
    cents = F.regexp_replace(cents, "0+$", "")
    tail = F.when(cents == "", "").otherwise(F.concat(F.lit("."), cents))
    sign = F.when(amount < 0, "-").otherwise("")
    return F.concat(F.lit("₹"), sign, grouped, tail)
