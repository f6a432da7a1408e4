"""Tax and fee arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numbers import round_cents

# Fixed values.
GST_RATE = 0.18
CONVENIENCE_RATE, CONVENIENCE_MIN = 0.025, 20.0
SERVICE_FEE = 15.0
FEE_CURRENCY = "INR"

# Price factor of a seat section; other sections count 1.0.
SECTION_FACTORS = {
    "VIP": 2.0,
    "Premium": 1.5,
    "Gold": 1.3,
    "Recliner": 1.4,
    "Standard": 1.0,
    "Silver": 0.8,
    "Economy": 0.6,
    "Bronze": 0.5,
}


def with_tax_and_fees(df: DataFrame, amount_col: str, prefix: str = "") -> DataFrame:
    """Add the breakdown of ``amount_col`` as ``{prefix}base_amount`` and so on.

    Existing columns of these names are replaced.  The total is built from the
    unrounded convenience fee.  Rounding reads its input several times, so each
    input is a column of its own and is computed once.
    """
    amount, gst, fee, total = (F.col(f"__{c}") for c in ("amount", "gst", "fee", "total"))
    steps = (
        df.withColumn("__amount", F.col(amount_col).cast("double"))
        .withColumns(
            {
                "__gst": amount * GST_RATE,
                "__fee": F.when(amount.isNotNull(), F.greatest(amount * CONVENIENCE_RATE, F.lit(CONVENIENCE_MIN))),
            }
        )
        .withColumn("__gst", round_cents(gst))
        .withColumn("__total", amount + gst + fee + SERVICE_FEE)
    )
    parts = {
        "base_amount": round_cents(amount),
        "gst_amount": gst,
        "gst_rate": F.lit(GST_RATE),
        "convenience_fee": round_cents(fee),
        "service_fee": F.lit(SERVICE_FEE),
        "total_amount": round_cents(total),
        "currency": F.lit(FEE_CURRENCY),
    }
    return steps.withColumns({prefix + name: part for name, part in parts.items()}).drop(
        "__amount", "__gst", "__fee", "__total"
    )


def section_factor(section: str | Column) -> Column:
    pairs = [F.lit(v) for item in SECTION_FACTORS.items() for v in item]
    section = F.col(section) if isinstance(section, str) else section
    found = F.when(section.isNotNull(), F.try_element_at(F.create_map(*pairs), section))
    return F.coalesce(found, F.lit(1.0))


def seat_price(base: str | Column, section: str | Column) -> Column:
    """Whole-number price of a seat: the fraction is cut off."""
    base = F.col(base) if isinstance(base, str) else base
    return (base * section_factor(section)).try_cast("long")
