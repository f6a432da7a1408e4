"""The KPI row as a report payload, metric table and prompt text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import fixed_0, fixed_1, rupees
from ..functions.times import indian_datetime, instant
from .kpis import MOBILE, PERIOD_LABEL, WEBSITE

# The order decides ties.
CATEGORIES = [("Music", "music_revenue"), ("Cinema", "cinema_revenue"), ("Sports", "sports_revenue")]

# Label of a metric line and its path in the payload.
METRIC_LINES = [
    ("Total Revenue", "metrics.total_revenue"),
    ("Transactions", "metrics.total_transactions"),
    ("Unique Customers", "metrics.unique_customers"),
    ("Success Rate (%)", "metrics.success_rate_pct"),
    ("Avg Transaction", "metrics.avg_transaction_value"),
    ("Top City", "metrics.top_city"),
    ("Anomalies", "metrics.anomalies"),
    ("Avg Proc Time (ms)", "metrics.avg_processing_time_ms"),
]

PROMPT = """Write the weekly business report for the period {period}, generated {generated_at}.

Here is the JSON payload:
{payload}

Return one JSON object with the text fields subject, preheader and html.
"""


def report_payload(kpis: DataFrame, as_of=None) -> DataFrame:
    """KPI rows to ``period, generated_at, metrics{...}, highlights{...}``."""
    name, value = _top_category()
    period = F.when(F.coalesce("period", F.lit("")) == "", PERIOD_LABEL).otherwise(F.col("period"))
    metrics = F.struct(
        rupees(F.col("total_revenue")).alias("total_revenue"),
        _zero("total_transactions").alias("total_transactions"),
        rupees(F.col("avg_transaction_value")).alias("avg_transaction_value"),
        _zero("unique_customers").alias("unique_customers"),
        F.concat(fixed_1(_zero("success_rate_pct")), F.lit("%")).alias("success_rate_pct"),
        F.col("top_city"),
        _zero("anomaly_count").alias("anomalies"),
        _zero("avg_processing_time_ms").alias("avg_processing_time_ms"),
    )
    highlights = F.struct(
        F.concat(name, F.lit(" ("), rupees(value), F.lit(")")).alias("top_category"),
        _top_platform().alias("top_platform"),
    )
    return kpis.select(
        period.alias("period"),
        indian_datetime(instant(as_of)).alias("generated_at"),
        metrics.alias("metrics"),
        highlights.alias("highlights"),
    )


def metric_lines(payload: DataFrame) -> DataFrame:
    """Payload to one row per metric, as text, in report order."""
    lines = [
        F.struct(F.lit(i).alias("line"), F.lit(label).alias("metric"), F.col(path).cast("string").alias("value"))
        for i, (label, path) in enumerate(METRIC_LINES, 1)
    ]
    return payload.select(F.inline(F.array(*lines)))


def payload_json(payload: DataFrame) -> DataFrame:
    """Add ``payload_json``: indented JSON that also shows empty fields."""
    whole = F.struct("period", "generated_at", "metrics", "highlights")
    text = F.to_json(whole, {"pretty": "true", "ignoreNullFields": "false"})
    return payload.withColumn("payload_json", F.regexp_replace(text, r'(?m)^(\s*"[^"]*") : ', "$1: "))


def prompt_text(payload: DataFrame, template: str = PROMPT) -> DataFrame:
    """Add ``prompt``, the template filled from each payload row.  No model is called."""
    filled = F.lit(template)
    ready = payload_json(payload)
    for field, column in (("period", "period"), ("generated_at", "generated_at"), ("payload", "payload_json")):
        filled = F.replace(filled, F.lit("{" + field + "}"), F.col(column))
    return ready.withColumn("prompt", filled)


def checked_outputs(outputs: DataFrame, text_col: str) -> DataFrame:
    """Parse generated texts; ``accepted`` tells whether they are what was asked for.

    That is one JSON object with nothing after it, whose ``subject`` and
    ``html`` are strings and whose ``preheader`` is one or is not there.  A
    field of another type is null in the result.
    """
    # In brackets, a text with anything behind its object is no JSON or has two elements.
    parsed = F.try_parse_json(F.concat(F.lit("["), text_col, F.lit("]")))
    rows = outputs.withColumn("_parsed", F.when(F.try_variant_get(parsed, "$[1]", "variant").isNull(), parsed))

    def present(name: str) -> Column:
        return F.try_variant_get("_parsed", f"$[0].{name}", "variant")

    def is_text(name: str) -> Column:
        return F.coalesce(F.schema_of_variant(present(name)) == "STRING", F.lit(False))

    def text(name: str) -> Column:
        return F.when(is_text(name), F.try_variant_get("_parsed", f"$[0].{name}", "string")).alias(name)

    fits = is_text("subject") & is_text("html") & (present("preheader").isNull() | is_text("preheader"))
    return rows.select(*outputs.columns, text("subject"), text("preheader"), text("html"), fits.alias("accepted"))


def category_ranking(kpis: DataFrame) -> DataFrame:
    """The category sums in long form, best first; equal sums keep the fixed order."""
    rows = [
        F.struct(F.lit(i).alias("ordinal"), F.lit(name).alias("category"), _zero(column).cast("double").alias("revenue"))
        for i, (name, column) in enumerate(CATEGORIES)
    ]
    return kpis.select(F.inline(F.array(*rows))).orderBy(F.desc("revenue"), "ordinal")


def _top_category() -> tuple[Column, Column]:
    """Row-local form of :func:`category_ranking`: the smallest (-value, ordinal)."""
    ranked = [
        F.struct(
            (-_zero(column).cast("double")).alias("rank"),
            F.lit(i).alias("ordinal"),
            F.lit(name).alias("name"),
            _zero(column).cast("double").alias("value"),
        )
        for i, (name, column) in enumerate(CATEGORIES)
    ]
    best = F.array_min(F.array(*ranked))
    return best["name"], best["value"]


def _top_platform() -> Column:
    """Mobile wins a tie; its share is of mobile and website only, NaN over none."""
    mobile, website = _zero("mobile_bookings"), _zero("website_bookings")

    def share(part: Column) -> Column:
        pct = F.coalesce(F.try_divide(part.cast("double"), (mobile + website).cast("double")) * 100, F.lit(float("nan")))
        return F.concat(F.lit(" ("), fixed_0(pct), F.lit("%)"))

    return F.when(mobile >= website, F.concat(F.lit(MOBILE), share(mobile))).otherwise(
        F.concat(F.lit(WEBSITE), share(website))
    )


def _zero(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0))
