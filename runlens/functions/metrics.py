"""Measurement layer: the six deterministic metric columns. Knows nothing about labels."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from runlens.functions.numeric import ratio
from runlens.schemas import FRESHNESS_BANDS


def ratios() -> dict[str, tuple[Column, Column]]:
    """Numerator and denominator of the three ratio metrics."""
    expected, planned = F.col("expected_rows"), F.col("expected_duration_seconds")
    return {
        "failure_rate": (F.col("failed_rows"), expected),
        "row_count_variance": (F.col("actual_rows") - expected, expected),
        "duration_variance": (F.col("duration_seconds") - planned, planned),
    }


def failure_rate() -> Column:
    """Failed rows per expected row."""
    return ratio(*ratios()["failure_rate"])


def row_count_variance() -> Column:
    """Delivered rows over or under plan, per planned row."""
    return ratio(*ratios()["row_count_variance"])


def duration_variance() -> Column:
    """Run time over or under plan, per planned second."""
    return ratio(*ratios()["duration_variance"])


def freshness_severity() -> Column:
    """Severity band of the delay. A negative delay is on time; a null delay has no band."""
    delay = F.col("freshness_delay_minutes")
    band = F.when(delay.isNull(), F.lit(None).cast("string"))
    for limit, name in FRESHNESS_BANDS:
        band = band.otherwise(F.lit(name)) if limit is None else band.when(delay <= limit, F.lit(name))
    return band


def schema_drift_present() -> Column:
    """True unless the drift kind is null, empty or exactly ``none``."""
    return ~F.coalesce(F.col("schema_drift"), F.lit("")).isin("", "none")


def error_present() -> Column:
    """True when an error text was recorded; blanks count as text, null and empty do not."""
    return F.coalesce(F.col("error_message"), F.lit("")) != ""


def flag_columns() -> list[Column]:
    """The three metrics that are no ratios."""
    return [
        freshness_severity().alias("freshness_severity"),
        schema_drift_present().alias("schema_drift_present"),
        error_present().alias("error_present"),
    ]
