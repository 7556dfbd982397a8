"""The metric columns as SQL functions, for reports that are written as SQL text.

They are temporary functions of the session whose bodies are SQL, so the optimizer sees plain expressions:
no Python worker, no shuffle. Rounding and bands are those of :mod:`runlens.functions.metrics`.
"""

from pyspark.sql import SparkSession

from runlens.schemas import FRESHNESS_BANDS, METRIC_DECIMALS

_UNIT = f"1e{METRIC_DECIMALS}D"
_RATIO = "CASE WHEN {of} IS NULL OR {of} = 0 THEN 0.0D ELSE {part} / {of} END"


def _bands() -> str:
    tests = " ".join(f"WHEN delay <= {limit} THEN '{name}'" for limit, name in FRESHNESS_BANDS if limit is not None)
    last = next(name for limit, name in FRESHNESS_BANDS if limit is None)
    return f"CASE WHEN delay IS NULL THEN NULL {tests} ELSE '{last}' END"


def definitions() -> dict[str, str]:
    """Signature -> body, in the order in which they build on each other."""
    zeros = "0." + "0" * METRIC_DECIMALS
    return {
        "metric_round(x DOUBLE) RETURNS DOUBLE":
            f"CASE WHEN abs(x * {_UNIT} - rint(x * {_UNIT})) < 0.4999D AND abs(rint(x * {_UNIT})) < 1e9D "
            f"THEN rint(x * {_UNIT}) / {_UNIT} ELSE CAST(format_number(x, '{zeros}') AS DOUBLE) END + 0.0D",
        "failure_rate(failed BIGINT, expected BIGINT) RETURNS DOUBLE":
            f"metric_round({_RATIO.format(part='failed', of='expected')})",
        "row_count_variance(actual BIGINT, expected BIGINT) RETURNS DOUBLE":
            f"metric_round({_RATIO.format(part='(actual - expected)', of='expected')})",
        "duration_variance(duration BIGINT, planned BIGINT) RETURNS DOUBLE":
            f"metric_round({_RATIO.format(part='(duration - planned)', of='planned')})",
        "freshness_severity(delay BIGINT) RETURNS STRING": _bands(),
        "schema_drift_present(drift STRING) RETURNS BOOLEAN": "coalesce(drift, '') NOT IN ('', 'none')",
        "error_present(message STRING) RETURNS BOOLEAN": "coalesce(message, '') <> ''",
    }


def register(spark: SparkSession) -> None:
    """Make the functions known to SQL text of this session."""
    for signature, body in definitions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")


#: All metric columns of a run table, for a SELECT list.
METRICS_SQL = (
    "failure_rate(failed_rows, expected_rows) AS failure_rate, "
    "row_count_variance(actual_rows, expected_rows) AS row_count_variance, "
    "duration_variance(duration_seconds, expected_duration_seconds) AS duration_variance, "
    "freshness_severity(freshness_delay_minutes) AS freshness_severity, "
    "schema_drift_present(schema_drift) AS schema_drift_present, "
    "error_present(error_message) AS error_present")
