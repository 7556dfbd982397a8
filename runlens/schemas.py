"""Fixed schemas and vocabularies of the run-reliability data model.

Grain of every table is one row per run (``run_id``). File sources do not enforce the declared
non-null columns; :mod:`runlens.operators.checks` does.
"""

from pyspark.sql import types as T

_S, _L, _D, _B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()

# One row per run, as delivered by the upstream platform. ``run_timestamp`` stays ISO-8601 text
# (yyyy-MM-ddTHH:mm:ss): text order is time order and no session time zone can shift it.
RUNS = T.StructType(
    [
        T.StructField("run_id", _S, False),
        T.StructField("pipeline_name", _S, False),
        T.StructField("domain", _S, False),
        T.StructField("run_timestamp", _S, False),
        T.StructField("expected_rows", _L, False),
        T.StructField("actual_rows", _L, False),
        T.StructField("failed_rows", _L, False),
        T.StructField("duration_seconds", _L, False),
        T.StructField("expected_duration_seconds", _L, False),
        T.StructField("freshness_delay_minutes", _L, False),
        T.StructField("schema_drift", _S, False),
        T.StructField("status", _S, False),
        T.StructField("error_message", _S, True),
    ]
)

# The only columns a labeller may see.
EXTRACT = T.StructType(
    [
        T.StructField("run_id", _S),
        T.StructField("domain", _S),
        T.StructField("failure_rate", _D),
        T.StructField("row_count_variance", _D),
        T.StructField("duration_variance", _D),
        T.StructField("freshness_delay_minutes", _L),
        T.StructField("freshness_severity", _S),
        T.StructField("schema_drift", _S),
        T.StructField("status", _S),
        T.StructField("error_present", _B),
    ]
)

# What a labeller returns.
DECISIONS = T.StructType(
    [
        T.StructField("run_id", _S, False),
        T.StructField("decision", _S, False),
        T.StructField("confidence", _D, True),
    ]
)

# Names of the judgment columns in the final table.
DECISION = "label_decision"
CONFIDENCE = "label_confidence"

METRIC_FIELDS = [
    T.StructField("failure_rate", _D),
    T.StructField("row_count_variance", _D),
    T.StructField("duration_variance", _D),
    T.StructField("freshness_severity", _S),
    T.StructField("schema_drift_present", _B),
    T.StructField("error_present", _B),
]
METRIC_COLUMNS = [f.name for f in METRIC_FIELDS]

METRICS = T.StructType(RUNS.fields + METRIC_FIELDS)
FINAL = T.StructType(
    METRICS.fields + [T.StructField(DECISION, _S), T.StructField(CONFIDENCE, _D)]
)

EXTRACT_COLUMNS = EXTRACT.fieldNames()
RECORD_COLUMNS = [
    "run_id", "domain", "failure_rate", "row_count_variance", "duration_variance",
    "freshness_delay_minutes", "freshness_severity", "schema_drift", "schema_drift_present",
    "status", "error_present",
]
DASHBOARD_COLUMNS = [
    "run_id", "pipeline_name", "domain", "run_timestamp", "status", "failure_rate",
    "freshness_delay_minutes", "freshness_severity", DECISION, CONFIDENCE,
]
HEALTH_COLUMNS = [
    "run_id", "pipeline_name", "domain", "run_timestamp", "status", DECISION, CONFIDENCE,
    "failure_rate", "row_count_variance", "duration_variance", "freshness_delay_minutes",
    "freshness_severity", "schema_drift",
]
QUEUE_COLUMNS = [
    "run_id", "pipeline_name", "failure_rate", "row_count_variance", "freshness_severity",
    "schema_drift", "error_message", DECISION, CONFIDENCE,
]

# Freshness bands (inclusive upper bound in minutes), labels in order of severity,
# label sets used by the reports, statuses, drift kinds, metric precision in decimals.
FRESHNESS_BANDS = [(15, "ON_TIME"), (60, "MINOR"), (240, "MAJOR"), (None, "SEVERE")]
LABELS = ["HEALTHY", "WATCH", "INVESTIGATE", "BLOCK"]
LABEL_MEANINGS = {
    "HEALTHY": "the run needs no action",
    "WATCH": "slightly off; keep an eye on the next runs",
    "INVESTIGATE": "clearly off; someone should look into it",
    "BLOCK": "do not let other jobs use the delivered data",
}
ATTENTION = ["WATCH", "INVESTIGATE"]
QUEUE = ["INVESTIGATE", "BLOCK"]
STATUSES = ["healthy", "degraded", "failed"]
DRIFT_KINDS = ["none", "column_added", "type_changed", "column_removed"]
METRIC_DECIMALS = 6
