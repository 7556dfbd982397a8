"""Typed rows shared by the tests."""

from runlens.schemas import DECISIONS, RUNS

# Fixed golden values: eight recorded runs and, below, the labels recorded for them.
# run_id, pipeline, domain, time, expected, actual, failed, seconds, planned, delay, drift, status, error
SAMPLE = [
    ("auto_claims_dedupe_transform_20260918_0", "auto_claims_dedupe_transform", "auto_claims",
     "2026-09-18T04:45:00", 120000, 119615, 41, 196, 214, 1, "none", "healthy", None),
    ("auto_claims_dedupe_transform_20260918_1", "auto_claims_dedupe_transform", "auto_claims",
     "2026-09-18T16:00:00", 120000, 113469, 3519, 298, 214, 171, "none", "degraded", None),
    ("auto_claims_dedupe_transform_20260919_2", "auto_claims_dedupe_transform", "auto_claims",
     "2026-09-19T04:45:00", 120000, 116789, 2332, 344, 214, 41, "none", "degraded", None),
    ("auto_claims_dedupe_transform_20260919_3", "auto_claims_dedupe_transform", "auto_claims",
     "2026-09-19T16:00:00", 120000, 41055, 86386, 256, 214, 1168, "column_added", "failed",
     "schema validation failed: unexpected column claim_reserve_usd"),
    ("policies_scd2_transform_20260918_0", "policies_scd2_transform", "policies",
     "2026-09-18T04:45:00", 1600000, 1592894, 580, 494, 451, 9, "none", "healthy", None),
    ("policies_scd2_transform_20260918_1", "policies_scd2_transform", "policies",
     "2026-09-18T16:00:00", 1600000, 1593926, 907, 392, 451, 15, "none", "healthy", None),
    ("policies_scd2_transform_20260919_2", "policies_scd2_transform", "policies",
     "2026-09-19T04:45:00", 1600000, 1573005, 29308, 555, 451, 151, "none", "degraded", None),
    ("policies_scd2_transform_20260919_3", "policies_scd2_transform", "policies",
     "2026-09-19T16:00:00", 1600000, 270808, 523326, 691, 451, 651, "column_added", "failed",
     "out of memory during shuffle partition"),
]
LABELLED = ["HEALTHY", "INVESTIGATE", "WATCH", "BLOCK", "HEALTHY", "HEALTHY", "INVESTIGATE", "BLOCK"]


def run(**changes):
    """One well-formed run as a tuple in column order."""
    row = dict(
        run_id="a", pipeline_name="p", domain="d", run_timestamp="2026-01-01T00:00:00",
        expected_rows=1000, actual_rows=1000, failed_rows=0, duration_seconds=90,
        expected_duration_seconds=100, freshness_delay_minutes=10, schema_drift="none",
        status="healthy", error_message=None,
    )
    return tuple((row | changes)[name] for name in RUNS.fieldNames())


def nullable(schema):
    from pyspark.sql import types as T

    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


def runs_frame(spark, rows):
    return spark.createDataFrame(rows, nullable(RUNS))


def decisions_frame(spark, rows):
    return spark.createDataFrame(rows, nullable(DECISIONS))
