from pyspark.sql import functions as F

from runlens.operators import checks
from runlens.operators.measure import decision_extract, with_metrics
from runlens.plans import inputs
from runlens.sources.staging import stage
from samples import SAMPLE, run, runs_frame

DOMAINS = ["auto_claims", "policies"]


def counts(df):
    return {r.rule: r.violations for r in df.collect() if r.violations}


def test_sample_keeps_every_expectation(spark):
    assert counts(checks.expectation_report(runs_frame(spark, SAMPLE), DOMAINS)) == {}


def test_each_expectation_is_counted(spark):
    rows = [
        run(run_id="a"), run(run_id="a"), run(run_id=None, domain="elsewhere"),
        run(run_id="b", failed_rows=1001), run(run_id="c", failed_rows=-1),
        run(run_id="d", duration_seconds=0), run(run_id="e", freshness_delay_minutes=-1),
        run(run_id="f", status="failed", failed_rows=199, error_message="x"),
        run(run_id="g", status="failed", failed_rows=200), run(run_id="h", error_message="x"),
        run(run_id="i", status="odd"), run(run_id="j", schema_drift="renamed"),
        run(run_id="k", status=None), run(run_id="l", expected_rows=None),
    ]
    assert counts(checks.expectation_report(runs_frame(spark, rows), ["d"])) == {
        "duplicate_run_id": 1, "null_run_id": 1, "unknown_domain": 1,
        "failed_rows_out_of_range": 2, "duration_not_positive": 1, "negative_delay": 1,
        "failed_with_low_failure_rate": 1, "failed_without_error": 1, "healthy_with_error": 1,
        "unknown_status": 1, "unknown_drift": 1, "null_status": 1, "null_expected_rows": 1,
    }


def test_quarantine_splits_without_loss(spark):
    rows = [run(run_id="a"), run(run_id="b"), run(run_id="b"), run(run_id=None), run(run_id=None),
            run(run_id="c", status=None, freshness_delay_minutes=-1)]
    valid, rejected = checks.quarantine(runs_frame(spark, rows))
    assert [r.run_id for r in valid.collect()] == ["a"]
    assert sorted((r.run_id or "", r.reasons) for r in rejected.collect()) == [
        ("", ["null_run_id"]), ("", ["null_run_id"]), ("b", ["duplicate_run_id"]),
        ("b", ["duplicate_run_id"]), ("c", ["null_status", "negative_delay"])]


def test_quarantine_holds_when_one_key_has_a_third_of_the_rows(spark):
    rows = [run(run_id="hot")] * 500 + [run(run_id=f"r{i}") for i in range(1000)]
    frame = runs_frame(spark, rows).repartition(7)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        valid, rejected = checks.quarantine(frame)
        assert valid.count() == 1000 and rejected.count() == 500
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_the_join_with_repeated_keys_splits_a_hot_key(spark):
    rows = [run(run_id="hot", pipeline_name="x" * 50 + str(i)) for i in range(3000)]
    rows += [run(run_id=f"r{i % 4000}") for i in range(6000)]
    frame = stage(runs_frame(spark, rows).repartition(8), "hot-runs")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        valid, rejected = checks.quarantine(frame)
        repeated = [r.run_id for r in rejected.collect() if "duplicate_run_id" in r.reasons]
        assert len(repeated) == 3000 + 4000 and repeated.count("hot") == 3000
        assert len(valid.collect()) == 2000
        marked = checks._marked(frame)  # the join both parts come from, before it is written
        assert marked.where("copies IS NOT NULL").count() == 3000 + 4000
        marked.collect()
        assert "skew=true" in marked._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_label_rules_count_contradictions(spark):
    metrics = with_metrics(runs_frame(spark, SAMPLE[:4]))
    final = metrics.select("*", F.lit("HEALTHY").alias("label_decision"), F.lit(1.5).alias("label_confidence"))
    assert counts(checks.label_quality(final)) == {
        "failed_not_blocked": 1, "degraded_without_attention": 2,
        "healthy_label_high_failure_rate": 3, "confidence_out_of_range": 4}
    unlabelled = final.withColumn("label_decision", F.lit(None).cast("string"))
    assert counts(checks.label_quality(unlabelled))["healthy_not_healthy"] == 1


def test_reconcile_reports_rows_and_fields(spark):
    columns = ["status", "rate"]
    schema = "run_id string, status string, rate double"
    left = spark.createDataFrame(
        [("a", "x", 0.1), ("b", "x", 0.1), ("c", None, None), ("d", "x", 0.1), ("d", "x", 0.1),
         ("f", "x", None)], schema)
    right = spark.createDataFrame(
        [("a", "x", 0.1 + 1e-12), ("b", "y", 0.2), ("c", None, None), ("d", "x", 0.1),
         ("e", "x", 0.1), ("f", "x", 0.5)], schema)
    rows = sorted(tuple(r) for r in checks.reconcile(left, right, columns).collect())
    assert rows == [
        ("b", "rate", "0.100000", "0.200000"), ("b", "status", "x", "y"),
        ("d", "rows", "2", "1"), ("e", "rows", "0", "1"), ("f", "rate", None, "0.500000")]


def test_written_metrics_equal_recomputed_ones(spark, sf_dir):
    metrics = inputs.metrics(spark, sf_dir)
    assert checks.recompute_diff(metrics).count() == 0
    extract = decision_extract(metrics)
    assert checks.extract_diff(inputs.runs(spark, sf_dir), extract).count() == 0
