from pyspark.sql import functions as F

from runlens.operators import reports
from runlens.operators.labels import with_policy
from runlens.operators.measure import with_metrics
from samples import LABELLED, SAMPLE, runs_frame

CONFIDENCE = [0.96, 0.95, 0.58, 1.0, None, 0.97, 0.125, 1.0]


def final(spark, rows=SAMPLE):
    labels = spark.createDataFrame(
        [(r[0], d, c) for r, d, c in zip(rows, LABELLED, CONFIDENCE)],
        "run_id string, label_decision string, label_confidence double")
    return with_metrics(runs_frame(spark, rows)).join(labels, "run_id")


def test_kpis(spark):
    assert tuple(reports.kpi_summary(final(spark)).first()) == (8, 0.375, 3, 2)
    assert tuple(reports.kpi_by_label(final(spark)).first()) == (8, 37.5, 3, 2, 3, 1, 2, 2)
    assert {r.card: r.value for r in reports.kpi_display(final(spark)).collect()} == {
        "total": "8", "healthy_pct": "37.5%", "attention": "3", "blocked": "2"}


def test_empty_input(spark):
    empty = final(spark, [])
    assert tuple(reports.kpi_summary(empty).first()) == (0, None, 0, 0)
    assert tuple(reports.kpi_by_label(empty).first()) == (0, 0.0, 0, 0, 0, 0, 0, 0)
    for name in ("health_table", "mean_freshness", "domain_decision_pivot", "queue_runs"):
        assert getattr(reports, name)(empty).count() == 0


def test_health_per_pipeline(spark):
    rows = [tuple(r) for r in reports.health_table(final(spark)).collect()]
    assert rows == [
        ("auto_claims_dedupe_transform", "auto_claims", 4, 25.0, 2, 1, 345.25, 0.19),
        ("policies_scd2_transform", "policies", 4, 50.0, 1, 1, 206.5, 0.09)]
    shown = reports.health_display(final(spark)).first()
    assert (shown.healthy_pct, shown.avg_freshness_delay, shown.avg_failure_rate) == (
        "25.0%", "345.25", "0.19")
    assert [r.avg_freshness_delay for r in reports.mean_freshness(final(spark)).collect()] == [345.25, 206.5]


def test_distributions(spark):
    assert [tuple(r) for r in reports.decision_distribution(final(spark)).collect()] == [
        ("HEALTHY", 3), ("BLOCK", 2), ("INVESTIGATE", 2), ("WATCH", 1)]
    assert [tuple(r) for r in reports.domain_decision_pivot(final(spark)).collect()] == [
        ("auto_claims", 1, 1, 1, 1), ("policies", 2, 0, 1, 1)]
    assert [tuple(r) for r in reports.status_confusion(final(spark)).collect()] == [
        ("degraded", 0, 1, 2, 0), ("failed", 0, 0, 0, 2), ("healthy", 3, 0, 0, 0)]
    assert reports.domain_decision(final(spark)).count() == 7


def test_queue_order_and_text(spark):
    with_null = final(spark).withColumn(
        "label_confidence",
        F.when(F.col("run_id").endswith("20260918_1"), F.col("label_confidence"))
        .when(F.col("label_decision") == "BLOCK", None).otherwise(F.col("label_confidence")))
    full = [(r.run_id, r.label_confidence) for r in reports.queue_runs(with_null).collect()]
    assert full == [
        ("auto_claims_dedupe_transform_20260919_3", None), ("policies_scd2_transform_20260919_3", None),
        ("policies_scd2_transform_20260919_2", 0.125), ("auto_claims_dedupe_transform_20260918_1", 0.95)]
    assert [r.label_confidence for r in reports.queue_compact(with_null).collect()] == [None, None, 0.125, 0.95]
    assert [r.label_confidence for r in reports.queue_display(with_null).collect()] == ["n/a", "n/a", "0.13", "0.95"]


def test_ordered_projections(spark):
    times = [r.run_timestamp for r in reports.health_runs(final(spark)).collect()]
    assert times == sorted(times, reverse=True) and len(reports.health_runs(final(spark)).columns) == 13
    trend = reports.freshness_trend(final(spark))
    assert trend.columns == ["run_timestamp", "freshness_delay_minutes", "label_decision"]
    assert [r.run_timestamp for r in trend.collect()] == sorted(times)


def test_dashboard_extract_types_text_rows(spark):
    f = final(spark)
    text = f.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in f.columns])
    typed, direct = reports.dashboard_extract(text), reports.dashboard_extract(f)
    assert typed.dtypes == direct.dtypes and typed.collect() == direct.collect()
    assert typed.where("label_confidence IS NULL").count() == 1


def test_filters(spark):
    f = final(spark)
    assert reports.filtered_runs(f).count() == 8
    assert reports.filtered_runs(f, domain=["policies"]).count() == 4
    assert reports.filtered_runs(f, decision=["BLOCK", "WATCH"]).count() == 3
    assert reports.filtered_runs(f, ["policies"], ["BLOCK"], True).count() == 1
    assert reports.filtered_runs(f, schema_drift_present=False).count() == 6


def test_report_sql_works_on_a_view_of_the_final_table(spark):
    final(spark).createOrReplaceTempView("analytics")
    row = spark.sql(
        "SELECT COUNT(*), SUM(CASE WHEN label_decision = 'BLOCK' THEN 1 ELSE 0 END) FROM analytics").first()
    assert tuple(row) == (8, 2)


def test_policy_final_equals_joined_final(spark, sf_dir):
    from runlens.operators.contract import join_final
    from runlens.plans import inputs

    joined = join_final(inputs.metrics(spark, sf_dir), inputs.decisions(spark, sf_dir))
    fused = with_policy(inputs.metrics(spark, sf_dir), inputs.undisclosed())
    assert joined.exceptAll(fused).count() == 0 and fused.exceptAll(joined).count() == 0
