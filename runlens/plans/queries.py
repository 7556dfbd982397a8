"""The registered queries: one per operator, each over whole tables. See README for the inventory."""

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.operators import alerts, checks, contract, folds, labels, measure, provenance, reports, rollup, upsert
from runlens.functions import sql
from runlens.plans import inputs, jobs
from runlens.schemas import DASHBOARD_COLUMNS, EXTRACT, LABELS, METRICS, RUNS
from runlens.sources import layout, readers, staging, writers
from runlens.streaming import runs as streams

Query = Callable[[SparkSession, str], DataFrame]

LABELLER, VERSION, GENERATED_AT = "policy", "v1", "2026-01-01T00:00:00Z"
STREAM_DELAY = "7 days"  # a watermark holds from the batch after the one that moved it
KNOWN_DOMAINS = ["africa", "america", "asia", "middle east"]


def _of(source: Query, operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(source(spark, sf_dir))


def _columns(source: Query, *names: str) -> Query:
    return _of(source, lambda df: df.select(*names))


def final_analytics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written measurement and judgment tables, checked and joined. Both are bucketed by run_id, so
    the join moves no row."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    metrics = staging.stage_bucketed(inputs.metrics(spark, sf_dir), "metrics", "run_id", buckets)
    extract = measure.decision_extract(metrics)
    answers = labels.policy_labels(extract, inputs.undisclosed())
    decisions = staging.stage_bucketed(answers, "decisions", "run_id", buckets)
    return contract.build_final(metrics, decisions)


def recorded_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions recorded as JSON, answered again for the extract and checked against it."""
    extract = staging.stage(measure.decision_extract(inputs.metrics(spark, sf_dir)), "extract")
    recorded = decisions_json(spark, sf_dir)
    answers = staging.stage(labels.recorded_labels(recorded)(extract), "answers")
    contract.check_contract(extract, answers)
    labels.check_confidence(answers)
    return answers


def request_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payloads of a scorer that takes text, parsed back into columns."""
    extract = measure.decision_extract(inputs.metrics(spark, sf_dir))
    payloads = labels.request_payload(extract)
    return payloads.select("run_id", F.from_json("payload", EXTRACT).alias("p")).select(
        "run_id", *[f"p.{c}" for c in EXTRACT.fieldNames() if c != "run_id"])


def malformed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run table written as CSV, with a count that is no number in some lines: what the row rules
    reject when it is scanned."""
    runs = inputs.runs(spark, sf_dir)
    count = F.when(inputs.every(127), F.lit("abc")).otherwise(F.col("expected_rows").cast("string"))
    path = staging.new_folder(spark, "malformed-csv")
    writers.write_csv(runs.withColumn("expected_rows", count), path)
    scanned = readers.load_runs(spark, path, keep_malformed=True)
    rejected = checks.split_rows(scanned)[1]
    return rejected.select("run_id", F.array_join("reasons", ",").alias("reasons"))


def rollup_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the roll-up leaves out when some lines name no supplier or an unknown one."""
    lines, *others = [inputs.table(spark, sf_dir, name) for name in inputs.RAW]
    return rollup.unmatched_lines(inputs.broken_lines(lines), *others)


def stream_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run files merged into a table as they arrive: the newest runs first, then all older ones, then
    some of them once more."""
    runs = inputs.staged_runs(spark, sf_dir)
    source, table = staging.new_folder(spark, "run-files"), staging.new_folder(spark, "loaded")
    progress = staging.new_folder(spark, "progress")
    for part in (F.col("run_timestamp") >= "1999", F.col("run_timestamp") < "1999", inputs.every(101)):
        runs.where(part).write.mode("append").json(source)
        jobs.load_job(spark, source, table, progress)
    return layout.read_partitioned(spark, table).select(*METRICS.fieldNames())


def _deliver(spark: SparkSession, runs: DataFrame, source: str, table: str, progress: str) -> None:
    runs.write.mode("append").json(source)
    jobs.load_job(spark, source, table, progress)


def load_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch that holds two deliveries of every run, the first one with greater counts."""
    runs = inputs.staged_runs(spark, sf_dir)
    source, table = staging.new_folder(spark, "run-files"), staging.new_folder(spark, "loaded")
    runs.withColumn("actual_rows", F.col("actual_rows") + 1000).write.json(source)
    _deliver(spark, runs, source, table, staging.new_folder(spark, "progress"))
    return layout.read_partitioned(spark, table).select(*METRICS.fieldNames())


def _corrected_loads(spark: SparkSession, sf_dir: str, follow: Callable[[str], DataFrame]) -> DataFrame:
    """What ``follow`` makes of a loaded table after each of two loads: the newer runs first, some with wrong counts
    and some on a wrong day, then corrections of these and all older runs."""
    runs = inputs.staged_runs(spark, sf_dir)
    source, table = staging.new_folder(spark, "run-files"), staging.new_folder(spark, "loaded")
    progress = staging.new_folder(spark, "progress")
    newer = F.col("run_timestamp") >= "1995"
    wrong = runs.where(newer).withColumns({
        "failed_rows": F.when(inputs.every(7), F.col("failed_rows") + 3).otherwise(F.col("failed_rows")),
        "run_timestamp": F.when(inputs.every(11), F.lit("1994-02-03T00:00:00")).otherwise(F.col("run_timestamp"))})
    _deliver(spark, wrong, source, table, progress)
    follow(table)
    _deliver(spark, runs.where(~newer | inputs.every(7) | inputs.every(11)), source, table, progress)
    return follow(table)


def daily_after_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily health kept up to date from the changes of a merged table."""
    totals = staging.new_folder(spark, "daily-totals")
    return _corrected_loads(spark, sf_dir, lambda table: folds.daily_health(spark, table, totals))


def maintained_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint of a merged table, kept up to date from its changes."""
    totals = staging.new_folder(spark, "digest-totals")
    return _corrected_loads(
        spark, sf_dir, lambda table: folds.maintained_fingerprint(spark, table, totals, EXTRACT.fieldNames()))


def alerts_after_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts kept up to date while labelled runs are merged: the newer ones first, some with a wrong label and some on
    a wrong day, then corrections of these and all older runs."""
    final = staging.stage(inputs.final(spark, sf_dir), "final")
    table, kept = staging.new_folder(spark, "loaded"), staging.new_folder(spark, "kept-alerts")
    newer, relabelled, moved = F.col("run_timestamp") >= "1995", inputs.every(7), inputs.every(11)
    first = final.where(newer).withColumns({
        "label_decision": F.when(relabelled, F.lit("BLOCK")).otherwise(F.col("label_decision")),
        "run_timestamp": F.when(moved, F.lit("1994-02-03T00:00:00")).otherwise(F.col("run_timestamp"))})
    layout.load_partitioned(spark, table, first)
    alerts.kept_alerts(spark, table, kept)
    layout.load_partitioned(spark, table, final.where(~newer | relabelled | moved))
    return alerts.kept_alerts(spark, table, kept)


def rollup_after_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs built as order lines arrive: of the newer months some lines, then the older months, then the lines of the
    newer months that came late, and these once more."""
    lines, *others = [inputs.table(spark, sf_dir, name) for name in inputs.RAW]
    facts, table = staging.new_folder(spark, "line-facts"), staging.new_folder(spark, "rolled")
    newer = F.coalesce(F.col("l_shipdate") >= "1995-01-01", F.lit(False))
    early = F.coalesce(F.col("l_linenumber") < 5, F.lit(False))
    late = newer & ~early
    for batch, part in [("newer", newer & early), ("older", ~newer), ("late", late), ("late", late)]:
        rollup.merge_lines(lines.where(part), batch, facts, table, *others, inputs.MADE_UP)
    return layout.read_partitioned(spark, table).select(*RUNS.fieldNames())


def sql_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metric columns by SQL text alone."""
    sql.register(spark)
    inputs.runs(spark, sf_dir).createOrReplaceTempView("runlens_sql_runs")
    return spark.sql(f"SELECT *, {sql.METRICS_SQL} FROM runlens_sql_runs")


def resumed_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of runs of which some were answered before, and some with other facts."""
    extract = measure.decision_extract(inputs.metrics(spark, sf_dir))
    earlier = extract.where(F.col("freshness_delay_minutes") < 200).withColumn(
        "status", F.when(F.col("freshness_delay_minutes") % 7 == 0, F.lit("failed")).otherwise(F.col("status")))
    kept = staging.new_folder(spark, "kept-answers")

    def label(asked: DataFrame) -> DataFrame:
        return labels.policy_labels(asked, inputs.undisclosed())

    labels.resumed_labels(earlier, label, kept)
    return labels.resumed_labels(extract, label, kept)[0]


def _broken_contract(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Runs, and decisions for them that break the contract in every way."""
    runs = inputs.staged_runs(spark, sf_dir)
    return runs, inputs.broken_decisions(runs, inputs.table(spark, sf_dir, "region"))


def clean_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final rows of the runs whose decisions keep the contract; the others are set aside."""
    runs, decisions = _broken_contract(spark, sf_dir)
    return contract.quarantine_final(measure.with_metrics(runs), decisions)[0]


def coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.coverage_report(*_broken_contract(spark, sf_dir))


def coverage_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.coverage_violations(*_broken_contract(spark, sf_dir))


def scored_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The native policy again, as a user's batch scorer would write it."""

    def score(batch: pd.DataFrame) -> pd.DataFrame:
        freshness = batch.freshness_severity.map({"ON_TIME": 0, "MINOR": 1, "MAJOR": 2}).fillna(3)
        status = batch.status.map({"healthy": 0, "degraded": 1}).fillna(3)
        failures = np.searchsorted([0.01, 0.03, 0.2], batch.failure_rate, side="right")
        drift = np.where(batch.schema_drift == "none", 0, 2)
        level = np.maximum(freshness, status).astype(int)
        agreeing = sum((np.asarray(signal) == level).astype(int)
                       for signal in (freshness, status, failures, drift))
        confidence = pd.Series(agreeing / 4, index=batch.index)
        return pd.DataFrame(
            {
                "run_id": batch.run_id,
                "decision": [LABELS[i] for i in level],
                "confidence": confidence.mask(batch.freshness_delay_minutes % 140 == 100),
            }
        )

    return labels.scored_labels(measure.decision_extract(inputs.metrics(spark, sf_dir)), score)


def broken_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.broken_runs(inputs.runs(spark, sf_dir))


def staged_broken_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage(broken_runs(spark, sf_dir), "broken-runs")


def expectation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted against a domain list without europe, so that the domain rule has findings."""
    return checks.expectation_report(staged_broken_runs(spark, sf_dir), KNOWN_DOMAINS)


def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected runs with their reasons as text."""
    rejected = checks.quarantine(staged_broken_runs(spark, sf_dir))[1]
    return rejected.withColumn("reasons", F.array_join("reasons", ","))


def valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.quarantine(staged_broken_runs(spark, sf_dir))[0]


def recompute_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored metrics, some of them changed, against metrics computed from the same rows."""
    return checks.recompute_diff(inputs.drifted(inputs.final(spark, sf_dir)))


def reconcile_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dashboard extract against a copy with changed rates and removed rows."""
    final = inputs.labelled(inputs.staged_runs(spark, sf_dir))
    copy = inputs.drifted(final).where(~inputs.every(89)).select(*DASHBOARD_COLUMNS)
    compared = [c for c in DASHBOARD_COLUMNS if c != "run_id"]
    return checks.reconcile(final.select(*DASHBOARD_COLUMNS), copy, compared)


def reconcile_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same comparison by digests of key ranges, of written tables."""
    final = inputs.labelled(inputs.staged_runs(spark, sf_dir))
    stored = staging.stage(final.select(*DASHBOARD_COLUMNS), "dashboard")
    copy = staging.stage(inputs.drifted(final).where(~inputs.every(89)).select(*DASHBOARD_COLUMNS), "copy")
    return checks.reconcile_ranges(stored, copy, [c for c in DASHBOARD_COLUMNS if c != "run_id"])


def extract_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A drifted extract against the extract recomputed from the runs."""
    runs = inputs.staged_runs(spark, sf_dir)
    drifted = inputs.drifted(measure.with_metrics(runs))
    return checks.extract_diff(runs, measure.decision_extract(drifted))


def filtered_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.filtered_runs(
        inputs.final(spark, sf_dir), ["asia", "europe"], ["WATCH", "INVESTIGATE"], True
    )


def label_job_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    extract = measure.decision_extract(inputs.metrics(spark, sf_dir))
    return provenance.label_job_meta(extract, LABELLER, VERSION, GENERATED_AT)


def latest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run table with a correction batch merged in."""
    runs = inputs.staged_runs(spark, sf_dir)
    return upsert.merge_runs(runs, inputs.incoming_runs(runs, inputs.table(spark, sf_dir, "region")))


def pruned_domain_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One domain and one year out of a metrics table laid out by domain and run date."""
    path = staging.new_folder(spark, "by-domain")
    layout.write_partitioned(inputs.metrics(spark, sf_dir), path)
    rows = layout.read_partitioned(spark, path, "asia", "1997-01-01", "1998-01-01")
    return rows.select("run_id", "domain", F.col("run_date").cast("string").alias("run_date"),
                       "expected_rows", "failure_rate")


def partition_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A correction batch merged into the partitioned run table."""
    path = staging.new_folder(spark, "by-domain")
    runs = inputs.staged_runs(spark, sf_dir)
    layout.write_partitioned(runs, path)
    batch = inputs.incoming_runs(runs, inputs.table(spark, sf_dir, "region"))
    layout.upsert_partitioned(spark, path, batch)
    return layout.read_partitioned(spark, path).select(*runs.columns)


def _run_files(spark: SparkSession, sf_dir: str) -> str:
    path = staging.new_folder(spark, "run-files")
    inputs.runs(spark, sf_dir).write.json(path)
    return path


def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run files loaded incrementally into a metrics table."""
    stream = streams.read_run_stream(spark, _run_files(spark, sf_dir))
    out = staging.new_folder(spark, "stream-metrics")
    rows = streams.stream_metrics(stream, STREAM_DELAY)
    streams.append_to_table(rows, out, staging.new_folder(spark, "progress")).awaitTermination()
    return spark.read.schema(rows.schema).parquet(out)


def stream_domain_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily health per domain, kept up to date from the table of streamed runs, which holds each once."""
    once = streams.stream_metrics(streams.read_run_stream(spark, _run_files(spark, sf_dir)), STREAM_DELAY)
    runs = staging.new_folder(spark, "stream-runs")
    streams.append_to_table(once, runs, staging.new_folder(spark, "progress")).awaitTermination()
    stream = streams.read_run_stream(spark, runs, "parquet")
    out = staging.new_folder(spark, "stream-daily")
    rows = streams.domain_daily(stream, STREAM_DELAY)
    streams.upsert_to_table(rows, out, staging.new_folder(spark, "progress")).awaitTermination()
    return streams.read_domain_daily(spark, out)


def runs_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs written as CSV and scanned under the fixed schema."""
    path = staging.new_folder(spark, "runs-csv")
    writers.write_csv(inputs.runs(spark, sf_dir), path)
    return readers.load_runs(spark, path)


def decisions_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions written as JSON and scanned under the fixed schema."""
    path = staging.new_folder(spark, "decisions")
    writers.write_decisions(inputs.decisions(spark, sf_dir), path)
    return readers.load_decisions(spark, path)


def extract_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labeller's input exported as JSON and scanned back."""
    path = staging.new_folder(spark, "extract")
    writers.export_extract(inputs.metrics(spark, sf_dir), path)
    return readers.load_extract(spark, path)


def metrics_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics table written by path and scanned back."""
    path = staging.new_folder(spark, "metrics-table")
    writers.write_table(inputs.metrics(spark, sf_dir), path)
    return readers.read_table(spark, path)


def catalog_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics table written to the catalog, bucketed by run_id, and scanned by name. Each call has
    a database of its own, and as many buckets as the session has shuffle partitions."""
    current, folder = spark.catalog.currentDatabase(), staging.new_folder(spark, "database")
    database = "runlens_" + folder.rpartition("-")[2]
    readers.use_namespace(spark, database, folder)
    try:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        writers.save_table(inputs.metrics(spark, sf_dir), "run_metrics", buckets=buckets)
        return spark.table(f"{database}.run_metrics")
    finally:
        spark.catalog.setCurrentDatabase(current)


def dashboard_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dashboard extract taken from the portable CSV of the final table."""
    path = staging.new_folder(spark, "final-csv")
    writers.export_final_csv(inputs.final(spark, sf_dir), path)
    return reports.dashboard_extract(readers.load_final_csv(spark, path))


QUERIES: dict[str, Query] = {
    # roll-up and measurement
    "run_rollup": inputs.runs,
    "failure_rate": _columns(inputs.metrics, "run_id", "failure_rate"),
    "row_count_variance": _columns(inputs.metrics, "run_id", "row_count_variance"),
    "duration_variance": _columns(inputs.metrics, "run_id", "duration_variance"),
    "freshness_severity": _columns(inputs.metrics, "run_id", "freshness_severity"),
    "schema_drift_present": _columns(inputs.metrics, "run_id", "schema_drift_present"),
    "error_present": _columns(inputs.metrics, "run_id", "error_present"),
    "metrics_full": inputs.metrics,
    "sql_metrics": sql_metrics,
    "metric_record": _of(inputs.metrics, measure.metric_record),
    "decision_extract": _of(inputs.metrics, measure.decision_extract),
    "run_ordinal": _of(inputs.runs, alerts.run_ordinal),
    # judgment
    "policy_labels": inputs.decisions,
    "scored_labels": scored_labels,
    "input_fingerprint": _of(
        _of(inputs.metrics, measure.decision_extract), provenance.input_fingerprint
    ),
    "label_job_meta": label_job_meta,
    "recorded_labels": recorded_labels,
    "resumed_labels": resumed_labels,
    "request_payload": request_payload,
    # contract and join
    "final_analytics": final_analytics,
    "clean_final": clean_final,
    "coverage_report": coverage_report,
    "coverage_violations": coverage_violations,
    "duplicate_runs": _of(broken_runs, contract.duplicate_runs),
    # reports
    "kpi_summary": _of(inputs.final, reports.kpi_summary),
    "kpi_by_label": _of(inputs.final, reports.kpi_by_label),
    "kpi_display": _of(inputs.final, reports.kpi_display),
    "decision_distribution": _of(inputs.final, reports.decision_distribution),
    "domain_decision": _of(inputs.final, reports.domain_decision),
    "domain_decision_pivot": _of(inputs.final, reports.domain_decision_pivot),
    "status_confusion": _of(inputs.final, reports.status_confusion),
    "mean_freshness": _of(inputs.final, reports.mean_freshness),
    "health_table": _of(inputs.final, reports.health_table),
    "health_display": _of(inputs.final, reports.health_display),
    "health_runs": _of(inputs.final, reports.health_runs),
    "freshness_trend": _of(inputs.final, reports.freshness_trend),
    "queue_runs": _of(inputs.final, reports.queue_runs),
    "queue_compact": _of(inputs.final, reports.queue_compact),
    "queue_display": _of(inputs.final, reports.queue_display),
    "filtered_runs": filtered_runs,
    "report_cube": _of(inputs.final, reports.report_cube),
    "runs_preview": _of(inputs.runs, reports.runs_preview),
    "source_profile": _of(broken_runs, reports.source_profile),
    "domain_profile": _of(inputs.runs, reports.domain_profile),
    "dashboard_extract": _of(inputs.final, reports.dashboard_extract),
    "dashboard_from_csv": dashboard_from_csv,
    "final_export": _of(inputs.final, writers.final_export),
    "alert_rows": _of(inputs.final, alerts.alert_rows),
    # checks
    "expectation_report": expectation_report,
    "label_quality": _of(inputs.final, checks.label_quality),
    "quarantine_rows": quarantine_rows,
    "valid_rows": valid_rows,
    "malformed_rows": malformed_rows,
    "rollup_unmatched": rollup_unmatched,
    "recompute_diff": recompute_diff,
    "extract_diff": extract_diff,
    "reconcile_diff": reconcile_diff,
    "reconcile_ranges": reconcile_ranges,
    # sources, sinks, layout
    "runs_csv": runs_csv,
    "decisions_json": decisions_json,
    "extract_json": extract_json,
    "metrics_table": metrics_table,
    "catalog_table": catalog_table,
    "latest_runs": latest_runs,
    "pruned_domain_scan": pruned_domain_scan,
    "partition_upsert": partition_upsert,
    # streams
    "stream_metrics": stream_metrics,
    "stream_merge": stream_merge,
    "load_latest": load_latest,
    "daily_after_load": daily_after_load,
    "alerts_after_load": alerts_after_load,
    "rollup_after_lines": rollup_after_lines,
    "maintained_fingerprint": maintained_fingerprint,
    "stream_domain_daily": stream_domain_daily,
}
