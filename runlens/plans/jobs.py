"""The batch jobs end to end. Jobs meet only at written tables.

Every output is written beside its place and checked there; all outputs of a job appear together, or
none does, so a failure at any point leaves the outputs of the last good run as they were. What a job
stages on the way is removed at its end.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from runlens.operators import checks, contract, folds, labels, provenance
from runlens.operators.measure import with_metrics
from runlens.schemas import RUNS
from runlens.sources import readers, writers
from runlens.sources.staging import released, stage, stage_bucketed
from runlens.streaming import runs as streams


def measure_job(
    spark: SparkSession,
    runs_path: str,
    table_path: str,
    extract_path: str,
    fmt: str = "parquet",
    quarantine_path: str | None = None,
    domains: list[str] | None = None,
) -> int:
    """Runs CSV -> metrics table and labeller input. The extract is read back from the table.

    Malformed lines, null required columns, domains outside ``domains`` and repeated run ids fail the
    job. With ``quarantine_path``, runs that break any expectation are written there with their
    reasons instead, and the job goes on with the others.
    """
    with released(spark), writers.Outputs(spark) as outputs:
        runs = readers.load_runs(spark, runs_path, keep_malformed=True)
        if quarantine_path is None:
            runs = stage(runs, "runs")
            checks.check_readable(runs, domains)
            contract.check_source_keys(runs)
        else:
            runs, rejected = checks.quarantine(runs, domains)
            writers.write_table(rejected, outputs.at(quarantine_path), fmt)
        table = outputs.at(table_path)
        writers.write_table(with_metrics(runs.select(*RUNS.fieldNames())), table, fmt)
        return writers.export_extract(readers.read_table(spark, table, fmt), outputs.at(extract_path))


def label_job(
    spark: SparkSession,
    extract_path: str,
    decisions_path: str,
    meta_path: str,
    labeller: str,
    version: str,
    generated_at: str,
    label: Callable[[DataFrame], DataFrame] = labels.policy_labels,
    violations_path: str | None = None,
    kept_path: str | None = None,
) -> int:
    """Labeller input -> decisions and provenance. ``label`` maps the extract to decisions; its answers
    are written, then checked for coverage, vocabulary and confidence against the extract. With ``kept_path``, where
    answers are kept, it is asked only for runs that are new or have changed since."""
    with released(spark), writers.Outputs(spark) as outputs:
        extract = readers.load_extract(spark, extract_path)
        answers = outputs.at(decisions_path)
        decided = label(extract) if kept_path is None else labels.resumed_labels(extract, label, kept_path)[0]
        count = writers.write_decisions(decided, answers)
        written = readers.load_decisions(spark, answers)
        contract.check_contract(extract, written, violations_path)
        labels.check_confidence(written)
        meta = provenance.label_job_meta(extract, labeller, version, generated_at)
        writers.write_meta(meta, outputs.at(meta_path))
        return count


def final_job(
    spark: SparkSession,
    metrics_path: str,
    decisions_path: str,
    table_path: str,
    csv_path: str,
    fmt: str = "parquet",
    json_array: bool = False,
    quarantine_path: str | None = None,
    violations_path: str | None = None,
    buckets: int = 0,
) -> int:
    """Metrics and decisions -> final table and its CSV, derived from the written table. With
    ``buckets``, both sides are first written in that many buckets by run_id, so that what was checked
    is what is joined, and is joined without a shuffle.

    Refuses anything but one allowed label per run, and names the folder of all offending keys. With
    ``quarantine_path``, the violations are written there instead, and the runs that keep the
    contract go on.
    """
    with released(spark), writers.Outputs(spark) as outputs:
        metrics = readers.read_table(spark, metrics_path, fmt)
        decisions = readers.load_decisions(spark, decisions_path, json_array)
        if buckets:
            metrics = stage_bucketed(metrics, "metrics", "run_id", buckets)
            decisions = stage_bucketed(decisions, "decisions", "run_id", buckets)
        if quarantine_path is None:
            final = contract.build_final(metrics, decisions, violations_path)
        else:
            final, violations = contract.quarantine_final(metrics, decisions)
            writers.write_table(violations, outputs.at(quarantine_path), fmt)
        table = outputs.at(table_path)
        writers.write_table(final, table, fmt)
        return writers.export_final_csv(readers.read_table(spark, table, fmt), outputs.at(csv_path))


def dashboard_job(spark: SparkSession, final_csv: str, out_path: str) -> int:
    """Final CSV -> dashboard JSON."""
    with writers.Outputs(spark) as outputs:
        return writers.export_dashboard(readers.load_final_csv(spark, final_csv), outputs.at(out_path))


def load_job(
    spark: SparkSession,
    source: str,
    table_path: str,
    progress_path: str,
    source_fmt: str = "json",
    files_per_trigger: int | None = None,
    quarantine_path: str | None = None,
    domains: list[str] | None = None,
) -> None:
    """Run files that arrived since the last call -> metrics table by domain and run date, one row per
    run, the latest delivery winning: of one batch the file modified last, and a later batch over earlier
    ones. Late and backfilled runs are merged like any other: there is no watermark and nothing is dropped. A
    run that is delivered with another domain or day moves. A batch that is replayed gives the same table.

    A row without key, domain or valid time fails the job. With ``quarantine_path``, rows that break
    any row expectation are written there with their reasons instead.
    """
    options = {"header": "true", "escape": '"'} if source_fmt == "csv" else {}
    arrived = streams.with_arrival(streams.read_run_stream(spark, source, source_fmt, files_per_trigger, **options))
    streams.merge_to_table(arrived, table_path, f"{progress_path}/load", quarantine_path, domains).awaitTermination()


def health_job(spark: SparkSession, table_path: str, totals_path: str, out_path: str) -> int:
    """Loaded metrics table -> daily health, from the totals kept at ``totals_path`` and the merges since the
    last call. Returns the number of rows."""
    with released(spark), writers.Outputs(spark) as outputs:
        return writers.write_table(folds.daily_health(spark, table_path, totals_path), outputs.at(out_path))


def daily_job(spark: SparkSession, table_path: str, out_path: str, progress_path: str) -> None:
    """Rows appended to a metrics table without repeated runs, as :func:`stream_job` writes it, since
    the last call -> daily health. :func:`streams.compact_domain_daily` folds its states."""
    runs = streams.read_run_stream(spark, table_path, "parquet")
    streams.upsert_to_table(streams.domain_daily(runs, "7 days"), out_path, progress_path).awaitTermination()


def stream_job(
    spark: SparkSession,
    source: str,
    table_path: str,
    progress_path: str,
    delay: str,
    source_fmt: str = "json",
    fmt: str = "parquet",
    files_per_trigger: int | None = None,
    quarantine_path: str | None = None,
) -> int:
    """Run files that arrived since the last call -> metrics table, each run once, append only.
    ``progress_path`` holds what was done and must stay with the table. Rows that come later than
    ``delay`` after newer ones are dropped and counted: use :func:`load_job` unless that is wanted.

    A row without key or valid time fails the job. With ``quarantine_path``, rows that break any row
    expectation are appended there with their reasons instead. Returns how many rows came too late.
    """
    options = {"header": "true", "escape": '"'} if source_fmt == "csv" else {}
    arrived = streams.read_run_stream(spark, source, source_fmt, files_per_trigger, **options)
    with streams.LateRows(spark) as late:
        queries = []
        if quarantine_path is not None:
            arrived, rejected = streams.split_stream(arrived)
            progress = f"{progress_path}/rejected"
            queries.append(streams.append_to_table(rejected, quarantine_path, progress, fmt))
        rows = streams.stream_metrics(arrived, delay)
        queries.append(streams.append_to_table(rows, table_path, f"{progress_path}/metrics", fmt))
        return sum([late.count(query) for query in queries])
