"""Command line of the batch jobs: ``spark-submit runlens/__main__.py JOB ...`` or
``python -m runlens JOB ...``. Master and memory come from the Spark configuration."""

import argparse

from pyspark.sql import SparkSession

from runlens.operators import alerts, checks, contract, labels, reports
from runlens.plans import jobs
from runlens.sources.readers import load_decisions, read_table
from runlens.sources.staging import released
from runlens.streaming.runs import compact_domain_daily

REPORTS = {
    report.__name__: report
    for report in (
        reports.kpi_summary, reports.kpi_by_label, reports.decision_distribution,
        reports.domain_decision, reports.domain_decision_pivot, reports.status_confusion,
        reports.mean_freshness, reports.health_table, reports.health_runs, reports.freshness_trend,
        reports.queue_runs, reports.queue_compact, reports.queue_display, reports.health_display,
        reports.kpi_display, reports.filtered_runs, reports.report_cube, checks.label_quality, checks.recompute_diff, alerts.alert_rows,
    )
}


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="runlens")
    jobs_ = parser.add_subparsers(dest="job", required=True)

    def add(name: str, *arguments: str) -> argparse.ArgumentParser:
        sub = jobs_.add_parser(name)
        for argument in arguments:
            sub.add_argument(argument)
        return sub

    measure = add("measure", "runs", "table", "extract")
    measure.add_argument("--format", default="parquet")
    measure.add_argument("--quarantine", help="folder for rejected runs; default is to fail")
    measure.add_argument("--domains", nargs="+", help="the domains that runs may have; default is any")
    label = add("label", "extract", "decisions", "meta")
    label.add_argument("--version", default="v1")
    label.add_argument("--recorded", help="decisions to answer with, as JSON; default is the policy")
    label.add_argument("--kept", help="folder of answers kept between calls; only new or changed runs are asked")
    label.add_argument("--violations", help="folder for offending keys, should the check fail")
    label.add_argument("--generated-at", required=True)
    final = add("final", "metrics", "decisions", "table", "csv")
    final.add_argument("--format", default="parquet")
    final.add_argument("--json-array", action="store_true")
    final.add_argument("--quarantine", help="folder for violations; default is to fail")
    final.add_argument("--violations", help="folder for offending keys, should the check fail")
    final.add_argument("--buckets", type=int, default=0, help="stage both sides in so many buckets first")
    coverage = add("coverage", "metrics", "decisions", "out")
    coverage.add_argument("--format", default="parquet")
    load = add("load", "source", "table", "progress")
    load.add_argument("--source-format", default="json", choices=["json", "csv", "parquet"])
    load.add_argument("--files-per-trigger", type=int)
    load.add_argument("--quarantine", help="folder for rejected rows; default is to fail")
    load.add_argument("--domains", nargs="+", help="the domains that runs may have; default is any")
    add("health", "table", "totals", "out")
    add("daily", "table", "out", "progress")
    compact = add("compact-daily", "out")
    compact.add_argument("states", nargs="+", help="folders written by daily or compact-daily")
    add("dashboard", "final_csv", "out")
    stream = add("stream", "source", "table", "progress")
    stream.add_argument("--delay", default="7 days", help="how late a row or its copy may arrive")
    stream.add_argument("--source-format", default="json", choices=["json", "csv", "parquet"])
    stream.add_argument("--files-per-trigger", type=int)
    stream.add_argument("--quarantine", help="folder for rejected rows; default is to fail")
    report = add("report", "table")
    report.add_argument("name", choices=REPORTS)
    report.add_argument("out", help="folder for the report's JSON rows")
    report.add_argument("--format", default="parquet")
    report.add_argument("--domains", nargs="+", help="filtered_runs: domains to show")
    report.add_argument("--labels", nargs="+", help="filtered_runs: labels to show")
    report.add_argument("--drift", action="store_true", default=None, help="filtered_runs: drifted runs only")
    return parser


def main(argv: list[str] | None = None) -> None:
    a = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"runlens-{a.job}").getOrCreate()
    if a.job == "measure":
        rows = jobs.measure_job(spark, a.runs, a.table, a.extract, a.format, a.quarantine, a.domains)
    elif a.job == "label":
        rows = jobs.label_job(
            spark, a.extract, a.decisions, a.meta, "recorded" if a.recorded else "policy", a.version,
            a.generated_at,
            labels.recorded_labels(load_decisions(spark, a.recorded)) if a.recorded else labels.policy_labels,
            a.violations, a.kept,
        )
    elif a.job == "final":
        rows = jobs.final_job(
            spark, a.metrics, a.decisions, a.table, a.csv, a.format, a.json_array, a.quarantine, a.violations,
            a.buckets,
        )
    elif a.job == "dashboard":
        rows = jobs.dashboard_job(spark, a.final_csv, a.out)
    elif a.job == "stream":
        late = jobs.stream_job(
            spark, a.source, a.table, a.progress, a.delay, a.source_format,
            files_per_trigger=a.files_per_trigger, quarantine_path=a.quarantine,
        )
        print(f"{a.job}: {late} rows came too late")
        return
    elif a.job == "load":
        jobs.load_job(
            spark, a.source, a.table, a.progress, a.source_format, a.files_per_trigger, a.quarantine, a.domains
        )
        return
    elif a.job == "health":
        rows = jobs.health_job(spark, a.table, a.totals, a.out)
    elif a.job == "daily":
        jobs.daily_job(spark, a.table, a.out, a.progress)
        return
    elif a.job == "compact-daily":
        compact_domain_daily(spark, a.out, *a.states)
        return
    elif a.job == "coverage":
        found = contract.coverage_report(read_table(spark, a.metrics, a.format), load_decisions(spark, a.decisions))
        found.write.mode("overwrite").json(a.out)
        return
    else:
        chosen = (a.domains, a.labels, a.drift) if a.name == "filtered_runs" else ()
        with released(spark):
            report = REPORTS[a.name](read_table(spark, a.table, a.format), *chosen)
            report.write.mode("overwrite").option("ignoreNullFields", False).json(a.out)
        return
    print(f"{a.job}: {rows} rows")


if __name__ == "__main__":
    main()
