"""Jobs that fail leave what was there; jobs that end leave nothing staged; merges keep every run."""

import contextlib
import io
import json
import pathlib

import pandas as pd
import pytest
from pyspark.sql import functions as F

from runlens.operators import checks, labels, reports, upsert
from runlens.operators.contract import ContractError
from runlens.operators.measure import with_metrics
from runlens.operators.rollup import run_rollup, unmatched_lines
from runlens.plans import inputs, jobs
from runlens.schemas import RUNS
from runlens.sources import layout, staging, writers
from samples import run, runs_frame


def folders(spark):
    root = pathlib.Path(staging.shared_folder(spark).removeprefix("file:")) / "runlens"
    return {p.name for p in root.iterdir()} if root.exists() else set()


@pytest.fixture
def place(tmp_path):
    return lambda name: str(tmp_path / name)


def csv_of(spark, place, rows, name="runs.csv"):
    writers.write_csv(runs_frame(spark, rows).coalesce(1), place(name))
    return place(name)


def content(path):
    return sorted((p.name, p.read_bytes()) for p in pathlib.Path(path).iterdir() if not p.name.startswith("."))


def measured(spark, place, rows=None):
    rows = rows or [run(run_id=f"r{i}") for i in range(8)]
    jobs.measure_job(spark, csv_of(spark, place, rows), place("table"), place("extract"))


def beside(tmp_path):
    return [p for p in tmp_path.iterdir() if p.name.startswith(("_new", "_old"))]


def test_jobs_end_without_staged_folders(spark, place, tmp_path):
    before = folders(spark)
    measured(spark, place)
    jobs.label_job(spark, place("extract"), place("decisions"), place("meta"), "policy", "v1", "t")
    jobs.final_job(spark, place("table"), place("decisions"), place("final"), place("csv"))
    jobs.final_job(spark, place("table"), place("decisions"), place("final"), place("csv"), quarantine_path=place("q"))
    jobs.measure_job(spark, place("runs.csv"), place("table"), place("extract"), quarantine_path=place("q2"))
    jobs.final_job(spark, place("table"), place("decisions"), place("final"), place("csv"), buckets=3)
    assert folders(spark) == before and not beside(tmp_path)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("staged_")]
    assert spark.read.parquet(place("final")).count() == 8
    with staging.released(spark):
        staging.stage(spark.range(3), "x")
        assert len(folders(spark)) == len(before) + 1
    assert folders(spark) == before


@pytest.mark.parametrize("answer, message", [
    (lambda out: out.assign(decision="MAYBE"), "label that is not allowed"),
    (lambda out: out.iloc[1:], "not one to one"),
    (lambda out: pd.concat([out, out]), "not one to one"),
    (lambda out: out.assign(confidence=7.5), "confidence"),
    (lambda out: 1 / 0, "division"),
])
def test_a_bad_labeller_leaves_the_last_answers(spark, place, tmp_path, answer, message):
    measured(spark, place)
    good = (spark, place("extract"), place("decisions"), place("meta"), "policy", "v1", "t")
    assert jobs.label_job(*good) == 8
    kept = content(place("decisions")), content(place("meta"))

    def label(extract):
        def change(batches):
            for batch in batches:
                yield answer(batch[["run_id"]].assign(decision="WATCH", confidence=0.5))

        return extract.coalesce(1).mapInPandas(change, labels.ANSWER)

    with pytest.raises(Exception, match=message):
        jobs.label_job(*good, label=label)
    assert (content(place("decisions")), content(place("meta"))) == kept and not beside(tmp_path)


def test_recorded_answers_are_checked_like_any_other(spark, place):
    measured(spark, place)
    recorded = spark.createDataFrame([(f"r{i}", "WATCH", None) for i in range(8)],
                                     "run_id string, decision string, confidence double")
    args = (spark, place("extract"), place("decisions"), place("meta"), "recorded", "v1", "t")
    assert jobs.label_job(*args, label=labels.recorded_labels(recorded)) == 8
    with pytest.raises(ContractError, match="missing=1"):
        jobs.label_job(*args, label=labels.recorded_labels(recorded.where("run_id <> 'r3'")), violations_path=place("v"))
    assert [tuple(r) for r in spark.read.parquet(place("v")).collect()] == [("r3", "missing")]


def test_a_failing_guard_and_a_failing_second_write_leave_both_outputs(spark, place, tmp_path, monkeypatch):
    measured(spark, place)
    jobs.label_job(spark, place("extract"), place("decisions"), place("meta"), "policy", "v1", "t")
    final = (spark, place("table"), place("decisions"), place("final"), place("csv"))
    jobs.final_job(*final)
    kept = content(place("final")), content(place("csv"))
    measured(spark, place, [run(run_id=f"r{i}") for i in range(9)])
    with pytest.raises(ContractError, match="missing=1"):
        jobs.final_job(*final)
    jobs.label_job(spark, place("extract"), place("decisions"), place("meta"), "policy", "v1", "t")

    def fail(*_):
        raise OSError("disk full")

    with monkeypatch.context() as m:
        m.setattr(writers, "export_final_csv", fail)
        with pytest.raises(OSError):
            jobs.final_job(*final)
    assert (content(place("final")), content(place("csv"))) == kept and not beside(tmp_path)
    assert jobs.final_job(*final) == 9 and spark.read.parquet(place("final")).count() == 9


def test_outputs_are_put_back_if_a_rename_fails(spark, place, tmp_path):
    spark.range(3).write.parquet(place("a"))
    with pytest.raises(Exception):
        with writers.Outputs(spark) as outputs:
            spark.range(5).write.parquet(outputs.at(place("a")))
            outputs.at(place("never-written"))
    assert spark.read.parquet(place("a")).count() == 3 and not beside(tmp_path)


@pytest.mark.parametrize("line, message", [
    ("r1,p,d,2026-01-01T00:00:00,abc,1000,900,90,100,10,none,healthy,", "malformed_record=1"),
    (",p,d,2026-01-01T00:00:00,1000,1000,0,90,100,10,none,healthy,", "null_run_id=1"),
    ("r1,p,nowhere,2026-01-01T00:00:00,1000,1000,0,90,100,10,none,healthy,", "unknown_domain=1"),
])
def test_unreadable_runs_fail_before_anything_is_written(spark, place, tmp_path, line, message):
    header = ",".join(runs_frame(spark, [run()]).columns)
    good = "r0,p,d,2026-01-01T00:00:00,1000,1000,0,90,100,10,none,healthy,"
    (tmp_path / "bad.csv").write_text("\n".join([header, good, line]) + "\n")
    with pytest.raises(ContractError, match=message):
        jobs.measure_job(spark, place("bad.csv"), place("table"), place("extract"), domains=["d"])
    assert not (tmp_path / "table").exists() and not (tmp_path / "extract").exists()
    jobs.measure_job(spark, place("bad.csv"), place("table"), place("extract"), quarantine_path=place("q"), domains=["d"])
    assert [r.run_id for r in spark.read.parquet(place("table")).collect()] == ["r0"]
    assert spark.read.parquet(place("q")).count() == 1


def test_late_and_backfilled_runs_are_loaded(spark, place, tmp_path):
    """One March run first, five January runs in a later call, then a copy and a correction."""
    source = place("in")

    def arrive(*rows):
        runs_frame(spark, list(rows)).coalesce(1).write.mode("append").json(source)
        jobs.load_job(spark, source, place("table"), place("progress"))

    before = folders(spark)
    arrive(run(run_id="m", run_timestamp="2026-03-01T00:00:00"))
    january = [run(run_id=f"j{i}", run_timestamp=f"2026-01-0{i + 1}T00:00:00") for i in range(5)]
    arrive(*january)
    arrive(january[0], run(run_id="j1", run_timestamp="2026-01-02T00:00:00", actual_rows=7))
    arrive(*[run(run_id="m", run_timestamp="2026-03-01T00:00:00")] * 300)
    rows = layout.read_partitioned(spark, place("table")).collect()
    assert {r.run_id: r.actual_rows for r in rows} == {"m": 1000, "j1": 7, **{f"j{i}": 1000 for i in (0, 2, 3, 4)}}
    assert len(rows) == 6 and folders(spark) == before
    with pytest.raises(Exception, match="null_run_id=1"):
        arrive(run(run_id=None))
    jobs.load_job(spark, source, place("table"), place("progress"), quarantine_path=place("q"))
    assert [r.reasons for r in spark.read.parquet(place("q")).collect()] == [["null_run_id"]]


def test_a_small_batch_does_not_move_stored_rows(spark, sf_dir):
    runs = staging.stage(inputs.runs(spark, sf_dir), "merge-runs")
    one = runs_frame(spark, [run(run_id="new", domain="asia", run_timestamp="1997-05-01T00:00:00")])
    merged = upsert.merge_runs(runs, one)
    assert merged.count() == runs.count() + 1
    merged.collect()
    plan = merged._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]
    assert "BroadcastHashJoin" in plan and "Sort" not in plan and "hashpartitioning" not in plan


def test_full_rows_are_not_sorted_to_be_grouped(spark, sf_dir):
    final = staging.stage(inputs.final(spark, sf_dir), "plan-final")
    compared = ["status", "failure_rate", "label_decision"]
    runs = final.select(*RUNS.fieldNames())
    for df in (checks.reconcile(final, final, compared), checks.extract_diff(runs, checks.decision_extract(final))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "HashAggregate" in plan
    plan = reports.health_table(final)._jdf.queryExecution().executedPlan().toString()
    grouped = [line for line in plan.splitlines() if "partial_sum(freshness_delay_minutes" in line]
    assert grouped and not any("SortAggregate" in line for line in grouped)  # what follows is grouped already


def test_a_small_difference_shows(spark):
    rows = with_metrics(runs_frame(spark, [run()]))
    other = rows.withColumn("failure_rate", F.col("failure_rate") + 1e-7)
    found = checks.reconcile(rows, other, ["failure_rate"]).collect()
    assert [tuple(r) for r in found] == [("a", "failure_rate", "0.0", "1.0E-7")]


def test_means_of_the_health_table_are_over_all_runs(spark):
    rows = with_metrics(runs_frame(spark, [run(run_id="a", failed_rows=100), run(run_id="b", freshness_delay_minutes=30)]))
    final = rows.withColumn("failure_rate", F.when(F.col("run_id") == "a", F.col("failure_rate"))).withColumns(
        {"label_decision": F.lit("WATCH"), "label_confidence": F.lit(0.5)})
    row = reports.health_table(final).first()
    assert (row.avg_freshness_delay, row.avg_failure_rate) == (20.0, 0.05)
    several = final.withColumn("domain", F.when(F.col("run_id") == "b", F.lit("other")).otherwise(F.col("domain")))
    assert reports.health_table(several).first().domain == "d"


def test_every_line_is_in_a_run_or_accounted_for(spark, sf_dir):
    lines, *others = [inputs.table(spark, sf_dir, name) for name in inputs.RAW]
    half = lines.withColumn("l_suppkey", F.when(F.col("l_linenumber") % 2 == 0, F.col("l_suppkey"))).withColumn(
        "l_quantity", F.col("l_quantity") + 0.5)
    runs = run_rollup(half, *others, inputs.MADE_UP)
    left_out = unmatched_lines(half, *others).collect()
    kept = runs.agg(F.sum(F.col("expected_duration_seconds") / 120).alias("n"), F.sum("expected_rows").alias("q")).first()
    assert kept.n + sum(r.lines for r in left_out) == lines.count()
    assert kept.q + sum(r.quantity for r in left_out) == lines.agg(F.sum(F.col("l_quantity") + 1).cast("long")).first()[0]


def test_command_line_filters_and_coverage(spark, place, tmp_path):
    from runlens import __main__ as cli

    measured(spark, place)
    cli.main(["label", place("extract"), place("decisions"), place("meta"), "--generated-at", "t"])
    cli.main(["label", place("extract"), place("decisions2"), place("meta"), "--generated-at", "t", "--recorded", place("decisions")])
    cli.main(["final", place("table"), place("decisions2"), place("final"), place("csv")])
    cli.main(["coverage", place("table"), place("decisions"), place("coverage")])
    cli.main(["report", place("final"), "filtered_runs", place("filtered"), "--domains", "d", "--labels", "HEALTHY"])
    counted = [json.loads(x) for p in (tmp_path / "coverage").glob("part-*") for x in p.read_text().splitlines()]
    assert counted[0]["source_runs"] == 8 and counted[0]["missing_ids"] == 0
    assert spark.read.json(place("filtered")).count() == 8
