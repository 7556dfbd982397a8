"""Kept answers, SQL functions and the cube behind the dashboard's filters."""

import itertools
import os

import pytest
from pyspark.sql import functions as F

from runlens.functions import sql
from runlens.operators import labels, reports
from runlens.operators.contract import ContractError
from runlens.operators.measure import decision_extract, with_metrics
from runlens.plans import inputs
from samples import SAMPLE, run, runs_frame


def test_only_new_or_changed_runs_are_asked(spark, tmp_path):
    kept = str(tmp_path / "kept")
    asked = []

    def label(extract):
        asked.append(sorted(r.run_id for r in extract.collect()))
        return labels.policy_labels(extract)

    def extract(*rows):
        return decision_extract(with_metrics(runs_frame(spark, list(rows))))

    first = extract(*[run(run_id=f"r{i}") for i in range(5)])
    answers, count = labels.resumed_labels(first, label, kept)
    assert count == 5 and answers.count() == 5 and answers.columns == ["run_id", "decision", "confidence"]
    assert labels.resumed_labels(first, label, kept)[1] == 0 and len(os.listdir(kept + "/states")) == 1
    second = extract(run(run_id="r0", status="failed", failed_rows=900), run(run_id="r1"), run(run_id="new"))
    answers, count = labels.resumed_labels(second, label, kept)
    assert count == 2 and asked == [[f"r{i}" for i in range(5)], ["new", "r0"]]
    want = sorted(map(tuple, labels.policy_labels(second).collect()))
    assert sorted(map(tuple, answers.collect())) == want
    fewer, count = labels.resumed_labels(extract(run(run_id="r1")), label, kept)
    assert count == 0 and [r.run_id for r in fewer.collect()] == ["r1"]


def test_a_bad_answer_is_not_kept(spark, tmp_path):
    kept = str(tmp_path / "kept")
    extract = decision_extract(with_metrics(runs_frame(spark, [run(run_id="a"), run(run_id="b")])))
    for bad in (lambda e: labels.policy_labels(e).limit(1), lambda e: labels.policy_labels(e).withColumn("decision", F.lit("X")),
                lambda e: labels.policy_labels(e).withColumn("confidence", F.lit(2.0))):
        with pytest.raises(ContractError):
            labels.resumed_labels(extract, bad, kept)
    assert not os.path.exists(kept) and labels.resumed_labels(extract, labels.policy_labels, kept)[1] == 2


def test_sql_functions_equal_the_columns(spark):
    edges = [run(run_id=f"e{i}", expected_rows=e, failed_rows=f, actual_rows=a, freshness_delay_minutes=d, schema_drift=k, error_message=m)
             for i, (e, f, a, d, k, m) in enumerate([
                 (1600000, 580, 0, -1, None, None), (0, 5, 5, None, "", ""), (None, 1, 1, 15, "none", " "), (3, None, 2, 16, "None", "x"),
                 (7, 2, 3, 241, "type_changed", None), (2**40, 2**39 + 1, 2**41, 240, "none", "")])]
    rows = runs_frame(spark, [*SAMPLE, *edges])
    sql.register(spark)
    rows.createOrReplaceTempView("sql_function_runs")
    got = spark.sql(f"SELECT *, {sql.METRICS_SQL} FROM sql_function_runs")
    want = with_metrics(rows)
    assert got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()


def test_every_combination_of_filters_is_in_the_cube(spark, sf_dir):
    final = inputs.final(spark, sf_dir).cache()
    cube = reports.report_cube(final).cache()
    domains = [None, *[r.domain for r in final.select("domain").distinct().collect()], "nowhere"]
    for domain, label, drift in itertools.product(domains[:3] + domains[-1:], [None, "WATCH", "BLOCK"], [None, True, False]):
        rows = reports.filtered_runs(final, [domain] if domain else None, [label] if label else None, drift).collect()
        got = [tuple(r) for r in reports.cube_row(cube, domain, label, drift).collect()]
        if not rows:
            assert got == []
            continue
        n = len(rows)
        assert len(got) == 1 and got[0][0] == n
        assert got[0][1] == sum(r.freshness_delay_minutes for r in rows) / n
        assert abs(got[0][2] - sum(r.failure_rate for r in rows) / n) < 1e-9
    final.unpersist(), cube.unpersist()
