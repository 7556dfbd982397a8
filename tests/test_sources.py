import json

import pytest

from runlens.operators import contract, provenance
from runlens.operators.checks import quarantine
from runlens.functions.text import python_text
from runlens.operators.labels import chosen_probability, request_payload, scored_labels, with_policy
from runlens.operators.measure import decision_extract, with_metrics
from runlens.plans import inputs, jobs
from runlens.schemas import DASHBOARD_COLUMNS, EXTRACT_COLUMNS, RUNS
from runlens.sources import layout, readers, staging, writers
from samples import LABELLED, SAMPLE, run, runs_frame

HEADER = ",".join(RUNS.fieldNames())


def csv_line(row):
    return ",".join("" if v is None else str(v) for v in row)


def write_csv(path, rows, end="\r\n"):
    path.write_bytes(end.join([HEADER, *[r if isinstance(r, str) else csv_line(r) for r in rows], ""]).encode())
    return str(path)


def lines_of(folder):
    return [line for part in sorted(folder.glob("part-*")) for line in part.read_text().splitlines()]


@pytest.mark.parametrize("end", ["\r\n", "\n"])
def test_csv_scan(spark, tmp_path, end):
    df = readers.load_runs(spark, write_csv(tmp_path / "runs.csv", SAMPLE, end))
    assert sorted(tuple(r) for r in df.collect()) == sorted(SAMPLE)


def test_malformed_lines_reach_the_quarantine(spark, tmp_path):
    bad = csv_line(run(run_id="bad")).replace("1000", "many", 1)
    path = write_csv(tmp_path / "runs.csv", [run(run_id="good"), bad])
    valid, rejected = quarantine(readers.load_runs(spark, path, keep_malformed=True))
    assert [r.run_id for r in valid.collect()] == ["good"]
    row = rejected.first()
    assert row.run_id == "bad" and "malformed_record" in row.reasons and "many" in row._corrupt_record


def test_json_arrays_and_lines(spark, tmp_path):
    rows = [{"run_id": "a", "decision": "HEALTHY", "confidence": 1},
            {"run_id": "b", "decision": "BLOCK", "confidence": None}]
    (tmp_path / "array.json").write_text(json.dumps(rows, indent=2))
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, rows)))
    array = readers.load_decisions(spark, str(tmp_path / "array.json"), array=True)
    lines = readers.load_decisions(spark, str(tmp_path / "lines.json"))
    for df in (array, lines):
        assert sorted(tuple(r) for r in df.collect()) == [("a", "HEALTHY", 1.0), ("b", "BLOCK", None)]


def test_malformed_decision_trips_the_guard(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"run_id":"a","decision":"HEALTHY","confidence":null}\n{"run_id":"b",\n')
    metrics = with_metrics(runs_frame(spark, [run(run_id="a"), run(run_id="b")]))
    with pytest.raises(contract.ContractError, match="not one to one"):
        contract.check_contract(metrics, readers.load_decisions(spark, str(tmp_path / "d.json")))


def test_sinks_keep_nulls_order_and_count(spark, tmp_path):
    metrics = with_metrics(runs_frame(spark, SAMPLE))
    assert writers.export_extract(metrics, str(tmp_path / "x")) == 8
    records = [json.loads(line) for line in lines_of(tmp_path / "x")]
    assert [r["run_id"] for r in records] == sorted(r[0] for r in SAMPLE)
    assert list(records[0]) == EXTRACT_COLUMNS
    again = readers.load_extract(spark, str(tmp_path / "x"))
    assert again.exceptAll(decision_extract(metrics)).count() == 0
    labels = spark.createDataFrame([("a", "WATCH", None)], "run_id string, decision string, confidence double")
    assert writers.write_decisions(labels, str(tmp_path / "d")) == 1
    assert json.loads(lines_of(tmp_path / "d")[0]) == {"run_id": "a", "decision": "WATCH", "confidence": None}


def test_whole_run_of_the_jobs(spark, tmp_path):
    p = lambda name: str(tmp_path / name)
    source = write_csv(tmp_path / "runs.csv", SAMPLE)
    assert jobs.measure_job(spark, source, p("metrics"), p("extract")) == 8
    assert jobs.label_job(spark, p("extract"), p("decisions"), p("meta"), "policy", "v1", "2026-01-01") == 8
    meta = json.loads(lines_of(tmp_path / "meta")[0])
    assert meta["count"] == 8 and meta["labeller"] == "policy" and len(meta["input_hash"]) == 64
    assert jobs.final_job(spark, p("metrics"), p("decisions"), p("final"), p("csv")) == 8
    assert jobs.dashboard_job(spark, p("csv"), p("dashboard")) == 8
    final = readers.read_table(spark, p("final")).orderBy("run_id").collect()
    assert [r.label_decision for r in final] == LABELLED
    shown = [json.loads(line) for line in lines_of(tmp_path / "dashboard")]
    assert [list(r) for r in shown] == [DASHBOARD_COLUMNS] * 8
    assert [(r["label_decision"], r["failure_rate"]) for r in shown] == [
        (r.label_decision, r.failure_rate) for r in final]


def test_a_broken_contract_writes_nothing(spark, tmp_path):
    metrics = with_metrics(runs_frame(spark, [run(run_id="a"), run(run_id="b")]))
    writers.write_table(metrics, str(tmp_path / "metrics"))
    (tmp_path / "d.json").write_text('{"run_id":"a","decision":"HEALTHY"}\n')
    paths = [str(tmp_path / n) for n in ("metrics", "d.json", "final", "csv")]
    with pytest.raises(contract.ContractError):
        jobs.final_job(spark, *paths)
    assert not (tmp_path / "final").exists() and not (tmp_path / "csv").exists()
    twice = write_csv(tmp_path / "runs.csv", [run(), run()])
    with pytest.raises(contract.ContractError):
        jobs.measure_job(spark, twice, str(tmp_path / "m2"), str(tmp_path / "x2"))
    assert not (tmp_path / "m2").exists()


def test_command_line(spark, tmp_path, capsys):
    from runlens.__main__ import main

    p = lambda name: str(tmp_path / name)
    source = write_csv(tmp_path / "runs.csv", SAMPLE)
    main(["measure", source, p("m"), p("x")])
    main(["label", p("x"), p("d"), p("meta"), "--generated-at", "2026-01-01T00:00:00Z"])
    main(["final", p("m"), p("d"), p("f"), p("csv")])
    main(["dashboard", p("csv"), p("web")])
    main(["report", p("f"), "kpi_summary", p("kpi")])
    main(["report", p("f"), "alert_rows", p("alerts")])
    assert len(lines_of(tmp_path / "alerts")) == 4
    assert capsys.readouterr().out.splitlines() == [f"{j}: 8 rows" for j in ("measure", "label", "final", "dashboard")]
    assert json.loads(lines_of(tmp_path / "kpi")[0])["blocked"] == 2


def test_quarantine_paths_replace_failing(spark, tmp_path):
    p = lambda name: str(tmp_path / name)
    source = write_csv(tmp_path / "runs.csv", [run(run_id="a"), run(run_id="b"), run(run_id="c"), run(run_id="c")])
    assert jobs.measure_job(spark, source, p("m"), p("x"), quarantine_path=p("rejected")) == 2
    assert [r.run_id for r in spark.read.parquet(p("rejected")).collect()] == ["c", "c"]
    (tmp_path / "d.json").write_text('{"run_id":"a","decision":"HEALTHY"}\n{"run_id":"b","decision":"FINE"}\n')
    assert jobs.final_job(spark, p("m"), p("d.json"), p("f"), p("csv"), quarantine_path=p("bad")) == 1
    assert [tuple(r) for r in spark.read.parquet(p("bad")).collect()] == [("b", "bad_label")]


def test_csv_keeps_quotes_blanks_and_nulls(spark, tmp_path):
    rows = [run(run_id=f"r{i}", error_message=e) for i, e in enumerate(['say "no", twice', " ", None, "a\\b"])]
    writers.write_csv(runs_frame(spark, rows), str(tmp_path / "csv"))
    assert sorted(tuple(r) for r in readers.load_runs(spark, str(tmp_path / "csv")).collect()) == rows
    assert any('"say ""no"", twice"' in line for line in lines_of(tmp_path / "csv"))
    broken_line = run(run_id="m", error_message='"two\nlines"')
    path = write_csv(tmp_path / "multi.csv", [broken_line], "\n")
    assert readers.load_runs(spark, path, multi_line=True).first().error_message == "two\nlines"


def test_csv_as_python_prints_it(spark, tmp_path):
    values = [0.000342, -0.003208, 7.1e-05, 1e-06, -2.5e-05, 0.0001, 0.0, 1.0, 0.96, 0.1 + 0.2, 12345.678901, None]
    df = spark.createDataFrame([(v, v is not None) for v in values], "x double, b boolean")
    got = python_text(df).collect()
    assert [r.x for r in got] == [None if v is None else repr(v) for v in values]
    assert {r.b for r in got} == {"True", "False"}
    final = with_policy(with_metrics(runs_frame(spark, SAMPLE)))
    assert writers.export_final_csv(final, str(tmp_path / "csv"), as_python=True) == 8
    assert lines_of(tmp_path / "csv")[1] == (
        "auto_claims_dedupe_transform_20260918_0,auto_claims_dedupe_transform,auto_claims,"
        "2026-09-18T04:45:00,120000,119615,41,196,214,1,none,healthy,,0.000342,-0.003208,"
        "-0.084112,ON_TIME,False,False,HEALTHY,1.0")


def test_publishing_swaps_versions(spark, tmp_path):
    frame = with_metrics(runs_frame(spark, SAMPLE))
    for rows in (8, 3):
        assert writers.publish_table(frame.limit(rows), "published", str(tmp_path / "versions")) == rows
        assert spark.table("published").count() == rows
    assert len(list((tmp_path / "versions").iterdir())) == 2


def test_request_payload(spark):
    extract = decision_extract(with_metrics(runs_frame(spark, [run(domain=None)])))
    payload = json.loads(request_payload(extract).first().payload)
    assert list(payload) == EXTRACT_COLUMNS and payload["domain"] is None


def test_catalog_tables(spark, tmp_path):
    current = spark.catalog.currentDatabase()
    readers.use_namespace(spark, "lens_test", str(tmp_path / "db"))
    try:
        frame = with_metrics(runs_frame(spark, SAMPLE))
        assert writers.save_table(frame, "metrics") == 8
        assert writers.save_table(frame.limit(3), "metrics") == 3
        assert spark.table("lens_test.metrics").count() == 3
    finally:
        spark.catalog.setCurrentDatabase(current)


@pytest.mark.parametrize("change, message", [
    (lambda out: out.assign(decision="MAYBE"), "labels that are not allowed: 'MAYBE'"),
    (lambda out: out.iloc[1:], "exactly the runs"),
    (lambda out: out.assign(confidence=7.5), "confidence outside 0 to 1"),
    (lambda out: out.assign(run_id=[None, *out.run_id[1:]]), "exactly the runs"),
])
def test_scorer_answers_are_checked(spark, change, message):
    def scorer(batch):
        out = batch[["run_id"]].assign(decision="WATCH", confidence=0.5)
        assert list(batch.columns) == EXTRACT_COLUMNS
        return change(out)

    extract = decision_extract(with_metrics(runs_frame(spark, SAMPLE))).coalesce(1)
    with pytest.raises(Exception, match=message):
        scored_labels(extract, scorer).collect()


def test_confidence_is_the_probability_of_the_choice(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([({"BLOCK": 0.7}, "BLOCK"), (None, "BLOCK"), ({"WATCH": 0.2}, "BLOCK")],
                               "p map<string,double>, d string")
    got = [r.c for r in df.select(chosen_probability(F.col("p"), F.col("d")).alias("c")).collect()]
    assert got == [0.7, None, None]


@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_fingerprint_ignores_layout_and_sees_changes(spark, partitions):
    extract = decision_extract(with_metrics(runs_frame(spark, SAMPLE)))
    base = provenance.input_fingerprint(extract).first()
    assert provenance.input_fingerprint(extract.repartition(partitions)).first() == base
    assert provenance.input_fingerprint(extract.limit(7)).first() != base
    assert provenance.input_fingerprint(extract.unionAll(extract)).first() != base


@pytest.mark.parametrize("left, right", [
    ([("a\x1fb", "c")], [("a", "b\x1fc")]), ([("a", None)], [("a", "N")]), ([("1:a", "")], [("", "1:a")]),
    ([("x", "x"), ("y", "y")], [("x", "y"), ("y", "x")]),
])
def test_fingerprints_of_different_rows_differ(spark, left, right):
    of = [provenance.input_fingerprint(spark.createDataFrame(rows, "p string, q string")).first() for rows in (left, right)]
    assert of[0].fingerprint != of[1].fingerprint and of[0].digest_sum.count("-") == 4


def test_fingerprint_refuses_doubles_it_would_cut(spark):
    exact = spark.createDataFrame([(0.123456, "a"), (None, "b")], "v double, k string")
    assert provenance.input_fingerprint(exact).first().row_count == 2
    with pytest.raises(Exception, match="more than 6 decimals"):
        provenance.input_fingerprint(spark.createDataFrame([(0.1234561,)], "v double")).collect()


def test_python_text_refuses_what_it_cannot_print(spark):
    from runlens.functions.text import python_text

    with pytest.raises(Exception, match="too large"):
        python_text(spark.createDataFrame([(1e16,)], "v double")).collect()


def test_shared_folder_comes_from_the_session(spark):
    assert staging.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert staging.stage(inputs.runs(spark, "/root/testdata/sf0.001"), "t").inputFiles()[0].split(":")[-1].lstrip("/") \
        .startswith(staging.shared_folder(spark).lstrip("/"))
