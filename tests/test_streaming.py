import pytest
from pyspark.sql import functions as F

from runlens.operators.measure import with_metrics
from runlens.plans import inputs, jobs
from runlens.sources import writers
from runlens.streaming import runs as streams
from samples import run, runs_frame


@pytest.fixture(scope="module")
def yearly_files(spark, sf_dir, tmp_path_factory):
    """One folder of run files, one file per year, written in time order, each year twice."""
    path = tmp_path_factory.mktemp("arrivals") / "runs"
    runs = inputs.runs(spark, sf_dir).cache()
    years = sorted({r.y for r in runs.selectExpr("substring(run_timestamp, 1, 4) AS y").distinct().collect()})
    for year in years:
        part = runs.where(f"run_timestamp LIKE '{year}%'").coalesce(1)
        part.unionAll(part).coalesce(1).write.mode("append").json(str(path))
    return str(path), len(years)


def test_stream_equals_batch_over_many_triggers(spark, sf_dir, yearly_files, tmp_path):
    path, files = yearly_files
    rows = streams.stream_metrics(streams.read_run_stream(spark, path, files_per_trigger=1), "400 days")
    query = streams.append_to_table(rows, str(tmp_path / "out"), str(tmp_path / "progress"))
    query.awaitTermination()
    assert sum(p["numInputRows"] > 0 for p in query.recentProgress) == files
    out = spark.read.parquet(str(tmp_path / "out"))
    batch = with_metrics(inputs.runs(spark, sf_dir))
    assert out.count() == 826 and batch.exceptAll(out.select(*batch.columns)).count() == 0


def test_spread_copies_are_still_kept_once(spark, yearly_files, tmp_path):
    path, _ = yearly_files
    stream = streams.read_run_stream(spark, path, files_per_trigger=3)
    rows = streams.stream_metrics(stream.select("*", "_metadata.file_path"), "400 days", F.col("file_path"), 4)
    streams.append_to_table(rows, str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == out.select("run_id").distinct().count() == 826


def test_daily_health_over_many_triggers_and_a_restart(spark, sf_dir, yearly_files, tmp_path):
    path, _ = yearly_files
    out, progress = str(tmp_path / "daily"), str(tmp_path / "progress")
    for _ in range(2):  # the second run finds nothing new
        rows = streams.domain_daily(streams.read_run_stream(spark, path, files_per_trigger=2), "400 days")
        streams.upsert_to_table(rows, out, progress).awaitTermination()
    daily = streams.read_domain_daily(spark, out)
    metrics = with_metrics(inputs.runs(spark, sf_dir))
    batch = metrics.selectExpr("substring(run_timestamp, 1, 10) AS day", "domain").groupBy("day", "domain").count()
    assert daily.selectExpr("day", "domain", "runs").exceptAll(
        batch.selectExpr("day", "domain", "count * 2")).count() == 0
    assert daily.count() == batch.count()
    streams.compact_domain_daily(spark, str(tmp_path / "compact"), out)
    for paths in ([str(tmp_path / "compact")], [str(tmp_path / "compact"), out]):
        again = streams.read_domain_daily(spark, *paths)
        assert again.count() == daily.count() and again.exceptAll(daily).count() == 0


def test_closed_days_can_be_appended(spark, yearly_files, tmp_path):
    path, _ = yearly_files
    rows = streams.domain_daily(streams.read_run_stream(spark, path, files_per_trigger=1), "1 day")
    streams.append_to_table(rows, str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination()
    days = spark.read.parquet(str(tmp_path / "out"))
    assert 0 < days.count() == days.select("day", "domain").distinct().count()


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    source = str(tmp_path / "in")
    for i, day in enumerate(["2026-01-10", "2026-01-20", "2026-01-01"]):
        arrived = runs_frame(spark, [run(run_id=f"r{i}", run_timestamp=f"{day}T00:00:00")])
        arrived.coalesce(1).write.mode("append").json(source)
    rows = streams.stream_metrics(streams.read_run_stream(spark, source, files_per_trigger=1), "2 days")
    query = streams.append_to_table(rows, str(tmp_path / "out"), str(tmp_path / "progress"))
    query.awaitTermination()
    assert sorted(r.run_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["r0", "r1"]
    assert sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"]) == 1


def test_stream_job_goes_on_where_it_stopped(spark, tmp_path):
    source, paths = tmp_path / "in", [str(tmp_path / n) for n in ("in", "table", "progress")]
    for day in (1, 2):
        rows = [run(run_id=f"r{day}", run_timestamp=f"2026-01-0{day}T00:00:00", error_message='say "x"')] * 2
        writers.write_csv(runs_frame(spark, rows).coalesce(1), str(source / f"day{day}"))
        jobs.stream_job(spark, paths[0] + "/*", *paths[1:], "7 days", "csv")
    out = spark.read.parquet(paths[1])
    assert sorted((r.run_id, r.error_message) for r in out.collect()) == [("r1", 'say "x"'), ("r2", 'say "x"')]


def test_rows_without_key_or_time_fail_or_are_set_aside(spark, tmp_path):
    source, p = str(tmp_path / "in"), lambda name: str(tmp_path / name)
    rows = [run(run_id="a"), run(run_id="b", run_timestamp="soon"), run(run_id=None), run(run_id=None),
            run(run_id="c", status="odd")]
    runs_frame(spark, rows).write.json(source)
    with pytest.raises(Exception, match="split the stream first"):
        jobs.stream_job(spark, source, p("t1"), p("p1"), "7 days")
    jobs.stream_job(spark, source, p("t2"), p("p2"), "7 days", quarantine_path=p("rejected"))
    assert [r.run_id for r in spark.read.parquet(p("t2")).collect()] == ["a"]
    rejected = spark.read.parquet(p("rejected")).collect()
    assert sorted((r.run_id or "", r.reasons) for r in rejected) == [
        ("", ["null_run_id"]), ("", ["null_run_id"]), ("b", ["bad_timestamp"]), ("c", ["unknown_status"])]


def test_event_time_is_utc_and_tolerates_bad_text(spark):
    df = runs_frame(spark, [run(run_timestamp="2026-01-01T12:30:00"), run(run_timestamp="soon")])
    seconds = [r.s for r in streams.with_event_time(df).selectExpr("unix_seconds(event_time) AS s").collect()]
    assert seconds == [1767270600, None]
