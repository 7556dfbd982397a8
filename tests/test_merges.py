"""Merged tables: pruning, failures at every step, deliveries, moved runs and what follows their changes."""

import os

import pytest
from pyspark.sql import functions as F

from runlens.operators import folds, provenance
from runlens.operators.contract import ContractError
from runlens.operators.measure import with_metrics
from runlens.plans import inputs, jobs
from runlens.schemas import EXTRACT_COLUMNS
from runlens.sources import layout, staging
from runlens.streaming import runs as streams
from samples import run, runs_frame
from test_metrics import plan


@pytest.fixture
def place(tmp_path):
    return lambda name: str(tmp_path / name)


def day(k, month=1):
    return f"2026-{month:02d}-{k:02d}T00:00:00"


def grid(spark, **values):
    return runs_frame(spark, [run(run_id=f"{d}{i}", domain=d, run_timestamp=day(i), **values) for d in "xy" for i in (1, 2)])


def stored(spark, path):
    return {r.run_id: (r.domain, str(r.run_date), r.actual_rows) for r in layout.read_partitioned(spark, path).collect()}


def scanned_rows(df):
    """Rows that the Parquet scans of a collected frame put out."""
    df.collect()
    rows = []

    def walk(node):
        if node.nodeName().startswith("Scan parquet"):
            rows.append(node.metrics().get("numOutputRows").get().value())
        if "AdaptiveSparkPlan" in node.nodeName():
            walk(node.executedPlan())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return sum(rows)


def test_partitions_are_pruned_and_untouched_files_stay(spark, place, tmp_path):
    layout.write_partitioned(grid(spark), place("t"))
    one = layout.read_partitioned(spark, place("t"), "x", "2026-01-02")
    assert [r.run_id for r in one.collect()] == ["x2"]
    filters = next(line for line in plan(one).splitlines() if "PartitionFilters" in line)
    assert "domain" in filters and "run_date" in filters and "version" in filters
    before = {f for f in (tmp_path / "t").glob("data/*/*/*/part-*")}
    batch = [run(run_id="x2", domain="x", run_timestamp=day(2), actual_rows=7), run(run_id="x3", domain="x", run_timestamp=day(3))]
    layout.upsert_partitioned(spark, place("t"), runs_frame(spark, batch))
    assert stored(spark, place("t")) == {
        "x1": ("x", "2026-01-01", 1000), "x2": ("x", "2026-01-02", 7), "x3": ("x", "2026-01-03", 1000),
        "y1": ("y", "2026-01-01", 1000), "y2": ("y", "2026-01-02", 1000)}
    written = {f for f in (tmp_path / "t").glob("data/*/*/*/part-*")} - before
    assert {f.parent.parent.name + "/" + f.parent.name for f in written} == {
        "domain=x/run_date=2026-01-02", "domain=x/run_date=2026-01-03"}
    undated = [run(run_id="n", domain="x", run_timestamp="soon")]
    with pytest.raises(ContractError, match="run date"):
        layout.upsert_partitioned(spark, place("t"), runs_frame(spark, undated))
    with pytest.raises(ContractError, match="no table"):
        layout.upsert_partitioned(spark, place("none"), runs_frame(spark, batch))


def test_a_moved_run_leaves_its_old_partition(spark, place):
    layout.write_partitioned(grid(spark), place("t"))
    moved = [run(run_id="y1", domain="x", run_timestamp=day(2), actual_rows=5)]
    layout.upsert_partitioned(spark, place("t"), runs_frame(spark, moved))
    assert stored(spark, place("t"))["y1"] == ("x", "2026-01-02", 5) and len(stored(spark, place("t"))) == 4
    assert layout.read_partitioned(spark, place("t"), "y").count() == 1
    signed, _ = layout.changes(spark, place("t"), after=1)
    assert sorted((r.run_id, r.domain, r.sign) for r in signed.collect()) == [("y1", "x", 1), ("y1", "y", -1)]


@pytest.mark.parametrize("pushed", [1000, 1])
@pytest.mark.parametrize("listed", [10_000, 1])
def test_merges_equal_an_upsert_of_all_rows(spark, place, sf_dir, monkeypatch, pushed, listed):
    monkeypatch.setattr(layout, "PUSHED_KEYS", pushed)
    monkeypatch.setattr(layout, "LISTED_PARTITIONS", listed)
    runs = staging.stage(inputs.runs(spark, sf_dir), "runs")
    layout.write_partitioned(runs, place("t"))
    batch = staging.stage(inputs.incoming_runs(runs, inputs.table(spark, sf_dir, "region")), "incoming")
    layout.upsert_partitioned(spark, place("t"), batch)
    want = runs.join(batch, "run_id", "left_anti").select(*runs.columns).unionByName(batch)
    got = layout.read_partitioned(spark, place("t")).select(*runs.columns)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()
    held = layout.state(spark, place("t")).where("kind = 'partition'").agg(F.sum("rows")).first()[0]
    assert held == want.count()


@pytest.mark.parametrize("step", ["_write_version", "_write_changes", "_publish", "stored_places", "stage", "latest_runs"])
def test_a_failure_at_any_step_loses_nothing(spark, place, monkeypatch, step):
    """The step fails after its work, as a lost driver would leave it; the merge is then run again."""
    layout.write_partitioned(grid(spark), place("t"))
    before = stored(spark, place("t"))
    batch = runs_frame(spark, [run(run_id="x1", domain="x", run_timestamp=day(1), actual_rows=9),
                               run(run_id="y2", domain="x", run_timestamp=day(3))])
    original = getattr(layout, step)

    def broken(*args, **named):
        if step == "_publish":  # the state is written, but not renamed
            with monkeypatch.context() as inner:
                inner.setattr(layout, "_file_system", lambda *a: (_ for _ in ()).throw(OSError("lost")))
                original(*args, **named)
        original(*args, **named)
        raise OSError("lost")

    monkeypatch.setattr(layout, step, broken)
    with pytest.raises(OSError, match="lost"):
        layout.upsert_partitioned(spark, place("t"), batch)
    assert stored(spark, place("t")) == before
    monkeypatch.setattr(layout, step, original)
    layout.upsert_partitioned(spark, place("t"), batch)
    after = stored(spark, place("t"))
    assert after == {"x1": ("x", "2026-01-01", 9), "x2": before["x2"], "y1": before["y1"], "y2": ("x", "2026-01-03", 1000)}
    states = layout.published(spark, place("t"))
    assert layout.upsert_partitioned(spark, place("t"), batch) is None  # a replay changes nothing
    assert layout.published(spark, place("t")) == states and stored(spark, place("t")) == after
    signed, _ = layout.changes(spark, place("t"))
    assert signed.groupBy("run_id").agg(F.sum("sign").alias("n")).where("n <> 1").count() == 0
    layout.vacuum(spark, place("t"), states=1)
    assert stored(spark, place("t")) == after and layout.published(spark, place("t")) == states[-1:]
    versions = {r.version for r in layout.state(spark, place("t")).where("kind = 'partition'").collect()}
    assert {n.partition("=")[2] for n in os.listdir(place("t") + "/data") if "=" in n} == versions


def test_two_writers_of_one_state_cannot_both_publish(spark, place):
    layout.write_partitioned(grid(spark), place("t"))
    with pytest.raises(ContractError, match="another writer"):
        layout._publish(spark, place("t"), 1, layout.state(spark, place("t")))


def test_keys_are_looked_up_without_reading_files_that_lack_them(spark, place):
    ids = spark.range(20_000)
    many = ids.select(*[
        F.concat(F.lit("pipe_"), F.col("id")).alias("run_id") if f.name == "run_id"
        else F.lit("d").alias("domain") if f.name == "domain"
        else F.concat(F.lit("2026-01-"), F.lpad((F.col("id") % 20 + 1).cast("string"), 2, "0"), F.lit("T00:00:00")).alias(f.name)
        if f.name == "run_timestamp" else F.lit(None).cast(f.dataType).alias(f.name) for f in grid(spark).schema])
    layout.write_partitioned(many, place("t"))
    existing = layout.read_partitioned(spark, place("t"))
    keys = spark.createDataFrame([("pipe_7",), ("pipe_27",), ("pipe_none",)], "run_id string")
    found = layout.stored_places(existing, keys)
    assert [str(r.run_date) for r in found.collect()] == ["2026-01-08"]
    assert scanned_rows(layout.stored_places(existing, keys)) <= 2000  # of 20,000: one partition, or two by chance


def test_the_file_modified_last_wins(spark, place):
    """Two deliveries of a run in one batch: the later one has the smaller count."""
    runs_frame(spark, [run(run_id="a", actual_rows=100)]).coalesce(1).write.mode("append").json(place("in"))
    runs_frame(spark, [run(run_id="a", actual_rows=7)]).coalesce(1).write.mode("append").json(place("in"))
    files = sorted((os.path.getmtime(f"{place('in')}/{f}"), f) for f in os.listdir(place("in")) if f.startswith("part"))
    for k, (_, name) in enumerate(files):
        os.utime(f"{place('in')}/{name}", (1_700_000_000 + k, 1_700_000_000 + k))
    jobs.load_job(spark, place("in"), place("t"), place("p"))
    assert [r.actual_rows for r in layout.read_partitioned(spark, place("t")).collect()] == [7]


def test_a_row_without_a_valid_time_fails_the_load(spark, place):
    rows = [run(run_id="a"), run(run_id="b", run_timestamp="2026-01-01Tgarbage")]
    runs_frame(spark, rows).write.json(place("in"))
    with pytest.raises(Exception, match="bad_timestamp=1"):
        jobs.load_job(spark, place("in"), place("t"), place("p"))
    jobs.load_job(spark, place("in"), place("t"), place("p2"), quarantine_path=place("q"))
    assert list(stored(spark, place("t"))) == ["a"]
    assert [r.reasons for r in spark.read.parquet(place("q")).collect()] == [["bad_timestamp"]]


def test_totals_follow_corrections_moves_and_replays(spark, place):
    columns = list(EXTRACT_COLUMNS)

    def check():
        rows = layout.read_partitioned(spark, place("t"))
        want = {(str(r.run_date), r.domain): r.n for r in rows.groupBy("run_date", "domain").agg(F.count("*").alias("n")).collect()}
        got = folds.daily_health(spark, place("t"), place("daily")).collect()
        assert {(r.day, r.domain): r.runs for r in got} == want
        mean = {(str(r.run_date), r.domain): r.m for r in rows.groupBy("run_date", "domain").agg(F.avg("failure_rate").alias("m")).collect()}
        assert {(r.day, r.domain): r.mean_failure_rate for r in got} == {k: round(m, 6) for k, m in mean.items()}
        kept = folds.maintained_fingerprint(spark, place("t"), place("digests"), columns).first()
        assert kept == provenance.input_fingerprint(rows.select(*columns)).first()

    assert folds.daily_health(spark, place("t"), place("daily")).count() == 0
    assert folds.maintained_fingerprint(spark, place("t"), place("digests"), columns).first() == provenance.input_fingerprint(
        with_metrics(grid(spark)).select(*columns).limit(0)).first()
    layout.load_partitioned(spark, place("t"), with_metrics(grid(spark)))
    check()
    again = with_metrics(runs_frame(spark, [
        run(run_id="x1", domain="x", run_timestamp=day(1), failed_rows=300), run(run_id="y1", domain="y", run_timestamp=day(2)),
        run(run_id="z", domain="z", run_timestamp=day(9, 2))]))
    layout.load_partitioned(spark, place("t"), again)
    layout.load_partitioned(spark, place("t"), with_metrics(runs_frame(spark, [run(run_id="z", domain="y", run_timestamp=day(1))])))
    check()
    states = os.listdir(place("daily") + "/states")
    layout.load_partitioned(spark, place("t"), again.where("run_id = 'x1'"))
    check()
    assert sorted(os.listdir(place("daily") + "/states")) == sorted(states)
    layout.write_partitioned(with_metrics(grid(spark, failed_rows=10)), place("t"))
    check()
    assert jobs.health_job(spark, place("t"), place("daily"), place("out")) == 4


def test_late_rows_of_many_batches_are_all_counted(spark, place):
    """More micro-batches than the progress of a query remembers."""
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        for i, text in enumerate([day(20), day(25), day(1), day(2), day(3), day(4)]):
            runs_frame(spark, [run(run_id=f"r{i}", run_timestamp=text)]).coalesce(1).write.mode("append").json(place("in"))
        late = jobs.stream_job(spark, place("in"), place("t"), place("p"), "2 days", files_per_trigger=1)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert late == 4 and spark.read.parquet(place("t")).count() == 2
    assert streams.ARRIVAL not in layout.with_run_date(grid(spark)).columns


def test_a_large_batch_meets_the_stored_rows_once(spark, place, monkeypatch):
    """Rows without a repeated key are not sorted to find the latest, and stored rows are compared in one pass."""
    monkeypatch.setattr(layout, "PUSHED_KEYS", 1)
    stage, names = layout.stage, []
    monkeypatch.setattr(layout, "stage", lambda df, name: names.append(name) or stage(df, name))
    layout.load_partitioned(spark, place("t"), grid(spark))
    assert names == ["versions", "partition-rows"]
    names.clear()
    layout.load_partitioned(spark, place("t"), grid(spark, actual_rows=3))
    assert names == ["versions", "merged", "partition-rows"]
    assert {v[2] for v in stored(spark, place("t")).values()} == {3}
    assert layout.load_partitioned(spark, place("t"), grid(spark, actual_rows=3)) is None
    twice = grid(spark, actual_rows=3).unionByName(grid(spark, actual_rows=4))
    layout.load_partitioned(spark, place("t"), twice)
    assert {v[2] for v in stored(spark, place("t")).values()} == {4} and len(stored(spark, place("t"))) == 4


def test_compared_rows_equal_those_told_by_joins(spark):
    """Repeated and missing keys on the stored side, missing ones in the batch."""
    columns = "run_id string, domain string, v int"
    old = spark.createDataFrame([("a", "x", 1), ("a", "x", 2), ("b", "x", 1), ("b", "x", 1), ("c", "x", 1), (None, "x", 1),
                                 (None, "x", 2), ("d", "x", 1), ("e", "x", None), ("f", "x", 1), ("f", "x", 2)], columns)
    new = spark.createDataFrame([("a", "x", 1), ("b", "x", 1), ("c", "y", 1), (None, "x", 1), ("e", "x", None), ("f", "x", 3),
                                 ("g", "x", 1)], columns)
    pairs = new.join(old.select("run_id", F.struct("domain", "run_id", "v").alias("old")), "run_id", "left")
    come = pairs.where("old IS NULL OR NOT (struct(domain, run_id, v) <=> old)").drop("old")
    gone, stay = old.join(come, "run_id", "left_semi"), old.join(come, "run_id", "left_anti")
    want = [(*r, 1) for r in come.collect()] + [(*r, -1) for r in gone.collect()] + [(*r, 0) for r in stay.collect()]
    told = layout._compared(old, new)
    assert plan(told).count("Arguments: hashpartitioning(") == 1
    same = [("a", "x", 1, 0), ("b", "x", 1, 0), ("e", "x", None, 0)]  # rows of the batch that are stored are none
    assert sorted(map(tuple, told.collect()), key=repr) == sorted(want, key=repr) and ("b", "x", 1, 0) in want and same[2] in want
