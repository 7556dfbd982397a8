"""Order operators against brute force, with one group holding most rows and spanning slices."""

import random

import pytest
from pyspark.sql import functions as F

from runlens.operators import alerts
from runlens.operators.ordered import _sliced, number_within, previous_within
from runlens.operators.upsert import latest_runs, merge_runs
from samples import run, runs_frame


def hot_rows(n=3000):
    rnd = random.Random(5)
    rows = []
    for i in range(n):
        group = "hot" if i % 3 else rnd.choice(["a", "b", "c", None])
        rows.append((group, rnd.randrange(40), i, rnd.choice(["x", "y", None])))
    rnd.shuffle(rows)
    return rows


def brute(rows):
    position, previous, last = {}, {}, {}
    for group, at, i, value in sorted(rows, key=lambda r: (r[0] or "", r[1], r[2])):
        n, before = last.get(group, (0, None))
        position[i], previous[i] = n, before
        last[group] = (n + 1, value)
    return position, previous


@pytest.fixture(scope="module")
def spread(spark):
    """Adaptive merging of small partitions off, so that even a test table has several slices."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("partitions", [1, 5])
def test_number_and_previous_equal_brute_force(spark, spread, partitions):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "g string, at int, i int, v string").repartition(partitions)
    position, previous = brute(rows)
    numbered = number_within(df, "g", ["at", "i"], "n")
    assert {r.i: r.n for r in numbered.collect()} == position
    before = previous_within(df, "g", ["at", "i"], F.col("v"), "p")
    assert {r.i: r.p for r in before.collect()} == previous
    assert numbered.columns == ["g", "at", "i", "v", "n"] and before.columns[-1] == "p"


def test_a_hot_group_spans_slices(spark, spread):
    df = spark.createDataFrame(hot_rows(), "g string, at int, i int, v string")
    sizes = _sliced(df, "g", ["at", "i"]).groupBy("__slice").count().collect()
    assert len(sizes) > 4 and max(r["count"] for r in sizes) < 1000  # the hot group has 2000 rows


def test_alerts(spark):
    labels = ["BLOCK", "BLOCK", "WATCH", "INVESTIGATE", "HEALTHY", "BLOCK"]
    rows = [(f"r{i}", "p", "d", f"2026-01-0{i + 1}T00:00:00", label) for i, label in enumerate(labels)]
    rows.append(("s0", "q", "d", "2026-01-01T00:00:00", "WATCH"))
    final = spark.createDataFrame(
        rows, "run_id string, pipeline_name string, domain string, run_timestamp string, label_decision string")
    found = {r.run_id: (r.previous_decision, r.alert) for r in alerts.alert_rows(final).collect()}
    assert found == {
        "r0": (None, "NEWLY_BLOCKED"), "r3": ("WATCH", "WORSENED"), "r5": ("HEALTHY", "NEWLY_BLOCKED")}


def test_run_key_from_ordinal(spark):
    rows = [run(run_id=f"r{d}{h}", run_timestamp=f"2026-09-1{d}T{h:02}:00:00") for d in (9, 8) for h in (14, 2)]
    keys = [r.run_key for r in alerts.run_ordinal(runs_frame(spark, rows)).orderBy("run_key").collect()]
    assert keys == ["p_20260918_0", "p_20260918_1", "p_20260919_2", "p_20260919_3"]


def test_latest_version_wins_and_replay_changes_nothing(spark):
    stored = runs_frame(spark, [run(run_id="a", actual_rows=1), run(run_id="b", actual_rows=1)])
    batch = runs_frame(spark, [run(run_id="b", actual_rows=2), run(run_id="c", actual_rows=2)])
    once = merge_runs(stored, batch)
    assert once.columns == stored.columns
    expected = {"a": 1, "b": 2, "c": 2}
    assert {r.run_id: r.actual_rows for r in once.collect()} == expected
    assert {r.run_id: r.actual_rows for r in merge_runs(once, batch).collect()} == expected


def test_latest_runs_with_many_copies_of_one_key(spark):
    df = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("run_id"),
        F.col("id").alias("version"), (F.col("id") * 2).alias("v"))
    rows = {r.run_id: r.v for r in latest_runs(df).collect()}
    assert rows["hot"] == 2 * 1998 and len(rows) == 2000 - 667 + 1
