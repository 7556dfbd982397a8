import pytest

from runlens.operators.contract import (
    ContractError, build_final, check_contract, check_source_keys, coverage_violations,
    duplicate_runs, join_final, quarantine_final, rename_judgment,
)
from runlens.operators.measure import with_metrics
from runlens.schemas import FINAL
from samples import decisions_frame, run, runs_frame


def metrics(spark, *ids):
    return with_metrics(runs_frame(spark, [run(run_id=i) for i in ids]))


def labels(spark, *rows):
    return decisions_frame(spark, [(*row, None)[:3] for row in rows])


def violations(spark, ids, rows):
    found = coverage_violations(metrics(spark, *ids), labels(spark, *rows)).collect()
    return sorted((r.run_id or "", r.violation) for r in found)


def test_clean_contract_joins_one_to_one(spark):
    m, d = metrics(spark, "a", "b"), labels(spark, ("b", "BLOCK", 0.5), ("a", "HEALTHY"))
    assert check_contract(m, d) == 2
    final = build_final(m, d)
    assert final.columns == FINAL.fieldNames()
    rows = {r.run_id: (r.label_decision, r.label_confidence) for r in final.collect()}
    assert rows == {"a": ("HEALTHY", None), "b": ("BLOCK", 0.5)}
    renamed = rename_judgment(final, "my_decision", "my_confidence")
    assert renamed.columns[-2:] == ["my_decision", "my_confidence"]


@pytest.mark.parametrize("ids, rows, message, found", [
    (["a", "b"], [("a", "HEALTHY")], "not one to one", [("b", "missing")]),
    (["a"], [("a", "HEALTHY"), ("b", "WATCH")], "not one to one", [("b", "extra")]),
    (["a", "b"], [("a", "HEALTHY")] * 2, "not one to one",
     [("a", "duplicate"), ("b", "missing")]),
    (["a"], [("a", "MAYBE")], "label that is not allowed", [("a", "bad_label")]),
    (["a"], [("a", None)], "label that is not allowed", [("a", "bad_label")]),
    (["a"], [("a", "healthy")], "label that is not allowed", [("a", "bad_label")]),
    (["a"], [("a", "HEALTHY"), (None, "WATCH")], "not one to one", [("", "extra")]),
    ([None], [(None, "WATCH")], "not one to one", [("", "extra"), ("", "missing")]),
    (["a", "a"], [("a", "HEALTHY")], "not one to one", [("a", "source_duplicate")]),
    (["a", "b"], [("a", "MAYBE")], "not one to one", [("a", "bad_label"), ("b", "missing")]),
    (["a"], [], "not one to one", [("a", "missing")]),
])
def test_broken_contract_is_refused(spark, ids, rows, message, found):
    with pytest.raises(ContractError, match=message) as error:
        build_final(metrics(spark, *ids), labels(spark, *rows))
    assert violations(spark, ids, rows) == found
    listed = spark.read.parquet(str(error.value).rpartition(" ")[2]).collect()  # every key, no cap
    assert sorted((r.run_id or "", r.violation) for r in listed) == found


def test_duplicate_with_full_coverage_is_refused(spark):
    ids = [f"r{i}" for i in range(40)]
    rows = [(i, "HEALTHY") for i in ids] + [("r0", "HEALTHY")]
    with pytest.raises(ContractError, match="not one to one"):
        check_contract(metrics(spark, *ids), labels(spark, *rows))
    assert violations(spark, ids, rows) == [("r0", "duplicate")]


def test_empty_tables_keep_the_contract(spark):
    assert check_contract(metrics(spark), labels(spark)) == 0


def test_source_keys(spark):
    assert check_source_keys(runs_frame(spark, [run(run_id="a"), run(run_id="b")])) == 2
    twice = runs_frame(spark, [run(run_id="a"), run(run_id="a"), run(run_id="b")])
    with pytest.raises(ContractError, match="3 rows, 2 ids"):
        check_source_keys(twice)
    assert [tuple(r) for r in duplicate_runs(twice).collect()] == [("a", 2)]


def test_quarantine_keeps_clean_runs_only(spark):
    m = metrics(spark, "a", "b", "c", "d", "d", None)
    d = labels(spark, ("a", "HEALTHY"), ("b", "MAYBE"), ("d", "WATCH"), ("x", "WATCH"), (None, "WATCH"))
    final, rejected = quarantine_final(m, d)
    assert [r.run_id for r in final.collect()] == ["a"]
    assert sorted((r.run_id or "", r.violation) for r in rejected.collect()) == [
        ("", "extra"), ("", "missing"), ("b", "bad_label"), ("c", "missing"),
        ("d", "source_duplicate"), ("x", "extra")]


def test_guard_is_one_shuffle_of_keys_with_partial_sums(spark, sf_dir):
    from runlens.operators.contract import key_status
    from runlens.plans import inputs
    from runlens.sources.staging import stage
    from test_metrics import plan

    runs = stage(inputs.runs(spark, sf_dir), "guard-runs")
    decisions = stage(inputs.decisions(spark, sf_dir), "guard-decisions")
    text = plan(key_status(runs, decisions))
    tree = text.split("\n\n")[0]
    assert tree.count("Exchange") == 1 and "Join" not in tree and tree.count("HashAggregate") == 2
    assert "pipeline_name" not in text


def test_bucketed_tables_are_joined_without_shuffle(spark, sf_dir):
    from runlens.plans import inputs
    from runlens.sources.writers import save_table
    from test_metrics import plan

    assert save_table(inputs.metrics(spark, sf_dir), "bucketed_metrics", buckets=4) == 826
    assert save_table(inputs.decisions(spark, sf_dir), "bucketed_decisions", buckets=4) == 826
    m, d = spark.table("bucketed_metrics"), spark.table("bucketed_decisions")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in plan(join_final(m, d)).split("\n\n")[0]
        assert "Exchange" not in plan(duplicate_runs(m)).split("\n\n")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert check_contract(m, d) == 826
