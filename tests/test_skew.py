"""Whole results when one key holds a third or more of all rows, against brute force."""

import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from compare import compare, oracle
from runlens.operators.contract import ContractError, check_contract, coverage_report, quarantine_final
from runlens.operators.measure import with_metrics
from samples import decisions_frame, run, runs_frame

NAMES = [
    "run_rollup", "metrics_full", "run_ordinal", "alert_rows", "final_analytics", "clean_final",
    "coverage_report", "coverage_violations", "duplicate_runs", "health_table", "mean_freshness",
    "quarantine_rows", "valid_rows", "reconcile_diff", "latest_runs", "kpi_summary",
]


@pytest.fixture(scope="module")
def skewed_dir(tmp_path_factory, sf_dir):
    """Raw tables where one supplier ships half of all lines, two suppliers of a region share a name,
    and some lines name no supplier or an unknown one."""
    import datetime

    folder = tmp_path_factory.mktemp("skewed")
    rnd = random.Random(3)
    suppliers = [(k, f"Supplier#{k:09d}", k % 25, 0.0) for k in range(12)] + [(12, "Supplier#000000003", 3, 0.0)]
    start = datetime.datetime(1995, 1, 1)
    lines = [
        (
            7 if i % 2 else rnd.choice([*range(13), None, 99]), rnd.randrange(1, 8),
            float(rnd.randrange(1, 51)), rnd.choice("ARN"), rnd.choice("FO"),
            start + datetime.timedelta(days=rnd.randrange(2500)),
        )
        for i in range(20000)
    ]

    def write(name, rows, **types):
        columns = {n: pa.array(c, t) for (n, t), c in zip(types.items(), zip(*rows))}
        pq.write_table(pa.table(columns), folder / f"{name}.parquet", row_group_size=3000)

    write("lineitem", lines, l_suppkey=pa.int64(), l_linenumber=pa.int32(), l_quantity=pa.float64(),
          l_returnflag=pa.string(), l_linestatus=pa.string(), l_shipdate=pa.timestamp("us"))
    write("supplier", suppliers, s_suppkey=pa.int64(), s_name=pa.string(), s_nationkey=pa.int32(),
          s_acctbal=pa.float64())
    for name in ("nation", "region"):
        pq.write_table(pq.read_table(f"{sf_dir}/{name}.parquet"), folder / f"{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", NAMES)
def test_skewed_raw_tables(spark, skewed_dir, name):
    con = oracle(skewed_dir, ["lineitem", "supplier", "nation", "region"])
    assert compare(entry.queries()[name](spark, skewed_dir), con, entry.oracle_sql()[name]) > 0


def test_contract_with_a_hot_decision_key(spark):
    ids = [f"r{i}" for i in range(1000)]
    metrics = with_metrics(runs_frame(spark, [run(run_id=i) for i in ids])).repartition(5)
    decisions = decisions_frame(
        spark, [(i, "HEALTHY", None) for i in ids] + [("r0", "HEALTHY", None)] * 1000 + [(None, "WATCH", None)] * 500
    ).repartition(7)
    row = coverage_report(metrics, decisions).first().asDict()
    assert row == {"source_runs": 1000, "decisions": 2500, "missing_ids": 0, "extra_ids": 1,
                   "duplicate_ids": 2, "source_duplicate_ids": 0, "bad_labels": 0}
    with pytest.raises(ContractError, match="extra=1, duplicate=2"):
        check_contract(metrics, decisions)
    final, rejected = quarantine_final(metrics, decisions)
    assert final.count() == 999 and rejected.where(F.col("run_id") == "r0").count() == 1
