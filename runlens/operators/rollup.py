"""Run roll-up: one run per supplier and ship month, built from raw order lines, at once or as lines arrive."""

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.functions.text import midnight_iso, run_key
from runlens.operators.contract import ContractError
from runlens.sources import layout
from runlens.sources.staging import remove_folder, stage

_SUMS = ["lines", "expected_rows", "actual_rows", "failed_rows", "line_numbers"]

def line_facts(lineitem: DataFrame) -> DataFrame:
    """Order lines summed per (supplier key, month) before any join.

    Only counts, sums and a minimum of fixed-width columns, so the map side already collapses a
    supplier that owns a large share of all lines, and the join sees one row per key and month. A
    fractional quantity counts as the nearest whole one, halves away from zero.
    """
    lines = lineitem.selectExpr(
        "l_suppkey",
        "CAST(l_shipdate AS date) AS shipped",
        "TRUNC(CAST(l_shipdate AS date), 'month') AS month",
        "CAST(ROUND(l_quantity) AS bigint) AS quantity",
        "CAST(l_linenumber AS bigint) AS number",
        "l_returnflag = 'R' AND l_linestatus = 'F' AS lost",
        "l_returnflag = 'R' AND l_linestatus = 'O' AND l_linenumber >= 4 AS rejected",
    )
    return lines.groupBy("l_suppkey", "month").agg(
        F.expr("COUNT(*) AS lines"),
        F.expr("SUM(quantity) AS expected_rows"),
        F.expr("SUM(IF(lost, 0, quantity)) AS actual_rows"),
        F.expr("SUM(IF(rejected, quantity, 0)) AS failed_rows"),
        F.expr("SUM(number) AS line_numbers"),
        F.expr("MIN(shipped) AS first_day"),
    )


def run_rollup(
    lineitem: DataFrame, supplier: DataFrame, nation: DataFrame, region: DataFrame, rules: dict[str, str]
) -> DataFrame:
    """Runs under the 13-column contract. ``rules`` gives the SQL of its last three columns
    (schema_drift, status, error_message) over the summed lines. Lines that no region can be found for
    are no part of any run; :func:`unmatched_lines` counts them.

    No join is hinted: nation and region are fixed small tables, and supplier is broadcast only while
    its scanned size is under the session's threshold. They are joined one by one because the size of
    a join is estimated as a product, which would hide that they are small. The second grouping
    merges suppliers that share a name, so that run_id stays unique; it moves pre-summed rows only.
    """
    return facts_rollup(line_facts(lineitem), supplier, nation, region, rules)


def facts_rollup(
    facts: DataFrame, supplier: DataFrame, nation: DataFrame, region: DataFrame, rules: dict[str, str],
    only: DataFrame | None = None,
) -> DataFrame:
    """:func:`run_rollup` of lines that are summed already, a key and month maybe in several rows; of all runs, or of
    those that ``only`` (s_name, month) names."""
    supplied = facts.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    if only is not None:
        supplied = supplied.join(only, ["s_name", "month"], "left_semi")
    placed = (
        supplied
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    merged = placed.groupBy("s_name", "r_name", "month").agg(
        *[F.expr(f"SUM({c}) AS {c}") for c in _SUMS], F.expr("MIN(first_day) AS first_day")
    )
    named = merged.select("*", F.expr("LOWER(REPLACE(s_name, '#', '_')) AS pipeline_name"))
    month = F.col("month")
    return named.select(
        run_key(F.col("pipeline_name"), month).alias("run_id"),
        "pipeline_name",
        F.expr("LOWER(r_name) AS domain"),
        midnight_iso(month).alias("run_timestamp"),
        "expected_rows",
        "actual_rows",
        "failed_rows",
        F.expr("line_numbers * 30 AS duration_seconds"),
        F.expr("lines * 120 AS expected_duration_seconds"),
        F.expr("CAST((DAY(first_day) - 1) * 20 AS bigint) AS freshness_delay_minutes"),
        *[F.expr(f"{rule} AS {name}") for name, rule in rules.items()],
    )


def unmatched_lines(
    lineitem: DataFrame, supplier: DataFrame, nation: DataFrame, region: DataFrame
) -> DataFrame:
    """(reason, lines, quantity): what :func:`run_rollup` leaves out, by the first key that leads
    nowhere. Together with the runs these are all lines."""
    placed = (
        line_facts(lineitem)
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    )
    reason = (
        F.when(F.col("l_suppkey").isNull(), "no supplier").when(F.col("s_suppkey").isNull(), "unknown supplier")
        .when(F.col("n_nationkey").isNull(), "unknown nation").when(F.col("r_regionkey").isNull(), "unknown region")
    )
    return placed.where(reason.isNotNull()).groupBy(reason.alias("reason")).agg(
        F.sum("lines").alias("lines"), F.sum("expected_rows").alias("quantity"))


def _add_facts(facts: DataFrame, batch: str, path: str) -> None:
    """Record a batch's sums below ``path`` by month, under the batch's id; nothing if the id is there."""
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch):
        raise ValueError(f"batch id {batch!r} cannot name a folder")
    spark, beside, place = facts.sparkSession, f"{path}/_incoming/{uuid.uuid4().hex}", f"{path}/batch={batch}"
    Path = spark._jvm.org.apache.hadoop.fs.Path
    fs = Path(place).getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(Path(place)):
        return
    try:
        facts.repartition("month").write.partitionBy("month").parquet(beside)
        if not fs.rename(Path(beside), Path(place)):
            raise ContractError(f"batch {batch} of {path} has been taken by another writer")
    finally:
        remove_folder(spark, beside)


def merge_lines(
    lineitem: DataFrame, batch: str, facts_path: str, table: str, supplier: DataFrame, nation: DataFrame,
    region: DataFrame, rules: dict[str, str], finish: Callable[[DataFrame], DataFrame] = lambda runs: runs,
) -> int | None:
    """Add order lines that arrived, late ones included, to the merged run table at ``table``, whose rows then equal
    ``finish`` of :func:`run_rollup` of all lines so far. Returns what :func:`layout.load_partitioned` does.

    The lines' sums per supplier and month are kept below ``facts_path`` under the id of the batch, so a batch that is
    delivered again, or repeated after a failure at any step, counts once. Only runs that a line of the batch belongs
    to are built again, from the sums of their months; other months are not read. Suppliers of one name share
    their runs, so all of them are reopened. Lines without ship date, and of suppliers without name, make no run here.
    A supplier that becomes known later counts from the next batch with lines of its month and name."""
    spark, facts = lineitem.sparkSession, line_facts(lineitem)
    _add_facts(facts, batch, facts_path)
    schema = T.StructType([f for f in facts.schema if f.name != "month"]).add("batch", "string").add("month", "date")
    kept = spark.read.schema(schema).parquet(facts_path)
    named = supplier.select("s_suppkey", "s_name")
    mine = kept.where((F.col("batch") == batch) & F.col("month").isNotNull())
    reopened = stage(mine.join(named, F.col("l_suppkey") == F.col("s_suppkey")).where("s_name IS NOT NULL").select(
        "s_name", "month").distinct(), "reopened")
    months = [r.month for r in reopened.select("month").distinct().collect()]  # calendar months, however many lines
    again = reopened_facts(kept, months)
    return layout.load_partitioned(spark, table, finish(facts_rollup(again, supplier, nation, region, rules, reopened)))


def reopened_facts(kept: DataFrame, months: list) -> DataFrame:
    """The kept sums of some months, by a filter on the partition column."""
    return kept.where(F.col("month").isin(months)).drop("batch")
