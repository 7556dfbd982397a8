"""Inputs of the registered queries, derived by Spark from the whole raw tables.

The raw tables hold no runs, labels or defects. Runs come from the roll-up, labels from the native
policy, and the inputs of the checks are the same whole tables with defects added by rule: the
``every(n)`` conditions below choose which rows get a defect and leave no other row out.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.operators.labels import policy_labels, with_policy
from runlens.operators.measure import decision_extract, with_metrics
from runlens.operators.rollup import run_rollup
from runlens.schemas import CONFIDENCE, DECISION
from runlens.sources.staging import stage


# the columns the roll-up reads; a fixed schema spares the footer scan that inference needs
RAW = {
    "lineitem": "l_suppkey bigint, l_linenumber int, l_quantity double, l_returnflag string, "
    "l_linestatus string, l_shipdate timestamp_ntz",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "nation": "n_nationkey int, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


# the raw tables hold no drift, status or errors: these rules make them up from the summed lines
MADE_UP = {
    "schema_drift": """CASE WHEN lines % 11 = 0 THEN 'type_changed' WHEN lines % 7 = 0 THEN 'column_added'
        WHEN lines % 13 = 0 THEN 'column_removed' ELSE 'none' END""",
    "status": """CASE WHEN failed_rows * 5 >= expected_rows THEN 'failed'
        WHEN actual_rows * 10 < expected_rows * 9 OR failed_rows * 200 > expected_rows THEN 'degraded'
        ELSE 'healthy' END""",
    "error_message": """CASE WHEN failed_rows * 5 >= expected_rows THEN 'upstream rows rejected'
        WHEN failed_rows * 200 > expected_rows AND lines % 2 = 0
        THEN 'row count variance above warn threshold' END""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(RAW[name]).parquet(f"{sf_dir}/{name}.parquet")


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_rollup(*[table(spark, sf_dir, name) for name in RAW], MADE_UP)


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_metrics(runs(spark, sf_dir))


def undisclosed() -> Column:
    """Runs for which the labeller gives no probability, so that null confidence occurs."""
    return F.col("freshness_delay_minutes") % 140 == 100


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return policy_labels(decision_extract(metrics(spark, sf_dir)), undisclosed())


def final(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(runs(spark, sf_dir))


def every(n: int) -> Column:
    return F.col("expected_rows") % n == 0


def staged_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs, written once, for queries that use them more than once."""
    return stage(runs(spark, sf_dir), "runs")


def labelled(runs: DataFrame) -> DataFrame:
    return with_policy(with_metrics(runs), undisclosed())


def broken_decisions(runs: DataFrame, region: DataFrame) -> DataFrame:
    """Decisions with missing, repeated, extra and null keys, and labels outside the vocabulary."""
    decided = labelled(runs).select(
        "run_id",
        F.when(every(83), F.lit("MAYBE")).otherwise(F.col(DECISION)).alias("decision"),
        F.col(CONFIDENCE).alias("confidence"),
        F.when(every(97), 0).when(every(89), 2).otherwise(1).alias("copies"),
    )
    copied = decided.select(
        "run_id", "decision", "confidence",
        F.explode(F.array_repeat(F.lit(1), F.col("copies"))).alias("copy"),
    ).drop("copy")
    ghosts = region.select(
        F.concat(F.lit("ghost_"), F.lower("r_name")).alias("run_id"),
        F.lit("WATCH").alias("decision"),
        F.lit(0.5).alias("confidence"),
    )
    null_rows = runs.sparkSession.sql(
        "SELECT * FROM VALUES ('null_label', NULL, 0.5D), (NULL, 'WATCH', 0.5D) "
        "AS t(run_id, decision, confidence)"
    )
    return copied.unionByName(ghosts).unionByName(null_rows)


def broken_runs(runs: DataFrame) -> DataFrame:
    """Runs with repeated keys, impossible counts, null status, unknown drift, negative delay."""
    expected, delay = F.col("expected_rows"), F.col("freshness_delay_minutes")
    changed = runs.withColumns(
        {
            "failed_rows": F.when(every(103), expected + 1).otherwise(F.col("failed_rows")),
            "status": F.when(~every(107), F.col("status")),
            "schema_drift": F.when(every(109), "renamed").otherwise(F.col("schema_drift")),
            "freshness_delay_minutes": F.when(every(113), -5).otherwise(delay),
            "copy": F.explode(F.array_repeat(F.lit(1), F.when(every(101), 2).otherwise(1))),
        }
    )
    return changed.select(*runs.columns)


def drifted(final: DataFrame) -> DataFrame:
    """The final table with some failure rates changed."""
    rate = F.col("failure_rate")
    return final.withColumn("failure_rate", F.when(every(97), rate + 0.001).otherwise(rate))


def incoming_runs(runs: DataFrame, region: DataFrame) -> DataFrame:
    """A correction batch: some runs delivered again with more rows, and a new run per region."""
    corrected = runs.where(every(101)).withColumn("actual_rows", F.col("actual_rows") + 1000)
    numbers = {
        "expected_rows": 100, "actual_rows": 100, "failed_rows": 0, "duration_seconds": 60,
        "expected_duration_seconds": 60, "freshness_delay_minutes": 5,
    }
    domain = F.lower("r_name")
    fresh = region.select(
        F.concat(domain, F.lit("_20020101")).alias("run_id"),
        domain.alias("pipeline_name"),
        domain.alias("domain"),
        F.lit("2002-01-01T00:00:00").alias("run_timestamp"),
        *[F.lit(n).cast("bigint").alias(name) for name, n in numbers.items()],
        F.lit("none").alias("schema_drift"),
        F.lit("healthy").alias("status"),
        F.lit(None).cast("string").alias("error_message"),
    )
    return corrected.unionByName(fresh)


def broken_lines(lineitem: DataFrame) -> DataFrame:
    """Lines of which some name no supplier and some an unknown one."""
    key = F.when(F.col("l_quantity") == 11, F.lit(-1).cast("bigint")).when(F.col("l_quantity") != 7, F.col("l_suppkey"))
    return lineitem.withColumn("l_suppkey", key)
