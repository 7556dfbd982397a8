"""The one-to-one contract between runs and decisions.

Both sides are counted per run_id in a single grouped pass over their union: one shuffle with
map-side combine, so neither a repeated id nor a null id can grow beyond one row per map task, and
only counters reach the driver.
"""

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.schemas import CONFIDENCE, DECISION, LABELS
from runlens.sources.staging import stage


class ContractError(ValueError):
    """Runs and decisions do not match one to one, or a label is outside the vocabulary."""


def key_status(metrics: DataFrame, decisions: DataFrame) -> DataFrame:
    """Per run_id: rows on either side and rows with a label outside the vocabulary.

    A null run_id identifies nothing, so it never counts as matched.
    """
    allowed = F.coalesce(F.col("decision").isin(LABELS), F.lit(False))
    ours = metrics.select("run_id", F.lit(1).alias("m"), F.lit(0).alias("d"), F.lit(0).alias("b"))
    theirs = decisions.select(
        "run_id", F.lit(0).alias("m"), F.lit(1).alias("d"), (~allowed).cast("int").alias("b")
    )
    counted = ours.unionAll(theirs).groupBy("run_id").agg(
        F.sum("m").alias("source_rows"),
        F.sum("d").alias("decision_rows"),
        F.sum("b").alias("bad_label_rows"),
    )
    known = F.col("run_id").isNotNull()
    in_source, in_decisions = F.col("source_rows") > 0, F.col("decision_rows") > 0
    return counted.select(
        "*",
        (in_source & ~(in_decisions & known)).alias("is_missing"),
        (in_decisions & ~(in_source & known)).alias("is_extra"),
        (F.col("decision_rows") > 1).alias("is_duplicate"),
        (F.col("source_rows") > 1).alias("is_source_duplicate"),
    )


def coverage_report(metrics: DataFrame, decisions: DataFrame) -> DataFrame:
    """One row of counters; a clean contract has zeros in every ``*_ids`` and ``bad_labels``."""
    return key_status(metrics, decisions).agg(
        F.coalesce(F.sum("source_rows"), F.lit(0)).alias("source_runs"),
        F.coalesce(F.sum("decision_rows"), F.lit(0)).alias("decisions"),
        F.count_if("is_missing").alias("missing_ids"),
        F.count_if("is_extra").alias("extra_ids"),
        F.count_if("is_duplicate").alias("duplicate_ids"),
        F.count_if("is_source_duplicate").alias("source_duplicate_ids"),
        F.coalesce(F.sum("bad_label_rows"), F.lit(0)).alias("bad_labels"),
    )


def coverage_violations(metrics: DataFrame, decisions: DataFrame) -> DataFrame:
    """Every offending key with what is wrong with it: (run_id, violation), all of them."""
    found = F.array(
        F.when(F.col("is_missing"), "missing"),
        F.when(F.col("is_extra"), "extra"),
        F.when(F.col("is_duplicate"), "duplicate"),
        F.when(F.col("is_source_duplicate"), "source_duplicate"),
        F.when(F.col("bad_label_rows") > 0, "bad_label"),
    )
    offending = key_status(metrics, decisions).where(
        "is_missing OR is_extra OR is_duplicate OR is_source_duplicate OR bad_label_rows > 0"
    )
    return offending.select("run_id", F.explode(F.array_compact(found)).alias("violation"))


def check_contract(metrics: DataFrame, decisions: DataFrame, violations: str | None = None) -> int:
    """Raise :class:`ContractError` unless every run has exactly one allowed decision.

    This is an action; run it over written tables, so that what was checked is what gets joined.
    Coverage is judged before labels. The message carries exact counts and names a folder that holds
    every offending key with its violation: ``violations``, or a new one below the warehouse's
    ``_violations``. Returns the number of runs.
    """
    row = coverage_report(metrics, decisions).first()
    counts = {
        "missing": row.missing_ids,
        "extra": row.extra_ids,
        "duplicate": row.duplicate_ids,
        "source_duplicate": row.source_duplicate_ids,
    }
    if any(counts.values()):
        folder = _written_violations(metrics, decisions, violations)
        raise ContractError(f"runs and labels are not one to one: {_listed(counts)}; all keys in {folder}")
    if row.bad_labels:
        folder = _written_violations(metrics, decisions, violations)
        raise ContractError(f"{row.bad_labels} rows carry a label that is not allowed; all keys in {folder}")
    return row.source_runs


def _listed(counts: dict[str, int]) -> str:
    return ", ".join(f"{name}={n}" for name, n in counts.items())


def _written_violations(metrics: DataFrame, decisions: DataFrame, path: str | None) -> str:
    spark = metrics.sparkSession
    if path is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        path = f"{warehouse}/_violations/{uuid.uuid4().hex}"
    coverage_violations(metrics, decisions).write.mode("overwrite").parquet(path)
    return path


def join_final(metrics: DataFrame, decisions: DataFrame) -> DataFrame:
    """Measurement and judgment on one row, run_id first; assumes a checked contract."""
    labels = decisions.select(
        "run_id",
        F.col("decision").alias(DECISION),
        F.col("confidence").cast("double").alias(CONFIDENCE),
    )
    return metrics.join(labels, "run_id")


def build_final(metrics: DataFrame, decisions: DataFrame, violations: str | None = None) -> DataFrame:
    """Check, then join: fails closed before anything can be written."""
    check_contract(metrics, decisions, violations)
    return join_final(metrics, decisions)


def quarantine_final(metrics: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Opt-in alternative to failing: the final rows of the runs that keep the contract, and the
    violations of all others.

    The offending keys are written out first, when this is called. Few keys then make a broadcast that spares both sides
    a shuffle, and many keys a join whose hot partitions the engine can split.
    """
    violations = stage(coverage_violations(metrics, decisions), "violations")
    offending = violations.where(F.col("run_id").isNotNull()).select("run_id").distinct()
    kept_runs = metrics.join(offending, "run_id", "left_anti")
    kept_labels = decisions.join(offending, "run_id", "left_anti")
    return join_final(kept_runs, kept_labels), violations


def duplicate_runs(runs: DataFrame) -> DataFrame:
    """Keys that occur more than once in the source: (run_id, copies)."""
    return runs.groupBy("run_id").agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def check_source_keys(runs: DataFrame) -> int:
    """Raise unless run_id is unique; returns the number of rows. One grouped pass."""
    row = (
        runs.groupBy("run_id")
        .agg(F.count("*").alias("copies"))
        .agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("total"), F.count("*").alias("distinct"))
        .first()
    )
    if row.total != row["distinct"]:
        raise ContractError(
            f"run_id is not unique in the source: {row.total} rows, {row['distinct']} ids"
        )
    return row.total


def rename_judgment(final: DataFrame, decision: str, confidence: str) -> DataFrame:
    """The final table under other names for the judgment columns, for SQL written against them."""
    return final.withColumnsRenamed({DECISION: decision, CONFIDENCE: confidence})
