"""Totals that follow a merged table by its signed changes, without reading the table again.

A fold holds sums by group and the number of the merge up to which they count. It is brought up to date by
adding the signed sums of later merges: corrections and moved runs take their old rows out and put the new
ones in. Each state of a fold is written beside the others and renamed into place, so a failure leaves the
one before, and a run without new merges changes nothing.
"""

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.functions.numeric import micros, round_exact
from runlens.operators import provenance
from runlens.sources import layout, writers

Sums = Callable[[DataFrame], DataFrame]


def _folded(spark: SparkSession, out: str) -> tuple[DataFrame | None, int]:
    numbers = layout.published(spark, out)
    if not numbers:
        return None, 0
    return spark.read.parquet(f"{out}/states/{numbers[-1]:012d}"), numbers[-1]


def fold(spark: SparkSession, table: str, out: str, keys: list[str], sums: Sums) -> DataFrame | None:
    """Bring the totals below ``out`` up to date with the merged table. ``sums`` makes rows of ``keys`` and whole-number
    sums out of signed rows; groups whose sums are all 0 are dropped. None if the table was never written."""
    before, done = _folded(spark, out)
    changes, last = layout.changes(spark, table, done)
    if changes is None:
        return before
    added = sums(changes)
    measures = [c for c in added.columns if c not in keys]
    both = added if before is None else before.unionByName(added)
    totals = both.groupBy(*keys).agg(*[F.sum(m).cast(dict(added.dtypes)[m]).alias(m) for m in measures]).where(
        reduce(or_, (F.col(m) != 0 for m in measures)))
    with writers.Outputs(spark) as outputs:
        totals.write.parquet(outputs.at(f"{out}/states/{last:012d}"))
    return spark.read.schema(totals.schema).parquet(f"{out}/states/{last:012d}")


def _signed(value: Column) -> Column:
    return F.sum(F.col(layout.SIGN) * value)


def daily_sums(changes: DataFrame) -> DataFrame:
    return changes.groupBy(F.col("run_date").cast("string").alias("day"), "domain").agg(
        _signed(F.lit(1)).cast("long").alias("runs"), _signed(micros(F.col("failure_rate"))).alias("rate_micros"))


def daily_health(spark: SparkSession, table: str, out: str) -> DataFrame:
    """(day, domain, runs, mean_failure_rate) of the merged metrics table, its totals kept below ``out``."""
    totals = fold(spark, table, out, ["day", "domain"], daily_sums)
    if totals is None:
        return spark.createDataFrame([], "day string, domain string, runs long, mean_failure_rate double")
    mean = F.col("rate_micros") / F.lit(1e6) / F.col("runs")
    return totals.select("day", "domain", "runs", round_exact(mean).alias("mean_failure_rate"))


def maintained_fingerprint(spark: SparkSession, table: str, out: str, columns: list[str]) -> DataFrame:
    """The fingerprint of ``columns`` of the merged table, equal to :func:`provenance.input_fingerprint` of all
    its rows. Digest sums are kept below ``out``, so only changed rows are digested."""

    def sums(changes: DataFrame) -> DataFrame:
        parts = provenance.digest_parts(changes, columns, layout.SIGN)
        return parts.groupBy("domain").agg(
            F.sum(layout.SIGN).cast("long").alias("row_count"),
            *[F.sum(F.col(layout.SIGN) * F.col(p)).cast("decimal(38,0)").alias(p) for p in provenance.PARTS])

    totals = fold(spark, table, out, ["domain"], sums)
    if totals is None:
        schema = "row_count long, " + ", ".join(f"{p} decimal(38,0)" for p in provenance.PARTS)
        totals = spark.createDataFrame([], schema)
    return provenance.fingerprint_of(totals.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"),
        *[F.coalesce(F.sum(p), F.lit(0).cast("decimal(38,0)")).alias(p) for p in provenance.PARTS]))
