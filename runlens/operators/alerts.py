"""Alert rows. Data only; delivering them is up to the caller."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from runlens.operators.ordered import number_within, previous_within
from runlens.functions.text import run_date, run_key
from runlens.schemas import DECISION, LABELS
from runlens.sources import layout, writers
from runlens.sources.staging import stage

PREVIOUS = "previous_decision"
COLUMNS = ["run_id", "pipeline_name", "domain", "run_timestamp", DECISION]
_ALERTS = ", ".join(f"{c} string" for c in [*COLUMNS, PREVIOUS, "alert"])
_MARKS = (f"pipeline_name string, month date, last struct<run_timestamp: string, run_id: string, {DECISION}: string>, "
          f"first struct<run_timestamp: string, run_id: string, domain: string, {DECISION}: string>")


def _severity(label: Column) -> Column:
    return F.array_position(F.array(*[F.lit(name) for name in LABELS]), label)


def alert_rows(final: DataFrame) -> DataFrame:
    """Runs that became BLOCK, or got a worse label than the run before of the same upstream
    pipeline. A first run alerts only if it is BLOCK. Writes an ordered copy when called; see
    :func:`runlens.sources.staging.released`."""
    return _judged(previous_within(
        final.select(*COLUMNS), "pipeline_name", ["run_timestamp", "run_id"], F.col(DECISION), PREVIOUS))


def _judged(history: DataFrame, *more: str) -> DataFrame:
    """The rows that alert, out of rows with the label of the run before."""
    blocked = (F.col(DECISION) == "BLOCK") & ~F.col(PREVIOUS).eqNullSafe("BLOCK")
    worse = _severity(F.col(DECISION)) > _severity(F.col(PREVIOUS))
    alert = F.when(blocked, "NEWLY_BLOCKED").when(worse, "WORSENED")
    return history.select(*COLUMNS, PREVIOUS, alert.alias("alert"), *more).where(F.col("alert").isNotNull())


def _next_state(spark: SparkSession, table: str, changed: DataFrame, before: str | None, place: str) -> None:
    """Write the alerts within months, and the marks of months, after ``changed``, of which those that no change
    touched are taken over from ``before``."""
    month = F.trunc(run_date(F.col("run_timestamp")), "month")
    spans = stage(changed.select("pipeline_name", month.alias("month")).distinct(), "spans")

    def touched(rows: DataFrame, kind: str) -> DataFrame:
        span = spans.select(F.col("pipeline_name").alias("__pipeline"), F.col("month").alias("__month"))
        same = F.col("pipeline_name").eqNullSafe(F.col("__pipeline")) & (F.col("month") == F.col("__month"))
        return rows.join(span, same, kind)

    if before is None:  # all rows of the table are changes
        rows = layout.read_partitioned(spark, table).select(*COLUMNS, month.alias("month"))
    else:
        read = layout.read_months(spark, table, spans.select("month").distinct())
        rows = touched(read.select(*COLUMNS, month.alias("month")), "left_semi")
    rows = stage(rows, "touched-runs")  # the sort reads them twice, the marks once
    seen = previous_within(rows.withColumn("__span", F.struct("pipeline_name", "month")), "__span",
                           ["run_timestamp", "run_id"], F.struct(DECISION), "__before")
    # the run before the first one of a month is in another month; its mark tells
    within = _judged(seen.where("__before IS NOT NULL").withColumn(PREVIOUS, F.col("__before")[DECISION]), "month")
    marks = rows.groupBy("pipeline_name", "month").agg(
        F.max(F.struct("run_timestamp", "run_id", DECISION)).alias("last"),
        F.min(F.struct("run_timestamp", "run_id", "domain", DECISION)).alias("first"))
    if before is not None:
        within = within.unionByName(touched(spark.read.schema(f"{_ALERTS}, month date").parquet(f"{before}/within"), "left_anti"))
        marks = marks.unionByName(touched(spark.read.schema(_MARKS).parquet(f"{before}/marks"), "left_anti"))
    with writers.Outputs(spark) as outputs:
        new = outputs.at(place)
        within.write.parquet(f"{new}/within")
        marks.write.parquet(f"{new}/marks")


def kept_alerts(spark: SparkSession, table: str, kept: str) -> DataFrame:
    """The alerts of a merged table of labelled runs, equal to :func:`alert_rows` of all its rows, kept up to date below
    ``kept`` by the table's changes: corrections, runs that come late, and runs that go or move.

    Whether a run alerts depends on its label and that of the run before. So a change concerns alerts of its
    pipeline's month, which is read again, and of the first run of the pipeline's next month with runs. That one is told
    by marks: the first and last run of each pipeline and month, one small row each. Months without changes are not
    read. A state is written beside the others and renamed into place; without new merges nothing is written."""
    numbers = layout.published(spark, kept)
    place = f"{kept}/states/{numbers[-1]:012d}" if numbers else None
    changed, last = layout.changes(spark, table, numbers[-1] if numbers else 0)
    if changed is not None:
        before, place = place, f"{kept}/states/{last:012d}"
        _next_state(spark, table, changed, before, place)
    if place is None:
        return spark.createDataFrame([], _ALERTS)
    months = Window.partitionBy("pipeline_name").orderBy("month")
    marks = spark.read.schema(_MARKS).parquet(f"{place}/marks").withColumn(
        PREVIOUS, F.lag(f"last.{DECISION}").over(months))
    first = [c if c == "pipeline_name" else F.col(f"first.{c}").alias(c) for c in COLUMNS]
    within = spark.read.schema(f"{_ALERTS}, month date").parquet(f"{place}/within").drop("month")
    return within.unionByName(_judged(marks.select(*first, PREVIOUS)))


def run_ordinal(runs: DataFrame) -> DataFrame:
    """Zero-based position of each run within its upstream pipeline, and the key built from it. Writes an
    ordered copy when called."""
    columns = ["run_id", "pipeline_name", "run_timestamp"]
    numbered = number_within(
        runs.select(*columns), "pipeline_name", ["run_timestamp", "run_id"], "run_ordinal"
    )
    key = run_key(F.col("pipeline_name"), run_date(F.col("run_timestamp")), F.col("run_ordinal"))
    return numbered.select(*columns, "run_ordinal", key.alias("run_key"))
