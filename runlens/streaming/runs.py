"""Incremental loads. The metric columns are those of the batch path."""

import threading
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from runlens.functions.numeric import micros, round_exact
from runlens.operators import checks
from runlens.operators.measure import with_metrics
from runlens.schemas import RUNS
from runlens.sources import layout
from runlens.sources.staging import released, stage

EVENT_TIME = "event_time"
ARRIVAL = "arrival"


def read_run_stream(
    spark: SparkSession, path: str, fmt: str = "json", files_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """Run files as they arrive below ``path``."""
    reader = spark.readStream.schema(RUNS).format(fmt).options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def with_arrival(runs: DataFrame) -> DataFrame:
    """``runs``, as scanned, with the time and name of the file that each row came in: its place in the
    order of delivery."""
    file = F.struct("_metadata.file_modification_time", "_metadata.file_path")
    return runs.select("*", file.alias(ARRIVAL))


def with_event_time(runs: DataFrame) -> DataFrame:
    """The run timestamp as UTC event time; null where the text is no timestamp."""
    text = F.concat(F.col("run_timestamp"), F.lit("+00:00"))
    return runs.withColumn(EVENT_TIME, text.try_cast("timestamp"))


def split_stream(
    runs: DataFrame, domains: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(valid runs, rejected runs with their reasons), row by row."""
    parts = checks.split_rows(with_event_time(runs), domains, bad_timestamp=_no_time())
    return tuple(part.drop(EVENT_TIME) for part in parts)


def _no_time() -> Column:
    return F.col("run_timestamp").isNotNull() & F.col(EVENT_TIME).isNull()


def _identified(runs: DataFrame, delay: str) -> DataFrame:
    """Runs with event time and watermark. A row without key or time can be neither told from its
    copies nor placed in time, so it fails the query."""
    known = F.col("run_id").isNotNull() & F.col(EVENT_TIME).isNotNull()
    refuse = F.raise_error(F.lit("run without run_id or valid run_timestamp; split the stream first"))
    checked = with_event_time(runs).where(F.when(known, True).otherwise(refuse.cast("boolean")))
    return checked.withWatermark(EVENT_TIME, delay)


def stream_metrics(
    runs: DataFrame, delay: str, spread_by: Column | None = None, spread: int = 16
) -> DataFrame:
    """Metrics of each run once, however often its row arrives within ``delay``. State is kept per
    run_id and dropped as the watermark passes. Rows later than the watermark are dropped and
    counted in the query progress; use a merge (operators.upsert) where the latest row must win.

    All copies of a key meet in one task. Where one key may be delivered very often, ``spread_by``
    names something that differs between its copies, such as the file they came in: copies are then
    first thinned out in up to ``spread`` tasks per key, at the price of a second state store.
    """
    fresh = _identified(runs, delay)
    if spread_by is not None:
        fresh = fresh.withColumn("__salt", F.pmod(F.xxhash64(spread_by), F.lit(spread)))
        fresh = fresh.dropDuplicatesWithinWatermark(["run_id", "__salt"]).drop("__salt")
    once = fresh.dropDuplicatesWithinWatermark(["run_id"])
    return with_metrics(once.select(*RUNS.fieldNames()))


def domain_daily(runs: DataFrame, delay: str) -> DataFrame:
    """Runs and failure rate sum per UTC day and domain. Every row counts, so feed it rows without
    repeated runs, such as the table written by :func:`stream_metrics`. The sum is in whole 1e-6 units, so it does
    not depend on arrival order. Append it to a table for closed days only, or upsert it to see open
    days as well."""
    timed = with_metrics(_identified(runs, delay))
    grouped = timed.groupBy(F.window(EVENT_TIME, "1 day"), "domain").agg(
        F.count("*").alias("runs"), F.sum(micros(F.col("failure_rate"))).alias("rate_micros")
    )
    # days since the epoch, because a cast of the window start would use the session time zone
    days = (F.unix_seconds("window.start") / 86400).cast("int")
    return grouped.select(
        F.date_from_unix_date(days).cast("string").alias("day"), "domain", "runs", "rate_micros"
    )


def append_to_table(
    rows: DataFrame, path: str, checkpoint: str, fmt: str = "parquet"
) -> StreamingQuery:
    """Process everything that has arrived, append it to the table at ``path`` exactly once, stop."""
    return (
        rows.writeStream.outputMode("append").format(fmt).trigger(availableNow=True)
        .option("checkpointLocation", checkpoint).start(path)
    )


class LateRows(StreamingQueryListener):
    """Counts the rows that operators dropped because the watermark had passed them, over every
    micro-batch of the queries that run while it is added to the session:
    ``with LateRows(spark) as late: ...; late.count(query)``."""

    def __init__(self, spark: SparkSession):
        self.spark, self.rows, self.ended, self.lock = spark, {}, set(), threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        dropped = sum(state.numRowsDroppedByWatermark for state in event.progress.stateOperators)
        with self.lock:
            self.rows[event.progress.runId] = self.rows.get(event.progress.runId, 0) + dropped

    def onQueryTerminated(self, event) -> None:
        with self.lock:
            self.ended.add(event.runId)
            self.lock.notify_all()

    def __enter__(self) -> "LateRows":
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error: object) -> None:
        self.spark.streams.removeListener(self)

    def count(self, query: StreamingQuery, patience: float = 60.0) -> int:
        """Rows that a query dropped, once it has ended; events of a query arrive in order, its end last."""
        query.awaitTermination()
        with self.lock:
            if not self.lock.wait_for(lambda: any(str(r) == str(query.runId) for r in self.ended), patience):
                raise TimeoutError(f"no end of query {query.runId} was reported")
            return sum(n for r, n in self.rows.items() if str(r) == str(query.runId))


def merge_to_table(
    runs: DataFrame, path: str, checkpoint: str, quarantine_path: str | None = None,
    domains: list[str] | None = None,
) -> StreamingQuery:
    """Merge every batch of arrived runs, by key, into the partitioned metrics table at ``path``. There
    is no watermark and no state between batches. Where ``runs`` has the column of :func:`with_arrival`, the last
    delivery of a run within a batch counts. The merge of a batch that is run again changes
    nothing, and its rejected rows overwrite their own folder."""
    arrival = ARRIVAL if ARRIVAL in runs.columns else None

    def merge(batch: DataFrame, batch_id: int) -> None:
        with released(batch.sparkSession):
            arrived = stage(batch, "arrived")
            if quarantine_path is not None:
                valid, rejected = split_stream(arrived, domains)
                rejected.drop(ARRIVAL).write.mode("overwrite").parquet(f"{quarantine_path}/batch={batch_id}")
            else:
                checks.check_readable(with_event_time(arrived), domains, bad_timestamp=_no_time())
                valid = arrived
            kept = valid.select(*RUNS.fieldNames(), *([arrival] if arrival else []))
            layout.load_partitioned(batch.sparkSession, path, with_metrics(kept), arrival)

    return (
        runs.writeStream.foreachBatch(merge).trigger(availableNow=True)
        .option("checkpointLocation", checkpoint).start()
    )


def upsert_to_table(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the changed groups of every batch to their own folder below ``path``. A batch that is
    retried overwrites its own folder only."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        rows.writeStream.outputMode("update").foreachBatch(write).trigger(availableNow=True)
        .option("checkpointLocation", checkpoint).start()
    )


def _newest(spark: SparkSession, paths: tuple[str, ...]) -> DataFrame:
    states = reduce(DataFrame.unionByName, (spark.read.parquet(path) for path in paths))
    state = F.max(F.struct("batch", "runs", "rate_micros")).alias("s")
    return states.groupBy("day", "domain").agg(state).select("day", "domain", "s.*")


def read_domain_daily(spark: SparkSession, *paths: str) -> DataFrame:
    """The latest state of every (day, domain) below the folders written by :func:`upsert_to_table`
    or :func:`compact_domain_daily`."""
    mean = F.col("rate_micros") / F.lit(1e6) / F.col("runs")
    return _newest(spark, paths).select(
        "day", "domain", "runs", round_exact(mean).alias("mean_failure_rate")
    )


def compact_domain_daily(spark: SparkSession, out: str, *paths: str) -> None:
    """Write the latest states as one folder. Every state carries its batch, so reading ``out``
    together with the folders it replaces, before they are removed, gives the same rows."""
    _newest(spark, paths).write.mode("overwrite").parquet(out)
