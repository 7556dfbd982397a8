"""Tables of runs by domain and run date, merged so that a failure at any step loses no stored row.

    data/version=V/domain=D/run_date=R/    run files, written once and never changed
    changes/version=V/                     what the merge changed, as signed rows: -1 gone, +1 come
    states/N/                              where the rows of every partition are

A merge writes the partitions it touches as a new version, its changes, and then the next state, which is
renamed into place. Readers take the newest state, so they see a merge as a whole or not at all. What a
failed merge left is named by no state; a merge that is run again changes nothing, since a run that is
stored already is no change. There is one writer at a time: a second one finds its state's place taken
and fails. :func:`vacuum` removes what no state names any more.

Merges find stored runs by key. Run files carry bloom filters of run_id, and the keys of a batch of up to
``PUSHED_KEYS`` are pushed to the scan, so row groups without them are not read; larger batches read the key column.
"""

import json
import uuid
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.functions.text import run_date
from runlens.operators.contract import ContractError
from runlens.operators.upsert import latest_runs
from runlens.sources.staging import stage

PARTITIONS = ["domain", "run_date"]
#: Batches of so many keys look them up by bloom filter.
PUSHED_KEYS = 1000
#: Partitions named in a scan's filter; a scan of more joins them instead.
LISTED_PARTITIONS = 10_000
#: A batch of at least one in so many of the stored rows is compared with all of them, without looking up its keys first.
WHOLE = 4
#: Rows of one file; a partition of more has several.
FILE_ROWS = 2_000_000
SIGN = "sign"
_IN = 10  # values of one list that a Parquet scan tests one by one, rather than by their range
_STATE = "kind string, number long, domain string, run_date date, version string, rows long, schema string"
_BLOOM = {"parquet.bloom.filter.enabled#run_id": "true", "parquet.bloom.filter.adaptive.enabled": "true"}


def with_run_date(runs: DataFrame) -> DataFrame:
    return runs.withColumn("run_date", run_date(F.col("run_timestamp")))


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def published(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the states of the table at ``path``, ascending; none if there is no table."""
    fs, folder = _file_system(spark, f"{path}/states")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n) for n in names if n.isdigit())


def state(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest state: a row per partition with its version, and one per merge so far."""
    numbers = published(spark, path)
    return spark.read.schema(_STATE).parquet(f"{path}/states/{numbers[-1]:012d}") if numbers else None


def _publish(spark: SparkSession, path: str, number: int, rows: DataFrame) -> None:
    new, place = f"{path}/states/_new-{uuid.uuid4().hex}", f"{path}/states/{number:012d}"
    rows.coalesce(1).write.parquet(new)
    fs, target = _file_system(spark, place)
    if fs.exists(target) or not fs.rename(_file_system(spark, new)[1], target):
        raise ContractError(f"state {number} of {path} has been taken by another writer")


def _partitions(now: DataFrame) -> DataFrame:
    return now.where("kind = 'partition'").select("version", *PARTITIONS)


def _data(spark: SparkSession, path: str, now: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """The rows of the partitions of a state, or of those that ``wanted`` (domain, run_date) names, read by
    filters on partition columns, so that other folders are not."""
    schema = T.StructType.fromJson(json.loads(now.where("kind = 'merge'").first().schema))
    files = T.StructType([*[f for f in schema if f.name not in PARTITIONS], T.StructField("version", T.StringType()),
                          T.StructField("domain", T.StringType()), T.StructField("run_date", T.DateType())])
    names = [*schema.names, *[c for c in PARTITIONS if c not in schema.names]]
    places = _partitions(now)
    if wanted is not None:
        places = places.join(wanted, PARTITIONS, "left_semi")
    rows = spark.read.schema(files).parquet(f"{path}/data")
    listed = places.limit(LISTED_PARTITIONS + 1).collect()
    if len(listed) > LISTED_PARTITIONS:
        return rows.join(places, ["version", *PARTITIONS], "left_semi").select(*names)
    if not listed:
        return spark.createDataFrame([], rows.schema).select(*names)
    place = F.concat_ws("/", "version", "domain", F.col("run_date").cast("string"))
    here = place.isin([f"{p.version}/{p.domain}/{p.run_date}" for p in listed])
    days = F.col("run_date").between(F.lit(min(p.run_date for p in listed)), F.lit(max(p.run_date for p in listed)))
    domains = F.col("domain").isin(sorted({p.domain for p in listed}))
    return rows.where(domains & days & here).select(*names)


def read_partitioned(
    spark: SparkSession, path: str, domain: str | None = None,
    since: str | None = None, before: str | None = None,
) -> DataFrame:
    """Rows of one domain and of run dates in [since, before). Partitions are chosen from the state, so
    only their folders are read."""
    now = state(spark, path)
    if now is None:
        raise ContractError(f"no table at {path}")
    wanted = _partitions(now).select(*PARTITIONS)
    if domain is not None:
        wanted = wanted.where(F.col("domain") == domain)
    if since is not None:
        wanted = wanted.where(F.col("run_date") >= F.lit(since).cast("date"))
    if before is not None:
        wanted = wanted.where(F.col("run_date") < F.lit(before).cast("date"))
    return _data(spark, path, now, wanted)


def read_months(spark: SparkSession, path: str, months: DataFrame) -> DataFrame:
    """Rows of the months whose first days ``months`` (month) holds; only the folders of these are read."""
    now = state(spark, path)
    if now is None:
        raise ContractError(f"no table at {path}")
    wanted = _partitions(now).withColumn("month", F.trunc("run_date", "month")).join(months, "month", "left_semi")
    return _data(spark, path, now, wanted.select(*PARTITIONS))


def _counted(rows: DataFrame) -> DataFrame:
    """(domain, run_date, rows, changed) of rows with a sign, written: how many rows a partition has after the merge,
    and how many came or went."""
    return stage(rows.groupBy(*PARTITIONS).agg(
        F.count_if(F.col(SIGN) >= 0).alias("rows"), F.count_if(F.col(SIGN) != 0).alias("changed")), "partition-rows")


def _write_version(rows: DataFrame, counts: DataFrame, path: str, version: str) -> None:
    # a partition goes to one task, which writes one file, or if it has many rows to several; by a number of tasks
    # that is not reduced to the few that so little data would get, since every file takes its time
    salt = F.pmod(F.xxhash64("run_id"), F.ceil(F.col("rows") / FILE_ROWS))
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid_out = rows.join(counts, PARTITIONS).withColumns({"version": F.lit(version), "__salt": salt}).repartition(
        tasks, *[F.col(c) for c in PARTITIONS], "__salt")
    laid_out.drop("rows", "__salt").write.mode("append").options(**_BLOOM).partitionBy("version", *PARTITIONS).parquet(
        f"{path}/data")


def _write_changes(rows: DataFrame, path: str, version: str) -> None:
    rows.write.parquet(f"{path}/changes/version={version}")


def _in_order(rows: DataFrame, names: list[str]) -> DataFrame:
    return rows.select(*names, *[c for c in PARTITIONS if c not in names])


def _checked(batch: DataFrame) -> DataFrame:
    """The written batch, empty or not; refused if a run has no place."""
    unplaced = F.count_if(reduce(or_, (F.col(c).isNull() for c in PARTITIONS)))
    if batch.agg(unplaced.alias("n")).first().n:
        raise ContractError("batch has runs without a domain or a valid run date")
    return batch


def _next(spark: SparkSession, path: str, names: list[str], counts: DataFrame, kept: DataFrame | None,
          history: DataFrame | None, rows: DataFrame, changes: DataFrame, schema: T.StructType) -> int:
    """Write a version of ``rows``, those of the partitions that ``counts`` names, and publish it beside the
    partitions ``kept``."""
    number = (published(spark, path) or [0])[-1] + 1
    version = f"v{number:012d}-{uuid.uuid4().hex}"
    counts = counts.where("rows > 0").select(*PARTITIONS, "rows")
    _write_version(_in_order(rows, names), counts, path, version)
    _write_changes(changes, path, version)
    written = counts.select(
        F.lit("partition").alias("kind"), F.lit(number).cast("long").alias("number"), *PARTITIONS,
        F.lit(version).alias("version"), "rows", F.lit(None).cast("string").alias("schema"))
    merge = spark.createDataFrame([("merge", number, None, None, version, None, schema.json())], _STATE)
    parts = [part.select(*merge.columns) for part in (kept, history, written, merge) if part is not None]
    _publish(spark, path, number, reduce(DataFrame.unionByName, parts))
    return number


def write_partitioned(runs: DataFrame, path: str) -> int:
    """Replace the whole table at ``path``, or create it; returns the number of the new state."""
    spark = runs.sparkSession
    rows = _checked(stage(with_run_date(runs), "rows"))
    now = state(spark, path)
    come = rows.withColumn(SIGN, F.lit(1))
    changes = come
    if now is not None:
        gone = _in_order(_data(spark, path, now), runs.columns).withColumn(SIGN, F.lit(-1))
        changes = gone.unionByName(come)
    return _next(spark, path, runs.columns, _counted(come), None, now.where("kind = 'merge'") if now is not None else None,
                 rows, changes, runs.schema)


def _has_key(keys: DataFrame) -> Column | None:
    """A filter by the keys that a scan can test on bloom filters; None if there are too many."""
    found = [r.run_id for r in keys.limit(PUSHED_KEYS + 1).collect()]
    if len(found) > PUSHED_KEYS:
        return None
    lists = [found[i : i + _IN] for i in range(0, len(found), _IN)]
    return reduce(or_, (F.col("run_id").isin(part) for part in lists))


def stored_places(existing: DataFrame, keys: DataFrame) -> DataFrame:
    """(domain, run_date) of the partitions that hold one of the ``keys``."""
    pushed = _has_key(keys)
    found = existing.join(keys, "run_id", "left_semi") if pushed is None else existing.where(pushed)
    return found.select(*PARTITIONS).distinct()


def _batch(versions: DataFrame, arrival: str) -> DataFrame:
    """The written batch, one row per run_id. Most batches name a run once: what tells is a count by key, and only
    if it finds a repeated one, whole rows are moved and sorted by key."""
    written = stage(versions, "versions")
    newest = latest_runs(written, arrival)
    most = written.groupBy("run_id").agg(F.count("*").alias("n")).agg(F.max("n").alias("n")).first().n
    return stage(newest.drop(arrival), "batch") if (most or 0) > 1 else written.drop(arrival)


def _compared(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows of stored partitions and of a batch with a sign: -1 a stored row that is replaced, 0 one that stays, 1 a row
    of the batch that is no stored one, once per stored row of its run that differs. They meet in one exchange by key;
    a run without id equals no other."""
    columns = sorted(batch.columns)
    both = stored.select(*columns, F.lit(False).alias("__new")).unionByName(batch.select(*columns, F.lit(True).alias("__new")))
    new, row = F.col("__new"), F.struct(*columns)
    run = Window.partitionBy("run_id", "__apart")  # by columns, so that both windows share the exchange
    met = both.withColumn("__apart", F.when(F.col("run_id").isNull(), new)).withColumns({
        "__row": F.max(F.when(new, row)).over(run), "__stored": F.count_if(~new).over(run)})
    differs = ~new & F.col("__row").isNotNull() & ~row.eqNullSafe(F.col("__row"))
    told = met.withColumn("__differ", F.count_if(differs).over(run)).drop("__row")
    sign = F.when(new, 1).when(F.col("__differ") > 0, -1).otherwise(0)
    times = F.when(new & (F.col("__stored") > 0), F.col("__differ")).otherwise(1).cast("int")
    signed = told.select(*batch.columns, sign.alias(SIGN), times.alias("__times")).where("__times > 0")
    return signed.withColumn("__times", F.explode(F.array_repeat(F.lit(1), F.col("__times")))).drop("__times")


def load_partitioned(spark: SparkSession, path: str, incoming: DataFrame, arrival: str | None = None) -> int | None:
    """Merge a batch into the table at ``path``, which the first batch creates: the rows of the batch, one per
    run_id, replace stored rows of the same run_id, also where these are in another partition. Of several
    rows of a run the one with the greatest ``arrival`` counts, or of equal ones the greatest values. Returns
    the number of the new state; None if the batch changes nothing."""
    versions = with_run_date(incoming)
    if arrival is None:
        versions, arrival = versions.withColumn("__arrival", F.lit(0)), "__arrival"
    batch = _checked(_batch(versions, arrival))
    names = [c for c in incoming.columns if c != arrival]
    schema = incoming.select(*names).schema
    if not batch.take(1):
        return None
    come = batch.withColumn(SIGN, F.lit(1))
    now = state(spark, path)
    if now is None:
        return _next(spark, path, names, _counted(come), None, None, batch, come, schema)
    held = now.where("kind = 'partition'").agg(F.sum("rows")).first()[0] or 0
    existing, keys = _data(spark, path, now), batch.select("run_id")
    size = keys.count()
    if size > PUSHED_KEYS and size * WHOLE >= held:  # most partitions hold one of its runs: all are read once, not keys first
        merged = stage(_compared(existing, batch), "merged")
    else:
        found = stage(stored_places(existing, keys), "found")
        stored = _data(spark, path, now, batch.select(*PARTITIONS).union(found).distinct())
        merged = stage(_compared(stored, batch), "merged") if found.take(1) else stored.withColumn(
            SIGN, F.lit(0)).unionByName(come)  # no run of the batch is stored
    counts = _counted(merged).where("changed > 0")
    if not counts.take(1):
        return None
    kept = now.where("kind = 'partition'").join(counts, PARTITIONS, "left_anti")
    return _next(spark, path, names, counts, kept, now.where("kind = 'merge'"), merged.where(F.col(SIGN) >= 0),
                 merged.where(F.col(SIGN) != 0), schema)


def upsert_partitioned(spark: SparkSession, path: str, incoming: DataFrame) -> int | None:
    """Merge a batch into the table that is at ``path``."""
    if not published(spark, path):
        raise ContractError(f"no table at {path}")
    return load_partitioned(spark, path, incoming)


def changes(spark: SparkSession, path: str, after: int = 0) -> tuple[DataFrame | None, int]:
    """Signed rows of all merges after number ``after``, and the number of the last one. Summed by sign
    they lead from the table as it was then to the table as it is; None if there is no change."""
    now = state(spark, path)
    if now is None:
        return None, 0
    merges = now.where("kind = 'merge'").select("number", "version").orderBy("number").collect()
    versions = [m.version for m in merges if m.number > after]
    last = max(m.number for m in merges)
    if not versions:
        return None, last
    rows = reduce(DataFrame.unionByName, (spark.read.parquet(f"{path}/changes/version={v}") for v in versions))
    return rows, last


def vacuum(spark: SparkSession, path: str, states: int = 10) -> None:
    """Remove all but the newest ``states`` states, versions of the data that none of these names, and what
    failed merges left. Not while a merge runs, nor while readers hold an older state."""
    fs, folder = _file_system(spark, f"{path}/states")
    numbers = published(spark, path)[-states:]
    if not numbers:
        return
    keep = {f"{n:012d}" for n in numbers}
    held = spark.read.schema(_STATE).parquet(*[f"{path}/states/{n}" for n in sorted(keep)])
    used = {r.version for r in held.where("kind = 'partition'").select("version").distinct().collect()}
    merged = {r.version for r in held.where("kind = 'merge'").select("version").distinct().collect()}
    for place, names in ((folder, keep), (_file_system(spark, f"{path}/data")[1], {f"version={v}" for v in used}),
                         (_file_system(spark, f"{path}/changes")[1], {f"version={v}" for v in merged})):
        for status in fs.listStatus(place):
            if status.isDirectory() and status.getPath().getName() not in names:
                fs.delete(status.getPath(), True)
