"""Intermediate tables in the folder all executors share.

A written table cuts the lineage durably (a lost executor costs nothing that was written), keeps
column pruning, and gives the optimizer real sizes for its choice of join. Whoever writes such a
table is done with it at some time: :func:`released` and :class:`Scope` remove the folders then.
"""

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_open: list[str] = []  # folders handed out and not removed yet, oldest first
_tables: dict[str, str] = {}  # of these, the catalog names of bucketed ones


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where it is unset, a folder below the warehouse,
    which a cluster shares as well."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staging"
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """An unused path below the shared folder."""
    _open.append(f"{shared_folder(spark)}/runlens/{name}-{uuid.uuid4().hex}")
    return _open[-1]


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return a reader of the written rows."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Like :func:`stage`, in ``buckets`` buckets by ``key``: joins of two such tables, and groupings by
    the key, need no shuffle. Choose as many as shuffle partitions would be needed for the whole table."""
    path = new_folder(df.sparkSession, name)
    _tables[path] = f"staged_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path)
    writer.saveAsTable(_tables[path])
    return df.sparkSession.table(_tables[path])


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder, and the table it may be, through the file system its path names, if it is there."""
    if path in _tables:
        spark.sql(f"DROP TABLE IF EXISTS {_tables.pop(path)}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Removes, at its end, every folder that was staged within it. Evaluate or write what reads them
    inside: ``with released(spark): query(spark, sf_dir).write...``"""
    before = len(_open)
    try:
        yield
    finally:
        for path in _open[before:]:
            remove_folder(spark, path)
        del _open[before:]


class Scope:
    """Staged tables that end together: ``with Scope(spark) as scope: part = scope.stage(df, "part")``.

    Nothing read from a scope may be evaluated after its end; write or stage the result before.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def folder(self, name: str) -> str:
        self.paths.append(new_folder(self.spark, name))
        return self.paths[-1]

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        path = self.folder(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self, path: str) -> None:
        """Remove one of the folders before the end: nothing reads it any more."""
        remove_folder(self.spark, path)
        if path in _open:
            _open.remove(path)
        self.paths.remove(path)

    def close(self) -> None:
        for path in list(self.paths):
            self.remove(path)

    def __enter__(self) -> "Scope":
        return self

    def __exit__(self, *error: object) -> None:
        self.close()
