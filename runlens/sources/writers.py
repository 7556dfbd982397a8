"""Sinks. Every write is distributed; row counts come from the write itself, without a second scan."""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from runlens.functions.text import python_text
from runlens.operators.measure import decision_extract
from runlens.operators.reports import dashboard_extract
from runlens.schemas import DECISIONS
from runlens.sources.staging import remove_folder


class Outputs:
    """Outputs of a job that appear together, once all are written and checked.

    ``at(path)`` names a folder beside ``path`` to write to. A successful end renames each into place,
    keeping what was there until the last rename is done; a failure at any time leaves, or puts
    back, what was there. Only between two renames of the file system is a path missing.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.pending = spark, {}

    def at(self, path: str) -> str:
        path = path.rstrip("/")
        folder, _, name = path.rpartition("/")
        self.pending[path] = f"{folder or '.'}/_new-{uuid.uuid4().hex}-{name}"
        return self.pending[path]

    def __enter__(self) -> "Outputs":
        return self

    def __exit__(self, kind, *error: object) -> None:
        try:
            if kind is None:
                self._publish()
        finally:
            for beside in self.pending.values():
                remove_folder(self.spark, beside)

    def _publish(self) -> None:
        Path = self.spark._jvm.org.apache.hadoop.fs.Path
        moved: list[tuple[str, str]] = []  # (from, to), to be undone backwards

        def move(source: str, target: str) -> None:
            fs = Path(target).getFileSystem(self.spark._jsc.hadoopConfiguration())
            if not fs.rename(Path(source), Path(target)):
                raise OSError(f"cannot rename {source} to {target}")
            moved.append((source, target))

        old = []
        try:
            for path, beside in self.pending.items():
                fs = Path(path).getFileSystem(self.spark._jsc.hadoopConfiguration())
                if fs.exists(Path(path)):
                    old.append(beside.replace("/_new-", "/_old-"))
                    move(path, old[-1])
                move(beside, path)
        except Exception:
            for source, target in reversed(list(moved)):
                move(target, source)
            raise
        for path in old:
            remove_folder(self.spark, path)


def _counted(df: DataFrame, write: Callable[[DataFrameWriter], None]) -> int:
    seen = Observation()
    write(df.observe(seen, F.count("*").alias("rows")).write.mode("overwrite"))
    return seen.get["rows"]


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Overwrite the table at ``path``; returns the row count."""
    return _counted(df, lambda w: w.format(fmt).save(path))


def save_table(df: DataFrame, name: str, fmt: str = "parquet", buckets: int = 0) -> int:
    """Overwrite a catalog table. ``buckets`` > 0 buckets and sorts it by run_id, so that the join of
    two such tables and a grouping by run_id need no shuffle."""

    def write(w: DataFrameWriter) -> None:
        w = w.format(fmt)
        (w.bucketBy(buckets, "run_id").sortBy("run_id") if buckets else w).saveAsTable(name)

    return _counted(df, write)


def publish_table(df: DataFrame, name: str, folder: str) -> int:
    """Write a new version below ``folder``, then point the view ``name`` at it. Readers see the old
    version or the new one, never a part; old versions stay until the caller removes them."""
    path = f"{folder.rstrip('/')}/version={uuid.uuid4().hex}"
    rows = write_table(df, path)
    df.sparkSession.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{path}`")
    return rows


def export_extract(metrics: DataFrame, path: str) -> int:
    """The labeller's input as JSON Lines by run_id, nulls kept; returns the row count."""
    rows = decision_extract(metrics).orderBy("run_id")
    return _counted(rows, lambda w: w.option("ignoreNullFields", False).json(path))


def write_decisions(decisions: DataFrame, path: str) -> int:
    """Labels as JSON Lines, nulls kept."""
    rows = decisions.select(*DECISIONS.fieldNames())
    return _counted(rows, lambda w: w.option("ignoreNullFields", False).json(path))


def write_meta(meta: DataFrame, path: str) -> None:
    """The one-row provenance table as JSON."""
    meta.write.mode("overwrite").json(path)


def final_export(final: DataFrame) -> DataFrame:
    """The final table in export order: a range sort, so part files follow each other."""
    return final.orderBy("run_id")


def write_csv(rows: DataFrame, path: str) -> int:
    """CSV with header: quotes doubled inside quotes, blanks kept, null as an empty field."""
    return _counted(
        rows,
        lambda w: w.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path),
    )


def export_final_csv(final: DataFrame, path: str, as_python: bool = False) -> int:
    """The final table as CSV by run_id. ``as_python`` writes booleans and doubles the way Python
    prints them; the default is Spark's text, which casts back the same."""
    rows = final_export(final)
    return write_csv(python_text(rows) if as_python else rows, path)


def export_dashboard(final: DataFrame, path: str) -> int:
    """The dashboard's ten columns as JSON Lines by run_id, nulls kept."""
    rows = dashboard_extract(final)
    return _counted(rows, lambda w: w.option("ignoreNullFields", False).json(path))
