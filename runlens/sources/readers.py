"""Scans. Schemas are fixed, never inferred; formats and paths are the caller's."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from runlens.schemas import DECISIONS, EXTRACT, FINAL, RUNS

CORRUPT = "_corrupt_record"


def load_runs(
    spark: SparkSession, path: str, keep_malformed: bool = False, multi_line: bool = False
) -> DataFrame:
    """Runs from CSV with header, quotes doubled inside quotes. ``keep_malformed`` adds the raw text
    of lines that do not fit the schema as ``_corrupt_record``, for the quarantine split.
    ``multi_line`` allows line breaks inside quotes; such files cannot be split."""
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    if not keep_malformed:
        return reader.schema(RUNS).csv(path)
    schema = T.StructType([*RUNS.fields, T.StructField(CORRUPT, T.StringType())])
    return reader.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).csv(path)


def load_decisions(spark: SparkSession, path: str, array: bool = False) -> DataFrame:
    """Decisions from JSON Lines, or from files holding one JSON array each (``array``); the latter
    cannot be split, so prefer lines for large tables."""
    return spark.read.schema(DECISIONS).option("multiLine", array).json(path)


def load_extract(spark: SparkSession, path: str, array: bool = False) -> DataFrame:
    """The labeller's input from JSON."""
    return spark.read.schema(EXTRACT).option("multiLine", array).json(path)


def load_final_csv(spark: SparkSession, path: str) -> DataFrame:
    """The final table from its portable CSV; empty confidence becomes null."""
    return spark.read.schema(FINAL).option("header", True).option("escape", '"').csv(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A stored table by path. ``fmt`` may name any installed format."""
    return spark.read.format(fmt).load(path)


def use_namespace(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create the database if needed and make it current."""
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{at}")
    spark.catalog.setCurrentDatabase(database)
