"""Measurement operators over runs."""

from pyspark.sql import DataFrame

from runlens.functions.metrics import flag_columns, ratios
from runlens.functions.numeric import with_ratios
from runlens.schemas import EXTRACT_COLUMNS, RECORD_COLUMNS


def with_metrics(runs: DataFrame) -> DataFrame:
    """All source columns followed by the six metric columns; no shuffle and no Python worker."""
    return with_ratios(runs, ratios()).select("*", *flag_columns())


def decision_extract(metrics: DataFrame) -> DataFrame:
    """The ten columns a labeller may see."""
    return metrics.select(*EXTRACT_COLUMNS)


def metric_record(metrics: DataFrame) -> DataFrame:
    """The eleven-field metric record: the extract plus the drift flag."""
    return metrics.select(*RECORD_COLUMNS)


