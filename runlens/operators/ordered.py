"""Per-group order operators that never put one group into one task.

``Window.partitionBy(group)`` sorts a whole group in a single task, which fails when one group holds
a large share of all rows. Here the rows are range-sorted by (group, order) once, so a large group
spans many slices; windows then run per (slice, group), and only one summary row per (slice, group)
crosses slices.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.sources.staging import stage

_SLICE, _POS, _CARRY = "__slice", "__pos", "__carry"
_POS_BITS = 33  # fixed by monotonically_increasing_id: slice number above, row number below


def _sliced(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Range-sorted rows with slice and position, written out so that both stay the same in every
    later use. ``order`` must be total within a group for repeatable results."""
    placed = df.orderBy(group, *order).withColumn(_POS, F.monotonically_increasing_id())
    return stage(placed.withColumn(_SLICE, F.shiftright(_POS, _POS_BITS)), "sliced")


def _join_carry(rows: DataFrame, carry: DataFrame, group: str) -> DataFrame:
    renamed = carry.select(
        F.col(_SLICE).alias("__c_slice"), F.col(group).alias("__c_group"), _CARRY
    )
    return rows.join(
        renamed,
        (F.col(_SLICE) == F.col("__c_slice")) & F.col(group).eqNullSafe(F.col("__c_group")),
        "left",
    ).drop("__c_slice", "__c_group")


def number_within(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """Add ``name``: the zero-based position of each row in its group under ``order``."""
    rows = _sliced(df, group, order)
    earlier = Window.partitionBy(group).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    # a group's rows follow each other within a slice, so positions count them without a window
    carry = (
        rows.groupBy(_SLICE, group)
        .agg(F.count("*").alias("n"), F.min(_POS).alias("first"))
        .withColumn(_CARRY, F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first"))
    )
    numbered = _join_carry(rows, carry, group)
    return numbered.withColumn(name, F.col(_POS) + F.col(_CARRY)).drop(_SLICE, _POS, _CARRY)


def previous_within(
    df: DataFrame, group: str, order: list[str], value: Column, name: str
) -> DataFrame:
    """Add ``name``: ``value`` of the row before, in the same group under ``order``; null on the
    first row of a group."""
    rows = _sliced(df.withColumn("__value", value), group, order)
    local = Window.partitionBy(_SLICE, group).orderBy(_POS)
    last = (
        rows.groupBy(_SLICE, group)
        .agg(F.max_by(F.struct("__value"), _POS).alias("last"))
        .withColumn(_CARRY, F.lag("last").over(Window.partitionBy(group).orderBy(_SLICE)))
        .where(F.col(_CARRY).isNotNull())
    )
    seen = _join_carry(rows.withColumn("__prev", F.lag(F.struct("__value")).over(local)), last, group)
    previous = F.coalesce(F.col("__prev"), F.col(_CARRY))["__value"]
    return seen.withColumn(name, previous).drop(_SLICE, _POS, _CARRY, "__prev", "__value")
