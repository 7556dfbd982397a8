"""Data checks: row expectations, label quality, reconciliation and the quarantine split."""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.functions.numeric import decimal_text
from runlens.operators.contract import ContractError, duplicate_runs
from runlens.operators.measure import decision_extract, with_metrics
from runlens.schemas import (
    ATTENTION, CONFIDENCE, DECISION, DRIFT_KINDS, METRIC_COLUMNS, METRIC_DECIMALS, RUNS, STATUSES,
)
from runlens.sources.readers import CORRUPT
from runlens.sources.staging import stage

REQUIRED = [f.name for f in RUNS.fields if not f.nullable]


def run_rules(domains: list[str] | None = None) -> dict[str, Column]:
    """Rule name -> condition that is true on a violating run.

    A null makes a range rule unknown, not violated; the ``null_*`` rules report it instead.
    """
    expected, failed = F.col("expected_rows"), F.col("failed_rows")
    status, error = F.col("status"), F.coalesce(F.col("error_message"), F.lit(""))
    rules = {f"null_{name}": F.col(name).isNull() for name in REQUIRED}
    rules |= {
        "failed_rows_out_of_range": (failed < 0) | (failed > expected),
        "duration_not_positive": F.col("duration_seconds") <= 0,
        "negative_delay": F.col("freshness_delay_minutes") < 0,
        "failed_with_low_failure_rate": (status == "failed") & (failed * 5 < expected),
        "failed_without_error": (status == "failed") & (error == ""),
        "healthy_with_error": (status == "healthy") & (error != ""),
        "unknown_status": ~status.isin(STATUSES),
        "unknown_drift": ~F.col("schema_drift").isin(DRIFT_KINDS),
    }
    if domains is not None:
        rules["unknown_domain"] = ~F.col("domain").isin(domains)
    return rules


def label_rules() -> dict[str, Column]:
    """Rule name -> condition that is true on a final row whose label contradicts its facts."""
    status = F.col("status")

    def unless(label_condition: Column) -> Column:
        return ~F.coalesce(label_condition, F.lit(False))

    label = F.col(DECISION)
    return {
        "failed_not_blocked": (status == "failed") & unless(label == "BLOCK"),
        "healthy_not_healthy": (status == "healthy") & unless(label == "HEALTHY"),
        "degraded_without_attention": (status == "degraded") & unless(label.isin(ATTENTION)),
        "healthy_label_high_failure_rate": (label == "HEALTHY") & unless(F.col("failure_rate") < 0.01),
        "confidence_out_of_range": ~F.col(CONFIDENCE).between(0.0, 1.0),
    }


def _counted(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, violations): every rule counted in one pass over the rows, without a row shuffle."""
    counts = df.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])
    pairs = [F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in rules]
    return counts.select(F.inline(F.array(*pairs)))


def expectation_report(runs: DataFrame, domains: list[str] | None = None) -> DataFrame:
    """(rule, violations) of the run table. ``duplicate_run_id`` counts keys, all others rows."""
    repeated = duplicate_runs(runs.where(F.col("run_id").isNotNull())).agg(
        F.lit("duplicate_run_id").alias("rule"), F.count("*").alias("violations")
    )
    return _counted(runs, run_rules(domains)).unionByName(repeated)


def label_quality(final: DataFrame) -> DataFrame:
    """(rule, violations) of the labels in the final table."""
    return _counted(final, label_rules())


def _any(rules: dict[str, Column]) -> Column:
    return reduce(or_, (F.coalesce(rule, F.lit(False)) for rule in rules.values()))


def _split(
    df: DataFrame, rules: dict[str, Column], columns: list[str]
) -> tuple[DataFrame, DataFrame]:
    broken = _any(rules)
    reasons = F.array_compact(F.array(*[F.when(rule, name) for name, rule in rules.items()]))
    rejected = df.where(broken).select(*columns, reasons.alias("reasons"))
    return df.where(~broken).select(*columns), rejected


def row_rules(runs: DataFrame, domains: list[str] | None = None) -> dict[str, Column]:
    """:func:`run_rules`, and one for malformed lines if the scan kept them."""
    rules = run_rules(domains)
    if CORRUPT in runs.columns:
        rules["malformed_record"] = F.col(CORRUPT).isNotNull()
    return rules


def split_rows(
    runs: DataFrame, domains: list[str] | None = None, **more: Column
) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected with ``reasons``) by the rules that need only the row itself, and by ``more``
    conditions that are true on a violating row. Works on streams as well."""
    return _split(runs, row_rules(runs, domains) | more, runs.columns)


def _marked(runs: DataFrame) -> DataFrame:
    """Runs with ``copies``, set on every copy of a repeated run_id.

    The repeated keys are written out before the join, so that their real size decides: few are
    broadcast and the runs stay where they are; many are shuffled, in a join whose hot partitions can
    be split.
    """
    known = runs.where(F.col("run_id").isNotNull())
    repeated = stage(duplicate_runs(known), "duplicate-keys")
    return runs.join(repeated, "run_id", "left").select(*runs.columns, "copies")


def quarantine(
    runs: DataFrame, domains: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(valid runs, rejected runs with ``reasons``, the array of rules they violate). Together they
    are exactly the input, which is written once, when this is called, so both are of the same rows.

    All copies of a repeated run_id are rejected: none can be told to be the right one. Reasons are
    put together for rejected rows only; the test all rows pass through is plain generated code.
    """
    rules = row_rules(runs, domains) | {"duplicate_run_id": F.col("copies").isNotNull()}
    marked = stage(_marked(stage(runs, "quarantine-input")), "marked-runs")
    return _split(marked, rules, runs.columns)


def check_readable(runs: DataFrame, domains: list[str] | None = None, **more: Column) -> None:
    """Raise :class:`ContractError` if a line was malformed, a required column is null, given
    ``domains`` a run has another one, or one of ``more`` conditions is true. One pass; the message
    counts every kind."""
    rules = more | {n: c for n, c in row_rules(runs, domains).items()
                    if n.startswith("null_") or n in ("malformed_record", "unknown_domain")}
    found = {r.rule: r.violations for r in _counted(runs, rules).collect() if r.violations}
    if found:
        raise ContractError("unreadable runs: " + ", ".join(f"{n}={k}" for n, k in found.items()))


def _text(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return decimal_text(value + F.lit(0.0), METRIC_DECIMALS)
    return value.cast("string")


def _same(left: Column, right: Column, kind: T.DataType, tolerance: float) -> Column:
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        near = F.coalesce(F.abs(left - right) < tolerance, F.lit(False))
        return near | left.eqNullSafe(right)
    return left.eqNullSafe(right)


def _differences(df: DataFrame, fields: list[tuple[str, Column, Column, T.DataType]],
                 tolerance: float) -> DataFrame:
    """(run_id, field, left_value, right_value) per differing field. Entries are built for differing
    rows only."""
    differs = {name: ~_same(left, right, kind, tolerance) for name, left, right, kind in fields}

    def texts(left: Column, right: Column, kind: T.DataType) -> list[Column]:
        short = [_text(left, kind), _text(right, kind)]
        hidden = short[0].eqNullSafe(short[1])
        return [F.when(hidden, v.cast("string")).otherwise(t).alias(f"{side}_value")
                for v, t, side in zip((left, right), short, ("left", "right"))]

    entries = [
        F.when(
            differs[name],
            F.struct(
                F.lit(name).alias("field"),
                *texts(left, right, kind),
            ),
        )
        for name, left, right, kind in fields
    ]
    found = df.where(_any(differs))
    return found.select("run_id", F.inline(F.array_compact(F.array(*entries))))


def reconcile(
    left: DataFrame, right: DataFrame, columns: list[str], tolerance: float = 1e-9
) -> DataFrame:
    """Differences of two tables by run_id: (run_id, field, left_value, right_value).

    A key whose row count differs from one on either side gives a single ``rows`` entry with the
    counts. Rows per key are counted first, so repeated keys cannot multiply into pairs: only keys
    with one row on either side are joined. Doubles equal within ``tolerance`` are the same; values
    print at metric precision, or in full where that would hide the difference.
    """
    ours = left.select("run_id", F.lit(1).alias("l"), F.lit(0).alias("r"))
    theirs = right.select("run_id", F.lit(0).alias("l"), F.lit(1).alias("r"))
    keys = ours.unionAll(theirs).groupBy("run_id").agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    uneven = keys.where("l <> 1 OR r <> 1")
    rows = uneven.select("run_id", F.lit("rows").alias("field"), F.col("l").cast("string").alias("left_value"),
                         F.col("r").cast("string").alias("right_value"))
    repeated = uneven.where("l > 1 OR r > 1").select(F.col("run_id").alias("again"))

    def single(df: DataFrame, name: str) -> DataFrame:
        named = df.select(F.col("run_id").alias(f"{name}_id"), F.struct(*columns).alias(name))
        return named.join(repeated, F.col(f"{name}_id").eqNullSafe(F.col("again")), "left_anti")

    both = single(left, "lv").join(
        single(right, "rv"), F.col("lv_id").eqNullSafe(F.col("rv_id"))).withColumnRenamed("lv_id", "run_id")
    fields = [
        (c, F.col("lv")[c], F.col("rv")[c], left.schema[c].dataType) for c in columns
    ]
    return rows.unionByName(_differences(both, fields, tolerance))


def _unequal_ranges(left: DataFrame, right: DataFrame, columns: list[str], ranges: int) -> DataFrame:
    """(range) of the key ranges whose rows differ. Left rows add their digests, right rows take theirs away, so a range
    of equal rows sums to 0 in any order; a range of different ones does by chance in one of some 2^128."""
    whole = ["run_id", *columns]
    present = F.concat(*[F.when(F.col(c).isNull(), "0").otherwise("1") for c in whole])  # the hash passes over nulls

    def signed(df: DataFrame, sign: int) -> DataFrame:
        digests = [(F.xxhash64(F.lit(k), present, *whole).cast("decimal(20,0)") * sign).alias(f"d{k}") for k in (1, 2)]
        return df.select(_range(ranges).alias("range"), F.lit(sign).alias("n"), *digests)

    sums = signed(left, 1).unionAll(signed(right, -1)).groupBy("range").agg(*[F.sum(c).alias(c) for c in ("n", "d1", "d2")])
    return sums.where("n <> 0 OR d1 <> 0 OR d2 <> 0").select("range")


def _range(ranges: int) -> Column:
    return F.pmod(F.xxhash64("run_id"), F.lit(ranges).cast("long"))


def unequal_rows(
    left: DataFrame, right: DataFrame, columns: list[str], ranges: int = 4096, levels: int = 2
) -> tuple[DataFrame, DataFrame]:
    """The rows of both tables in key ranges that are not equal. Keys are dealt into ``ranges`` ranges by hash, those of
    ranges that differ into ``ranges`` finer ones, and so on for ``levels`` levels. A level is one pass with one small
    row per range and task in its shuffle; no row of an equal range is moved."""
    kept = (left, right)
    for level in range(1, levels + 1):
        found = stage(_unequal_ranges(*kept, columns, ranges**level), "ranges")
        kept = tuple(df.join(found, _range(ranges**level) == F.col("range"), "left_semi") for df in (left, right))
    return kept


def reconcile_ranges(
    left: DataFrame, right: DataFrame, columns: list[str], tolerance: float = 1e-9, ranges: int = 4096, levels: int = 2
) -> DataFrame:
    """What :func:`reconcile` finds, for large tables that are nearly equal: only rows of unequal key ranges are counted
    and joined. Both tables are read a few times, so they should be written ones. Writes the ranges when called."""
    return reconcile(*unequal_rows(left, right, columns, ranges, levels), columns, tolerance)


def recompute_diff(metrics: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """Stored metrics that differ from metrics recomputed from the same row's facts; left is stored,
    right is recomputed. Row by row: no shuffle."""
    stored = {name: f"stored_{name}" for name in METRIC_COLUMNS}
    both = with_metrics(metrics.withColumnsRenamed(stored))
    fields = [
        (n, F.col(stored[n]), F.col(n), metrics.schema[n].dataType) for n in METRIC_COLUMNS
    ]
    return _differences(both, fields, tolerance)


def extract_diff(runs: DataFrame, extract: DataFrame) -> DataFrame:
    """Differences between a written extract and the extract recomputed from the runs."""
    columns = [c for c in extract.columns if c != "run_id"]
    return reconcile(extract, decision_extract(with_metrics(runs)), columns)
