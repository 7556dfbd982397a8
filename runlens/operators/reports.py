"""Reports over the final table. Each aggregate is one grouped pass with map-side partial sums."""

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.functions.numeric import fixed_text, half_up, micros
from runlens.schemas import (
    ATTENTION, CONFIDENCE, DASHBOARD_COLUMNS, DECISION, HEALTH_COLUMNS, LABELS, QUEUE,
    QUEUE_COLUMNS, STATUSES,
)


def _label_is(name: str) -> Column:
    return F.col(DECISION) == name


def _label_in(names: list[str]) -> Column:
    return F.col(DECISION).isin(names)


def _label_counts() -> list[Column]:
    return [F.count_if(_label_is(name)).alias(name) for name in LABELS]


def kpi_summary(final: DataFrame) -> DataFrame:
    """Total, healthy share to four decimals (null without runs), attention and blocked runs."""
    one, zero = F.lit(Decimal("1.0")), F.lit(Decimal("0.0"))
    share = F.avg(F.when(_label_is("HEALTHY"), one).otherwise(zero))
    return final.agg(
        F.count("*").alias("total_runs"),
        F.round(share, 4).cast("double").alias("healthy_share"),
        F.count_if(_label_in(ATTENTION)).alias("requires_attention"),
        F.count_if(_label_is("BLOCK")).alias("blocked"),
    )


def kpi_by_label(final: DataFrame) -> DataFrame:
    """Total, unrounded healthy percentage (0 without runs), attention, blocked, runs per label."""
    counts = final.agg(F.count("*").alias("total"), *_label_counts())
    percent = F.when(F.col("total") == 0, F.lit(0.0)).otherwise(
        F.col("HEALTHY") / F.col("total") * 100
    )
    return counts.select(
        "total",
        percent.alias("healthy_pct"),
        sum((F.col(n) for n in ATTENTION), F.lit(0).cast("bigint")).alias("attention"),
        F.col("BLOCK").alias("blocked"),
        *LABELS,
    )


def kpi_display(final: DataFrame) -> DataFrame:
    """The KPI cards as (card, value) text."""
    k = kpi_by_label(final)
    cards = [
        ("total", F.col("total").cast("string")),
        ("healthy_pct", F.concat(fixed_text(F.col("healthy_pct"), 1), F.lit("%"))),
        ("attention", F.col("attention").cast("string")),
        ("blocked", F.col("blocked").cast("string")),
    ]
    return k.select(
        F.inline(F.array(*[F.struct(F.lit(n).alias("card"), v.alias("value")) for n, v in cards]))
    )


def decision_distribution(final: DataFrame) -> DataFrame:
    """Runs per label, most frequent first."""
    return final.groupBy(DECISION).agg(F.count("*").alias("runs")).orderBy(F.desc("runs"), DECISION)


def domain_decision(final: DataFrame) -> DataFrame:
    """Runs per domain and label, long form."""
    counts = final.groupBy("domain", DECISION).agg(F.count("*").alias("runs"))
    return counts.orderBy("domain", DECISION)


def domain_decision_pivot(final: DataFrame) -> DataFrame:
    """Runs per domain, one column per label, zeros kept."""
    return final.groupBy("domain").agg(*_label_counts()).orderBy("domain")


def status_confusion(final: DataFrame) -> DataFrame:
    """Runs per status, one column per label, zeros kept."""
    return final.groupBy("status").agg(*_label_counts()).orderBy("status")


def mean_freshness(final: DataFrame) -> DataFrame:
    """Mean freshness delay per upstream pipeline, two decimals."""
    mean = F.sum("freshness_delay_minutes") / F.count("*")
    return (
        final.groupBy("pipeline_name")
        .agg(half_up(mean, 2).alias("avg_freshness_delay"))
        .orderBy("pipeline_name")
    )


def health_table(final: DataFrame) -> DataFrame:
    """One row per upstream pipeline; its domain is that of its first run by run_id. Both means are over
    all runs; a null adds nothing."""
    numbers = final.groupBy("pipeline_name", "domain").agg(
        F.count("*").alias("n"),
        F.count_if(_label_is("HEALTHY")).alias("healthy"),
        F.count_if(_label_in(ATTENTION)).alias("attention"),
        F.count_if(_label_is("BLOCK")).alias("blocked"),
        F.sum("freshness_delay_minutes").alias("delay"),
        F.sum(micros(F.col("failure_rate"))).alias("rate"),
    )
    sums = [F.sum(c).alias(c) for c in ("n", "healthy", "attention", "blocked", "delay", "rate")]
    pipelines = numbers.groupBy("pipeline_name").agg(
        F.count("*").alias("domains"), F.min("domain").alias("only"), *sums)
    # text per run is looked at for pipelines with several domains only
    several = pipelines.where("domains > 1").select(F.col("pipeline_name").alias("of"))
    first = final.join(several, F.col("pipeline_name").eqNullSafe(F.col("of")), "left_semi").groupBy(
        F.col("pipeline_name").alias("of")).agg(F.min_by("domain", "run_id").alias("first"))
    n = F.col("n")
    return (
        pipelines.join(first, F.col("pipeline_name").eqNullSafe(F.col("of")), "left")
        .select(
            "pipeline_name",
            F.when(F.col("domains") > 1, F.col("first")).otherwise(F.col("only")).alias("domain"),
            n.alias("total_runs"),
            (F.floor(F.col("healthy") / n * 1000 + 0.5) / 10).alias("healthy_pct"),
            F.col("attention").alias("attention_runs"),
            F.col("blocked").alias("blocked_runs"),
            half_up(F.col("delay") / n, 2).alias("avg_freshness_delay"),
            half_up(F.col("rate") / F.lit(1e6) / n, 2).alias("avg_failure_rate"),
        )
        .orderBy("pipeline_name")
    )


def health_display(final: DataFrame) -> DataFrame:
    """The health table as shown: fixed decimals as text."""
    return health_table(final).select(
        "pipeline_name",
        "domain",
        "total_runs",
        F.concat(fixed_text(F.col("healthy_pct"), 1), F.lit("%")).alias("healthy_pct"),
        "attention_runs",
        "blocked_runs",
        fixed_text(F.col("avg_freshness_delay"), 2).alias("avg_freshness_delay"),
        fixed_text(F.col("avg_failure_rate"), 2).alias("avg_failure_rate"),
    )


def health_runs(final: DataFrame) -> DataFrame:
    """Thirteen columns per run, newest first. run_id breaks ties, also for the range sort."""
    return final.select(*HEALTH_COLUMNS).orderBy(F.desc("run_timestamp"), "run_id")


def freshness_trend(final: DataFrame) -> DataFrame:
    """Delay and label over time."""
    ordered = final.orderBy("run_timestamp", "run_id")
    return ordered.select("run_timestamp", "freshness_delay_minutes", DECISION)


def queue_runs(final: DataFrame) -> DataFrame:
    """Investigation queue, nine columns, least confident first, unknown confidence before all."""
    return (
        final.where(_label_in(QUEUE))
        .select(*QUEUE_COLUMNS)
        .orderBy(F.asc_nulls_first(CONFIDENCE), "run_id")
    )


def queue_compact(final: DataFrame) -> DataFrame:
    """Investigation queue, six columns, unknown confidence sorted as zero."""
    return (
        final.where(_label_in(QUEUE))
        .orderBy(F.coalesce(F.col(CONFIDENCE), F.lit(0.0)), "run_id")
        .select("pipeline_name", "domain", DECISION, CONFIDENCE, "status", "freshness_severity")
    )


def queue_display(final: DataFrame) -> DataFrame:
    """The compact queue as shown: two decimals, ``n/a`` for unknown confidence."""
    shown = F.coalesce(fixed_text(F.col(CONFIDENCE), 2), F.lit("n/a"))
    return queue_compact(final).withColumn(CONFIDENCE, shown)


def filtered_runs(
    final: DataFrame,
    domain: list[str] | None = None,
    decision: list[str] | None = None,
    schema_drift_present: bool | None = None,
) -> DataFrame:
    """The final rows under the dashboard's filters; an absent filter keeps everything."""
    if domain is not None:
        final = final.where(F.col("domain").isin(domain))
    if decision is not None:
        final = final.where(_label_in(decision))
    if schema_drift_present is not None:
        final = final.where(F.col("schema_drift_present") == schema_drift_present)
    return final


def dashboard_extract(final: DataFrame) -> DataFrame:
    """Ten typed columns by run_id. Casts accept text rows; an empty confidence becomes null."""
    typed = {
        "failure_rate": F.col("failure_rate").cast("double"),
        "freshness_delay_minutes": F.col("freshness_delay_minutes").cast("bigint"),
        CONFIDENCE: F.nullif(F.col(CONFIDENCE).cast("string"), F.lit("")).cast("double"),
    }
    return final.select(
        *[typed.get(c, F.col(c)).alias(c) for c in DASHBOARD_COLUMNS]
    ).orderBy("run_id")


def runs_preview(runs: DataFrame, rows: int = 5) -> DataFrame:
    """The first rows by run_id."""
    return runs.orderBy("run_id").limit(rows)


def source_profile(runs: DataFrame) -> DataFrame:
    """Row count and exact number of distinct run ids."""
    return runs.agg(
        F.count("*").alias("total_runs"), F.count_distinct("run_id").alias("distinct_run_ids")
    )


def domain_profile(runs: DataFrame) -> DataFrame:
    """Runs per domain and per status within it."""
    return (
        runs.groupBy("domain")
        .agg(
            F.count("*").alias("runs"),
            *[F.count_if(F.col("status") == s).alias(s) for s in STATUSES],
        )
        .orderBy("domain")
    )


def report_cube(final: DataFrame) -> DataFrame:
    """Counts and sums of every combination of domain, label and drift, and of all sums over any of them:
    what the dashboard's filters choose from, in one grouped pass. ``level`` has a bit for each of the three,
    1 where it is summed over."""
    summed = final.cube("domain", DECISION, "schema_drift_present").agg(
        F.grouping_id().cast("int").alias("level"), F.count("*").alias("runs"),
        F.sum("freshness_delay_minutes").alias("delay_minutes"),
        F.sum(micros(F.col("failure_rate"))).cast("long").alias("rate_micros"))
    return summed.select("domain", DECISION, "schema_drift_present", "level", "runs", "delay_minutes", "rate_micros")


def cube_row(
    cube: DataFrame, domain: str | None = None, label: str | None = None, drift: bool | None = None
) -> DataFrame:
    """(total_runs, mean_delay, mean_failure_rate) under the dashboard's filters, from one row of the cube; an
    absent filter means all. No row if nothing passes them."""
    chosen = {"domain": domain, DECISION: label, "schema_drift_present": drift}
    level = sum(bit for bit, value in zip((4, 2, 1), chosen.values()) if value is None)
    rows = cube.where(F.col("level") == level)
    for name, value in chosen.items():
        if value is not None:
            rows = rows.where(F.col(name) == value)
    return rows.where("runs > 0").select(
        F.col("runs").alias("total_runs"), (F.col("delay_minutes") / F.col("runs")).alias("mean_delay"),
        (F.col("rate_micros") / F.lit(1e6) / F.col("runs")).alias("mean_failure_rate"))
