"""Judgment layer: bounded labelling jobs.

A labeller sees the ten extract columns and nothing else, and returns (run_id, decision,
confidence) with a decision from the fixed vocabulary. It never computes a metric.
"""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.functions.text import canonical_text
from runlens.operators.contract import ContractError, check_contract
from runlens.schemas import CONFIDENCE, DECISION, DECISIONS, EXTRACT_COLUMNS, LABELS
from runlens.sources import layout, writers
from runlens.sources.staging import stage

ANSWER = "run_id string, decision string, confidence double"


def _level(source: Column, levels: dict[str, int], otherwise: int) -> Column:
    level = None
    for value, number in levels.items():
        level = (F if level is None else level).when(source == value, number)
    return level.otherwise(otherwise)


def _decide(df: DataFrame, undisclosed: Column | None) -> DataFrame:
    """Add decision and confidence of the native policy to rows that have the extract columns.

    The label is the worse of the freshness level and the status level; unknown values count as
    worst. Confidence is the share of four signals (freshness, status, failure rate, drift) that sit
    at the chosen level, or null where ``undisclosed`` holds.
    """
    rate = F.col("failure_rate")
    levels = {
        "__freshness": _level(
            F.col("freshness_severity"), {"ON_TIME": 0, "MINOR": 1, "MAJOR": 2}, 3
        ),
        "__status": _level(F.col("status"), {"healthy": 0, "degraded": 1}, 3),
        "__failures": F.when(rate < 0.01, 0).when(rate < 0.03, 1).when(rate < 0.2, 2).otherwise(3),
        "__drift": F.when(F.col("schema_drift") == "none", 0).otherwise(2),
    }
    # as columns of their own, the levels are computed once and the generated code stays small
    leveled = df.withColumns(levels).withColumn("__level", F.greatest("__freshness", "__status"))
    agreeing = sum((F.when(F.col(n) == F.col("__level"), 1.0).otherwise(0.0) for n in levels), F.lit(0.0))
    confidence = agreeing / 4
    if undisclosed is not None:
        confidence = F.when(~undisclosed, confidence)
    return leveled.select(
        *df.columns,
        F.element_at(F.array(*[F.lit(name) for name in LABELS]), F.col("__level") + 1).alias(DECISION),
        confidence.alias(CONFIDENCE),
    )


def policy_labels(extract: DataFrame, undisclosed: Column | None = None) -> DataFrame:
    """Labels by the native policy: projections only, no shuffle and no Python worker."""
    return _decide(extract, undisclosed).select(
        "run_id", F.col(DECISION).alias("decision"), F.col(CONFIDENCE).alias("confidence")
    )


def with_policy(metrics: DataFrame, undisclosed: Column | None = None) -> DataFrame:
    """The final table under the native policy. A policy label is a function of its own row, so the
    one-to-one contract holds by construction and no join is needed."""
    return _decide(metrics, undisclosed)


def recorded_labels(decisions: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """A labeller for :func:`runlens.plans.jobs.label_job` that answers with labels recorded earlier.
    The job's check of vocabulary, coverage and confidence holds for them as for any other."""
    recorded = decisions.select(*[F.col(f.name).cast(f.dataType) for f in DECISIONS])
    return lambda extract: recorded


def check_confidence(decisions: DataFrame) -> None:
    """Raise if a confidence lies outside [0, 1]; null is allowed. One pass, one number."""
    outside = F.count_if(~F.col("confidence").between(0.0, 1.0) | F.isnan("confidence"))
    wrong = decisions.agg(outside.alias("n")).first().n
    if wrong:
        raise ContractError(f"{wrong} rows have a confidence outside 0 to 1")


def request_payload(extract: DataFrame) -> DataFrame:
    """(run_id, payload): the extract row as JSON with nulls kept, for scorers that take text."""
    payload = F.to_json(F.struct(*EXTRACT_COLUMNS), {"ignoreNullFields": "false"})
    return extract.select("run_id", payload.alias("payload"))


def scored_labels(
    extract: DataFrame, scorer: Callable[[pd.DataFrame], pd.DataFrame]
) -> DataFrame:
    """Labels by a user function, called once per Arrow batch of extract rows.

    An answer that misses a run, invents one or leaves the vocabulary fails the job. A scorer may
    not be repeatable, so write the result before it is checked and joined.
    """
    columns, allowed = list(EXTRACT_COLUMNS), list(LABELS)

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            answers = scorer(batch)
            asked, answered = (t["run_id"].value_counts(dropna=False) for t in (batch, answers))
            if not asked.sort_index().equals(answered.sort_index()):
                raise ValueError("scorer did not answer exactly the runs it was given")
            unknown = answers.loc[~answers["decision"].isin(allowed)]
            if len(unknown):
                given = sorted(map(repr, unknown["decision"].unique()))
                raise ValueError(f"scorer used labels that are not allowed: {', '.join(given)}")
            confidence = answers["confidence"].dropna()
            if not confidence.between(0.0, 1.0).all():
                raise ValueError("scorer gave a confidence outside 0 to 1")
            yield answers[["run_id", "decision", "confidence"]]

    return extract.select(*columns).mapInPandas(answer, ANSWER)


def resumed_labels(
    extract: DataFrame, label: Callable[[DataFrame], DataFrame], kept: str
) -> tuple[DataFrame, int]:
    """(answers for ``extract``, runs that were asked): ``label`` is asked only for runs whose ten extract columns it
    has not answered yet. Answers are kept below ``kept`` by run_id and a hash of what was asked, those of
    runs that are no longer in the extract dropped. What it answers is checked for coverage, vocabulary and
    confidence before it is kept, so a failed call leaves the answers of the calls before."""
    spark, columns = extract.sparkSession, list(EXTRACT_COLUMNS)
    wanted = stage(extract.select(*columns, F.sha2(canonical_text(extract, columns), 256).alias("asked")), "asked")
    numbers = layout.published(spark, kept)
    known = spark.read.parquet(f"{kept}/states/{numbers[-1]:012d}") if numbers else None
    open_ = wanted if known is None else wanted.join(known, ["run_id", "asked"], "left_anti")
    new = stage(open_, "open-runs")
    count = new.count()
    if known is not None and not count and known.count() == wanted.count():
        return known.select(*DECISIONS.fieldNames()), 0
    answers = stage(label(new.select(*columns)).select(*[F.col(f.name).cast(f.dataType) for f in DECISIONS]), "answers")
    check_contract(new, answers)
    check_confidence(answers)
    answered = answers.join(new.select("run_id", "asked"), "run_id")
    if known is not None:
        current = wanted.select("run_id", "asked")
        answered = known.join(current, ["run_id", "asked"], "left_semi").unionByName(answered)
    place = f"{kept}/states/{(numbers or [0])[-1] + 1:012d}"
    with writers.Outputs(spark) as outputs:
        answered.write.parquet(outputs.at(place))
    return spark.read.parquet(place).select(*DECISIONS.fieldNames()), count


def chosen_probability(probabilities: Column, decision: Column) -> Column:
    """Confidence as the probability a scorer gave its choice; null without a distribution."""
    return F.try_element_at(probabilities, decision)
