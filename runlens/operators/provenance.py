"""Fingerprints and the provenance row of a labelling job."""

import hashlib
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.functions.text import canonical_text
from runlens.schemas import LABEL_MEANINGS

_HEX_DIGITS = 15  # of the row digest per part: 60 bits fit a bigint in any engine
_FIRST = range(1, 65, _HEX_DIGITS)  # first digits of the parts, which hold all 256 bits together
PARTS = [f"digest_{k}" for k in range(len(_FIRST))]


def digest_parts(df: DataFrame, columns: list[str], *kept: str) -> DataFrame:
    """The rows' digests over ``columns`` as whole numbers ``PARTS``, beside domain and the columns ``kept``."""
    beside = [c for c in ("domain", *kept) if c in df.columns]
    digested = df.select(*beside, F.sha2(canonical_text(df, columns), 256).alias("d"))
    return digested.select(*beside, *[
        F.conv(F.substring("d", first, _HEX_DIGITS), 16, 10).cast("decimal(20,0)").alias(name)
        for first, name in zip(_FIRST, PARTS)])


def fingerprint_of(totals: DataFrame) -> DataFrame:
    """(row_count, digest_sum, fingerprint) of one row of sums."""
    named = totals.select("row_count", F.concat_ws("-", *[F.col(p).cast("string") for p in PARTS]).alias("digest_sum"))
    joined = F.concat_ws(":", F.col("row_count").cast("string"), "digest_sum")
    return named.select("*", F.sha2(joined, 256).alias("fingerprint"))


def input_fingerprint(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(row_count, digest_sum, fingerprint) of a table, whatever its order and partitioning.

    Row digests are added, not xor-ed, so a repeated row changes the result; their parts are added one
    by one, joined by ``-``. One global aggregate with map-side partial sums.
    """
    parts = digest_parts(df, columns or df.columns)
    zero = F.lit(0).cast("decimal(30,0)")
    return fingerprint_of(parts.agg(
        F.count("*").alias("row_count"), *[F.coalesce(F.sum(p), zero).alias(p) for p in PARTS]))


def question_text(version: str, meanings: dict[str, str] = LABEL_MEANINGS) -> str:
    """The bounded question of a labelling job as canonical JSON."""
    question = {"version": version, "choices": meanings}
    return json.dumps(question, sort_keys=True, separators=(",", ":"))


def question_hash(version: str, meanings: dict[str, str] = LABEL_MEANINGS) -> str:
    return hashlib.sha256(question_text(version, meanings).encode()).hexdigest()


def label_job_meta(
    extract: DataFrame, labeller: str, version: str, generated_at: str
) -> DataFrame:
    """One provenance row: who labelled what, asked how, when. The time is passed in."""
    return input_fingerprint(extract).select(
        F.lit(labeller).alias("labeller"),
        F.lit(version).alias("version"),
        F.lit(question_hash(version)).alias("question_hash"),
        F.col("fingerprint").alias("input_hash"),
        F.col("row_count").alias("count"),
        F.lit(generated_at).alias("generated_at"),
    )
