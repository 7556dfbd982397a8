"""Quality rules with risk-controlled thresholds, as native expressions only.

Every document gets counts, from them rule values, and is judged twice:

* the base rule: too few words, or too many of them in repeated five-word windows;
* one cutoff per rule and stratum, selected on labelled documents. A cutoff may be used only if an
  exact binomial test shows that it rejects at most a share ``risk / rules`` of the stratum's good
  documents, so that all rules together reject at most ``risk`` of them. The test's level is
  ``level`` divided by the number of tests made (strata x rules x cutoffs), so all guarantees hold
  together with probability 1 - ``level``. Of the certified cutoffs that one is taken which rejects
  most bad documents, a good one counting ``GOOD_WEIGHT`` times; the mildest of equals; none if that
  gains nothing. The candidate cutoffs are fixed beforehand, so no test depends on the data.

A stratum without enough labels to certify anything keeps the base rule only.

Edge cases. Null or blank text: all counts 0, base rule fails. Null stratum: a stratum of its own.
Null doc_id: judged, but never labelled. Labels: null quality counts as no label; a doc_id with both
labels counts as bad. Repeated rows are judged alike and each counts in the tests as often as it
occurs. No labels at all: base rule only. Columns of the input are kept; those whose names clash
with the columns added here are replaced.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.llm.words import count_of, let, share, words
from runlens.sources import staging

WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
#: Candidate cutoffs of every rule: a document is rejected whose value lies above.
CUTOFFS = (0.02, 0.03, 0.05, 0.07, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95)
RULES = ("symbols", "repeats", "dup_lines", "capitals")
RISK = 0.05
LEVEL = 0.05
GOOD_WEIGHT = 10
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_EXTRA = ("n_lines", "n_capitals")


def _repeated_words(word: Column) -> Column:
    """Words covered by five-word windows that occur twice or more, the first occurrence included.

    Windows are compared by 64-bit hashes within one text. Only a text in which two windows agree is
    sorted; the windows found are intervals of equal length, whose union is summed in order.
    """
    last = F.size(word) - WINDOW
    grams = F.when(
        last >= 0,
        F.transform(
            F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
            lambda i: F.xxhash64(*[F.get(word, i + k) for k in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<long>"))

    def covered(gram: Column) -> Column:
        ordered = F.sort_array(F.transform(gram, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
        starts = let(ordered, lambda o: F.sort_array(F.transform(
            F.filter(o, lambda x, j: F.coalesce(F.get(o, j - 1).g == x.g, F.lit(False))
                     | F.coalesce(F.get(o, j + 1).g == x.g, F.lit(False))),
            lambda x: x.i,
        )))
        total = F.aggregate(
            starts,
            F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("total")),
            lambda a, s: F.struct(
                s.alias("last"), (a.total + F.least(F.lit(WINDOW), s - a.last)).alias("total")
            ),
            lambda a: a.total,
        )
        return F.when(F.size(F.array_distinct(gram)) < F.size(gram), total).otherwise(F.lit(0))

    return let(grams, covered).cast("long")


def counts(text: Column) -> Column:
    """The counts of a whole text as one struct, whose parts are computed once."""
    body = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))

    def of(s: Column) -> Column:
        word, line = s["w"], s["l"]
        return F.struct(
            F.size(word).cast("long").alias("n_words"),
            F.length(F.array_join(word, "")).cast("long").alias("word_chars"),
            count_of(body, r"[^#*$%&|<>]+").alias("n_symbols"),
            (F.size(line) - F.size(F.array_distinct(line))).cast("long").alias("n_dup_lines"),
            _repeated_words(word).alias("n_repeat_words"),
            F.size(line).cast("long").alias("n_lines"),
            count_of(body, r"[^A-Z]+").alias("n_capitals"),
        )

    return let(F.struct(words(text).alias("w"), lines.alias("l")), of)


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts of every whole text. Write them before filtering by them: a filter
    pushed below the projection would compute them again for every mention."""
    counted = docs.drop(*COUNTS, *_EXTRA).withColumn("__counts", counts(F.col(text)))
    return counted.select("*", "__counts.*").drop("__counts")


def rule_values(count=F.col) -> dict[str, Column]:
    """The value of every rule, from the counts."""
    return {
        "symbols": share(count("n_symbols"), count("n_words")),
        "repeats": share(count("n_repeat_words"), count("n_words")),
        "dup_lines": share(count("n_dup_lines"), count("n_lines")),
        "capitals": share(count("n_capitals"), count("word_chars")),
    }


def base_failed(count=F.col) -> Column:
    return (count("n_words") < MIN_WORDS) | (
        100 * count("n_repeat_words") > MAX_REPEATED_PERCENT * count("n_words")
    )


def binomial_cdf(n: Column, k: Column, p: float) -> Column:
    """P(X <= k) of X ~ Binomial(n, p), for 0 <= k <= n p. The terms are summed downwards from k, as
    multiples of the k-th, whose logarithm is a sum over 1..k; so large n do not underflow."""
    down = (1 - p) / p
    steps = F.sequence(F.lit(1).cast("long"), F.greatest(k, F.lit(1)).cast("long"))
    log_choose = F.aggregate(
        steps, F.lit(0.0), lambda a, i: a + F.log((n - i + 1).cast("double") / i)
    )
    scaled = F.aggregate(
        steps,
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total")),
        lambda a, i: let(
            a.term * (k - i + 1).cast("double") / (n - k + i) * down,
            lambda t: F.struct(t.alias("term"), (a.total + t).alias("total")),
        ),
        lambda a: a.total,
    )
    none = F.lit(0.0)
    log_last = F.when(k > 0, log_choose).otherwise(none) + k * F.log(F.lit(p)) + (n - k) * F.log(
        F.lit(1 - p))
    return F.exp(log_last) * F.when(k > 0, scaled).otherwise(F.lit(1.0))


def cutoff_tests(
    counted: DataFrame, labels: DataFrame, stratum: str = "lang", key: str = "doc_id",
    risk: float = RISK, level: float = LEVEL,
) -> DataFrame:
    """One row per stratum, rule and cutoff: good documents, good and bad ones it rejects, the
    p-value of "it rejects more than its share of good documents", and whether it is certified."""
    known = labels.where(F.col("quality").isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(
        F.min("quality").alias("__good"))
    judged = counted.where(~base_failed()).join(known, key)
    levels = [
        F.struct(
            F.lit(rule).alias("rule"),
            sum((value > c).cast("int") for c in CUTOFFS).alias("passed"),
        )
        for rule, value in rule_values().items()
    ]
    grouped = (
        judged.select(F.col(stratum).alias("stratum"), "__good", F.explode(F.array(*levels)).alias("r"))
        .groupBy("stratum", "r.rule", "r.passed")
        .agg(F.sum((F.col("__good") == 1).cast("long")).alias("good"),
             F.sum((F.col("__good") != 1).cast("long")).alias("bad"))
    )
    each = grouped.groupBy("stratum", "rule").agg(
        F.sum("good").alias("n_good"),
        *[F.sum(F.when(F.col("passed") > i, F.col(kind)).otherwise(0)).alias(f"{kind}_{i}")
          for i in range(len(CUTOFFS)) for kind in ("good", "bad")],
    )
    tests = each.select(
        "stratum", "rule", "n_good",
        F.explode(F.array(*[
            F.struct(F.lit(c).alias("cutoff"), F.col(f"good_{i}").alias("good_rejected"),
                     F.col(f"bad_{i}").alias("bad_rejected"))
            for i, c in enumerate(CUTOFFS)
        ])).alias("t"),
    ).select("stratum", "rule", "n_good", "t.*")
    share_of_rule = risk / len(RULES)
    strata = tests.agg(F.count_distinct(F.coalesce(F.concat(F.lit("="), "stratum"), F.lit(""))).alias("strata"))
    p = F.when(
        F.col("good_rejected") <= F.col("n_good") * share_of_rule,
        binomial_cdf(F.col("n_good"), F.col("good_rejected"), share_of_rule),
    ).otherwise(F.lit(1.0))
    return tests.crossJoin(strata).select(  # one row
        "stratum", "rule", "cutoff", "n_good", "good_rejected", "bad_rejected", p.alias("p_value"),
        (p <= level / (F.col("strata") * len(RULES) * len(CUTOFFS))).alias("certified"),
    )


def select_cutoffs(tests: DataFrame) -> DataFrame:
    """(stratum, one column per rule): the chosen cutoffs, null where a rule is not applied."""
    gain = F.col("bad_rejected") - GOOD_WEIGHT * F.col("good_rejected")
    best = Window.partitionBy("stratum", "rule").orderBy(F.desc("gain"), F.desc("cutoff"))
    chosen = (
        tests.where("certified").withColumn("gain", gain).where("gain > 0")
        .withColumn("place", F.row_number().over(best)).where("place = 1")
    )
    return chosen.groupBy("stratum").agg(
        *[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cutoff_{r}") for r in RULES]
    )


def fit(counted: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """The cutoffs, as a written table: one row per stratum in which anything is certified."""
    return staging.stage(select_cutoffs(cutoff_tests(counted, labels, stratum)), "cutoffs")


def _with_cutoffs(docs: DataFrame, cutoffs: DataFrame, stratum: str) -> DataFrame:
    """The written cutoff table is broadcast while the session's size limit allows."""
    named = cutoffs.toDF(*[f"__{c}" for c in cutoffs.columns])
    return docs.join(named, F.col(stratum).eqNullSafe(F.col("__stratum")), "left")


def _rejected_by(count=F.col) -> Column:
    return F.array_compact(F.array(*[
        F.when(value > F.col(f"__cutoff_{rule}"), F.lit(rule)) for rule, value in rule_values(count).items()
    ]))


def judge(counted: DataFrame, cutoffs: DataFrame, stratum: str = "lang") -> DataFrame:
    """``counted`` with ``base_failed``, ``rejected_by`` (names of the rules whose cutoff is passed)
    and ``kept``."""
    joined = _with_cutoffs(counted.drop("base_failed", "rejected_by", "kept"), cutoffs, stratum)
    return joined.withColumns({"base_failed": base_failed(), "rejected_by": _rejected_by()}).withColumn(
        "kept", ~F.col("base_failed") & (F.size("rejected_by") == 0)
    ).drop("__stratum", *[f"__cutoff_{r}" for r in RULES])


def filter_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, with their own columns. Counts of labelled documents are written
    for the fit; the texts are then read again and judged by one expression."""
    labelled = docs.join(labels.where("quality is not null").select("doc_id").distinct(), "doc_id",
                         "left_semi").select("doc_id", "lang", "text")
    counted = staging.stage(with_counts(labelled).drop("text"), "rule-counts")
    kept = let(counts(F.col("text")),
               lambda c: ~base_failed(c.getField) & (F.size(_rejected_by(c.getField)) == 0))
    return _with_cutoffs(docs, fit(counted, labels), "lang").where(kept).select(*docs.columns)
