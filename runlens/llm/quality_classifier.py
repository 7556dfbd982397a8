"""Quality classifier: a generalised additive model with pairwise interactions.

Features of the text are native expressions. The model is a lookup table per feature and per chosen
pair of features: cyclic boosting gives each table in turn one small tree, fitted to the gradient of
the logistic loss, so that a table ends as the sum of its trees. A score is the intercept plus one
table entry per feature and pair, taken for whole Arrow batches at once.

Learning uses at most about ``FIT_ROWS`` labelled documents, a documented bound: rows are drawn by a
hash of doc_id whose range shrinks as the labels grow, so the sample covers all of them alike. Only
their features reach the driver. Scoring covers every row.

Edge cases. Null and empty texts have a score like any other (all features 0). Null doc_id: scored,
never learned from, not held out. Null labels are no labels; a doc_id with both labels is learned as
0. Repeated rows get equal scores. Labels all alike, or none at all: every score is the (smoothed)
share of ones. Labels, language, source and doc_id are never inputs of a score.
"""

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.llm.words import count_of, share, words

FIT_ROWS = 20_000
HOLDOUT = 5
THRESHOLD = 0.3
BINS = 32
PAIR_BINS = 8
ROUNDS = 150
PAIR_ROUNDS = 60
PAIRS = 6
RATE = 0.1
LEAVES = 4
RIDGE = 5.0
MIN_HESSIAN = 1.0

FEATURES = (
    "words", "word_length", "distinct", "symbols", "bars", "bangs", "capitals", "digits", "commas",
    "stops", "not_ascii", "line_words", "line_copies", "longest", "links",
)


def with_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the model's features as columns ``f_<name>``."""
    body = F.coalesce(F.col(text), F.lit(""))
    split = docs.withColumns({
        "__w": words(F.col(text)),
        "__l": F.filter(F.split(body, "\n"), lambda line: F.length(line) > 0),
    })
    n, letters = F.size("__w"), F.length(body)
    values: dict[str, Column] = {
        "words": F.log1p(n.cast("double")),
        "word_length": share(F.length(F.array_join("__w", "")), n),
        "distinct": share(F.size(F.array_distinct("__w")), n),
        "symbols": share(count_of(body, r"[^#*$%&]+"), n),
        "bars": share(count_of(body, r"[^|<>{}\[\]]+"), n),
        "bangs": share(count_of(body, r"[^!?]+"), n),
        "capitals": share(count_of(body, r"[^A-Z]+"), letters),
        "digits": share(count_of(body, r"[^0-9]+"), letters),
        "commas": share(count_of(body, r"[^,]+"), n),
        "stops": share(count_of(body, r"[^.]+"), n),
        "not_ascii": share(F.octet_length(body) - letters, letters),
        "line_words": share(n, F.size("__l")),
        "line_copies": share(F.size("__l") - F.size(F.array_distinct("__l")), F.size("__l")),
        "longest": F.log1p(F.coalesce(
            F.array_max(F.transform("__w", lambda w: F.length(w))), F.lit(0)).cast("double")),
        "links": share(count_of(body, r"[^@/:]+"), n),
    }
    return split.withColumns({f"f_{k}": values[k] for k in FEATURES}).drop("__w", "__l")


def held_out(key: Column) -> Column:
    """Rows never learned from: crc32 of the id as text is divisible by :data:`HOLDOUT`."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % HOLDOUT == 0, F.lit(False))


@dataclass
class Model:
    """Additive lookup tables; ``score`` is the probability of label 1."""

    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)

    def score(self, values: np.ndarray) -> np.ndarray:
        logit = np.full(len(values), self.intercept)
        bins = [np.searchsorted(e, values[:, j], side="right") for j, e in enumerate(self.edges)]
        for j, table in enumerate(self.tables):
            logit += table[bins[j]]
        for i, j, table in self.pairs:
            logit += table[self.coarse[i][bins[i]], self.coarse[j][bins[j]]]
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def _gain(g, h):
    return g * g / (h + RIDGE)


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """The gain and place of the best cut of a sequence of bins; place 0: none."""
    if len(g) < 2:
        return 0.0, 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    all_g, all_h = g.sum(), h.sum()
    gains = _gain(left_g, left_h) + _gain(all_g - left_g, all_h - left_h) - _gain(all_g, all_h)
    gains[(left_h < MIN_HESSIAN) | (all_h - left_h < MIN_HESSIAN)] = 0.0
    at = int(np.argmax(gains))
    return (float(gains[at]), at + 1) if gains[at] > 1e-9 else (0.0, 0)


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Steps of one small tree over the bins of a feature, grown by the largest gain."""
    leaves, found = [(0, len(g))], [_best_cut(g, h)]
    while len(leaves) < LEAVES and max(found)[0] > 0:
        k = max(range(len(found)), key=lambda i: found[i][0])
        (a, b), cut = leaves[k], found[k][1]
        leaves[k : k + 1] = [(a, a + cut), (a + cut, b)]
        found[k : k + 1] = [_best_cut(g[x:y], h[x:y]) for x, y in leaves[k : k + 2]]
    steps = np.zeros(len(g))
    for a, b in leaves:
        steps[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return steps


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and steps of a tree that cuts one axis and then, on either side, the other one."""
    best_gain, best = 0.0, np.zeros_like(g)
    for turned in (False, True):
        a, b = (g.T, h.T) if turned else (g, h)
        for cut in range(1, len(a)):
            gain, steps = -_gain(a.sum(), b.sum()), np.zeros_like(a)
            for rows in (slice(0, cut), slice(cut, None)):
                x, y = a[rows].sum(0), b[rows].sum(0)
                place = _best_cut(x, y)[1]
                for columns in (slice(0, place), slice(place, None)):
                    s, t = x[columns].sum(), y[columns].sum()
                    if t >= MIN_HESSIAN:
                        gain += _gain(s, t)
                        steps[rows, columns] = s / (t + RIDGE)
            if gain > best_gain + 1e-9:
                best_gain, best = gain, steps.T if turned else steps
    return best_gain, best


def fit(values: np.ndarray, labels: np.ndarray) -> Model:
    """Boost the tables on rows of feature values and 0/1 labels; same rows, same model."""
    total = len(labels)
    rate = (labels.sum() + 0.5) / (total + 1)
    model = Model(float(np.log(rate / (1 - rate))))
    if total == 0 or labels.min() == labels.max():
        return model
    for j in range(values.shape[1]):
        edges = np.unique(np.quantile(values[:, j], np.linspace(0, 1, BINS + 1)[1:-1]))
        model.edges.append(edges)
        model.tables.append(np.zeros(len(edges) + 1))
        model.coarse.append(np.arange(len(edges) + 1) * PAIR_BINS // (len(edges) + 1))
    bins = [np.searchsorted(e, values[:, j], side="right") for j, e in enumerate(model.edges)]
    logit = np.full(total, model.intercept)

    def slopes():
        p = 1 / (1 + np.exp(-logit))
        return labels - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j, b in enumerate(bins):
            g, h = slopes()
            size = len(model.tables[j])
            steps = RATE * _tree(np.bincount(b, g, size), np.bincount(b, h, size))
            model.tables[j] += steps
            logit += steps[b]

    coarse = [model.coarse[j][b] for j, b in enumerate(bins)]
    shape = (PAIR_BINS, PAIR_BINS)

    def tree(i: int, j: int):
        g, h = slopes()
        cell = coarse[i] * PAIR_BINS + coarse[j]
        sums = [np.bincount(cell, x, PAIR_BINS**2).reshape(shape) for x in (g, h)]
        return *_pair_tree(*sums), cell

    ranked = sorted(
        ((tree(i, j)[0], -i, -j) for i in range(len(bins)) for j in range(i)), reverse=True)
    model.pairs = [(-i, -j, np.zeros(shape)) for gain, i, j in ranked[:PAIRS] if gain > 0]
    for _ in range(PAIR_ROUNDS):
        for i, j, table in model.pairs:
            _, steps, cell = tree(i, j)
            table += RATE * steps
            logit += RATE * steps.ravel()[cell]
    return model


def learn(docs: DataFrame, labels: DataFrame, target: str = "quality", rows: int = FIT_ROWS) -> Model:
    """Fit on labelled documents that are not held out: all, or about ``rows`` of them.

    The drawn labels are bounded by ``rows`` (half as many again is refused), so their ids may be
    broadcast against the documents. A doc_id that repeats in the documents counts once.
    """
    usable = labels.where(F.col(target).isNotNull() & F.col("doc_id").isNotNull()
                          & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min(target).alias("__y"))
    known = usable.count()
    chosen = F.pmod(F.xxhash64("doc_id"), F.lit(max(known, 1))) < rows
    drawn = usable.where(chosen).limit(rows + rows // 2)
    wanted = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    names = [f"f_{k}" for k in FEATURES]
    once = with_features(wanted).groupBy("doc_id").agg(
        F.min("__y").alias("__y"), *[F.min(c).alias(c) for c in names])
    found = once.toPandas().sort_values("doc_id")
    return fit(found[names].to_numpy(float), (found["__y"] > 0).to_numpy(float))


def with_score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: label 1 likelier) and ``predicted``."""

    @F.pandas_udf("double")
    def score(features: pd.DataFrame) -> pd.Series:
        return pd.Series(model.score(features.to_numpy(float)))

    names = [f"f_{k}" for k in FEATURES]
    scored = with_features(docs.drop("score", "predicted")).withColumn("score", score(F.struct(*names)))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")).drop(*names)


def filter_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents predicted to be good, with their own columns."""
    marked = docs.select("doc_id", "text", F.struct(*docs.columns).alias("__row"))
    return with_score(marked, learn(docs, labels)).where("predicted = 1").select("__row.*")
