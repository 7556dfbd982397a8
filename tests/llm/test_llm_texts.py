"""Line dedup, quality rules, classifier and pipeline stages."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from runlens.llm import line_dedup, near_dedup, quality_classifier, quality_rules
from runlens.sources.staging import Scope


def spans_by_hand(lines):
    """(first, end) of the chunks and runs of a text that may go."""
    import xxhash

    words = [len(x.encode().split()) for x in lines]
    hashes = np.array([xxhash.xxh3_64_intdigest(x.encode()) for x in lines], np.uint64)
    long = [i for i, n in enumerate(words) if n >= 50]
    start = 0
    for end in line_dedup.chunk_bounds(hashes, long):
        if sum(n > 0 for n in words[start:end]) >= 2 or start in long:
            yield start, end
        start = end
    if sum(words) < 50:
        if sum(n > 0 for n in words) >= 2:
            yield 0, len(lines)
        return
    runs = set()
    for i in range(len(lines)):
        end = next((e for e in range(i + 1, len(lines) + 1) if sum(words[i:e]) >= 50), None)
        first = next((s for s in range(i, -1, -1) if sum(words[s : i + 1]) >= 50), None)
        runs |= {(i, end)} if end else set()
        runs |= {(first, i + 1)} if first is not None else set()
    yield from runs


def lines_by_hand(rows):
    """Cut texts of (doc_id, text) rows, passage by passage; rows equal in both are one document. Chunks and runs have
    keys of their own, so each kind has its first occurrences."""
    passages = {}
    for doc_id, text in set(rows):
        lines = (text or "").split("\n")
        place = (doc_id is None, doc_id or 0)
        for start, end in set(spans_by_hand(lines)):
            passages.setdefault("\n".join(lines[start:end]), []).append((place, start, end, (doc_id, text)))
    gone = {}
    for places in passages.values():
        place, first, last, row = min(places, key=lambda p: p[:3])
        for _, start, end, other in places:
            if (start, other) != (first, row):  # lines shared with the first occurrence stay
                own = set(range(first, last)) if other == row else set()
                gone.setdefault(other, set()).update(set(range(start, end)) - own)
    return [
        text if not gone.get((doc_id, text)) else "\n".join(
            x for i, x in enumerate(text.split("\n")) if i not in gone[(doc_id, text)])
        for doc_id, text in rows
    ]


def test_lines_equal_chunks_cut_by_hand(spark, edge_docs, edge_rows):
    rows = [(r[0], r[1]) for r in edge_rows]
    with Scope(spark) as scope:
        cut = line_dedup.dedup_lines(edge_docs, scope).select("doc_id", "text").collect()
    want = Counter((r[0], t) for r, t in zip(rows, lines_by_hand(rows)))
    assert Counter((r.doc_id, r.text) for r in cut) == want
    assert Counter(r[1] for r in rows) != Counter(t for _, t in want.elements())  # something was cut


def planted_passages(seed):
    """Texts of unique lines that share passages of 2 to 8 lines and 50 words or more; some lines are blank."""
    chance = random.Random(seed)
    word = iter(range(10**9))

    def line(low, high):
        return " ".join(f"w{next(word)}" for _ in range(chance.randint(low, high)))

    passages = []
    for size in range(2, 9):
        for _ in range(4):
            lines = [line(1, 60) for _ in range(size)]
            lines[-1] += " " + line(50, 50) if chance.random() < 0.3 else ""
            lines[0] = line(max(50 - sum(len(x.split()) for x in lines[1:]), 1) + 3, 60)
            if size > 3 and chance.random() < 0.5:
                lines[2] = ""
                lines[0] += " " + line(60, 60)
            passages.append(lines)
    rows = []
    for k in range(50):
        text = [line(1, 20) for _ in range(chance.randint(0, 3))]
        for passage in chance.sample(passages, chance.randint(1, 3)):
            text += passage + [line(1, 20) for _ in range(chance.randint(1, 3))]
        if k % 10 == 3:  # the same again further down
            text += passage
        rows.append((None if k == 7 else 100 - k, "\n".join(text)))
    return rows


def passages_by_hand(rows):
    """Texts without the lines of every run of lines, of 50 words or more, that stands at an earlier place."""
    texts = [text.split("\n") for _, text in rows]
    order = sorted(range(len(rows)), key=lambda r: (rows[r][0] is None, rows[r][0]))
    seen, gone = {}, set()
    for length in range(1, 1 + max(map(len, texts))):
        for at in order:
            for i in range(len(texts[at]) - length + 1):
                run = tuple(texts[at][i : i + length])
                if sum(len(x.split()) for x in run) >= 50 and seen.setdefault(run, (at, i)) != (at, i):
                    gone |= {(at, i + k) for k in range(length)}
    return [(rows[r][0], "\n".join(x for i, x in enumerate(texts[r]) if (r, i) not in gone)) for r in range(len(rows))]


@pytest.mark.parametrize("seed", [1, 2])
def test_passages_of_fifty_words_go_whatever_stands_around_them(spark, seed):
    rows = planted_passages(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    with Scope(spark) as scope:
        cut = line_dedup.dedup_lines(docs, scope).select("doc_id", "text", "n_lines", "n_removed_lines").collect()
    want = passages_by_hand(rows)
    assert Counter((r.doc_id, r.text) for r in cut) == Counter(want) and want != rows
    for r in cut:
        assert r.n_lines - r.n_removed_lines == (len(r.text.split("\n")) if r.n_removed_lines < r.n_lines else 0)


def test_exact_copies_leave_no_document(spark):
    chance = random.Random(5)
    originals, copies = [], []
    for k in range(60):
        lines = [" ".join(f"w{k}x{i}x{n}" for n in range(chance.randint(1, 6))) for i in range(3 + k % 10)]
        if k % 4 == 1:
            lines.insert(2, "")
        if k % 4 == 2:  # a short line between long ones
            lines[0] = lines[2] = " ".join(f"l{k}x{n}" for n in range(70))
        originals.append((k, "\n".join(lines)))
        copies += [(1000 + 10 * k + c, originals[-1][1]) for c in range(1 + k % 3)]
    docs = spark.createDataFrame(originals + copies, "doc_id long, text string").repartition(4)
    with Scope(spark) as scope:
        left = near_dedup.filter_documents(scope.stage(line_dedup.filter_documents(docs, scope), "cut")).collect()
    assert sorted(r.doc_id for r in left) == [k for k, _ in originals]


def test_bounds_resist_shifts():
    chance = np.random.default_rng(2)
    passage = chance.integers(0, 2**63, 200, dtype=np.uint64)
    moved = np.concatenate([chance.integers(0, 2**63, 17, dtype=np.uint64), passage])
    a, b = line_dedup.chunk_bounds(passage), [e - 17 for e in line_dedup.chunk_bounds(moved)]
    assert len(set(a) & set(b)) > 0.9 * len(a)
    sizes = np.diff([0, *a])
    assert sizes[:-1].min() >= line_dedup.MIN_LINES and sizes.max() <= line_dedup.MAX_LINES


def test_unequal_bytes_under_one_hash_stay(spark, monkeypatch):
    rows = [(i, f"first {i} of text\nsecond {i} of text\nthird {i}\nfourth {i}") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    plain = line_dedup._CHUNKS
    colliding = docs.sparkSession  # every chunk gets the same hash
    with Scope(colliding) as scope:
        original = Scope.stage

        def stage(self, df, name):
            if name == "chunks":
                df = df.withColumn("key", F.lit(b"same").cast("binary"))
            return original(self, df, name)

        monkeypatch.setattr(Scope, "stage", stage)
        cut = line_dedup.dedup_lines(docs, scope).collect()
    assert plain and sorted((r.doc_id, r.text) for r in cut) == rows


def test_lines_keep_other_columns_and_counts(spark, edge_docs, no_docs):
    with Scope(spark) as scope:
        left = line_dedup.filter_documents(edge_docs, scope)
        assert left.dtypes == edge_docs.dtypes
        for r in left.collect():
            assert r.removed.startswith("own") and r.n_chars == (None if r.text is None else len(r.text))
        assert line_dedup.filter_documents(no_docs, scope).count() == 0


def test_texts_are_cut_once(spark, edge_docs):
    """Not again for the filter that drops what is empty then: each task would hold two Python workers."""
    with Scope(spark) as scope:
        left = line_dedup.filter_documents(edge_docs, scope)
        assert left._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def repeated_words(words):
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    many = Counter(grams)
    return len({i + k for i, g in enumerate(grams) if many[g] > 1 for k in range(5)})


def test_counts_equal_python(edge_docs, edge_rows):
    import re

    word = re.compile(r"[^\x20\x09-\x0D]+")
    want = []
    for row in edge_rows:
        text = row[1] or ""
        words = word.findall(text)
        lines = [x for x in text.split("\n") if word.search(x)]
        want.append((row[0], len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
                     len(lines) - len(set(lines)), repeated_words(words)))
    got = quality_rules.with_counts(edge_docs).select("doc_id", *quality_rules.COUNTS).collect()
    assert Counter(map(tuple, got)) == Counter(want)


@pytest.mark.parametrize("n, k, p", [(1, 0, 0.3), (40, 0, 0.0125), (700, 3, 0.0125), (5000, 40, 0.0125), (200_000, 2400, 0.0125)])
def test_binomial_bound_is_exact(spark, n, k, p):
    terms = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
             for i in range(k + 1)]
    want = math.fsum(map(math.exp, terms))
    column = quality_rules.binomial_cdf(F.col("n"), F.col("k"), p)
    got = spark.createDataFrame([(n, k)], "n long, k long").select(column).first()[0]
    assert got == pytest.approx(want, rel=1e-6)


def labelled(spark, good, bad):
    """Documents of which the bad ones hold many symbols; words differ from text to text."""
    clean = [(i, " ".join(f"w{i}x{k}" for k in range(20)), "en") for i in range(good)]
    junk = [(good + i, " ".join(f"w{i}x{k}###" for k in range(20)), "en") for i in range(bad)]
    docs = spark.createDataFrame(clean + junk, "doc_id long, text string, lang string")
    return docs, docs.select("doc_id", (F.col("doc_id") < good).cast("int").alias("quality"), F.lit(0).alias("toxic"))


def test_cutoffs_need_enough_labels(spark):
    docs, labels = labelled(spark, 1500, 100)
    left = quality_rules.filter_documents(docs, labels)
    assert sorted(r.doc_id for r in left.collect()) == list(range(1500))
    docs, labels = labelled(spark, 300, 100)  # too few to prove anything: the base rule only
    assert quality_rules.filter_documents(docs, labels).count() == 400
    counted = quality_rules.with_counts(labelled(spark, 1500, 100)[0])
    tests = quality_rules.cutoff_tests(counted, labelled(spark, 1500, 100)[1]).where("certified")
    assert tests.where("good_rejected > n_good * 0.0125").count() == 0 and tests.count() > 0


def test_rules_on_edge_cases(edge_docs, no_docs, labels, no_labels):
    left = quality_rules.filter_documents(edge_docs, labels)
    assert left.dtypes == edge_docs.dtypes
    assert {0, 1, 2, 3, 12, 19}.isdisjoint({r.doc_id for r in left.collect()})
    assert quality_rules.filter_documents(no_docs, labels).count() == 0
    assert quality_rules.filter_documents(edge_docs, no_labels).count() == left.count()


def test_classifier_finds_an_interaction_and_held_out_rows():
    chance = np.random.default_rng(0)
    x = chance.normal(size=(6000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = quality_classifier.fit(x[:4000], y[:4000])
    assert (model.score(x[4000:]).round() == y[4000:]).mean() > 0.9
    again = quality_classifier.fit(x[:4000], y[:4000])
    assert (model.score(x) == again.score(x)).all()
    flat = quality_classifier.fit(x[:10], np.ones(10))
    assert flat.score(x).min() == flat.score(x).max() > 0.9


def test_classifier_on_the_tables(spark, sf_dir):
    import zlib

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_classifier.learn(docs, labels)
    scored = quality_classifier.with_score(docs, model).join(labels, "doc_id").toPandas()
    out = scored.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 5 == 0)
    own = docs.select("doc_id", quality_classifier.held_out(F.col("doc_id")).alias("h")).toPandas()
    assert (own.h == own.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 5 == 0)).all()
    held = scored[out]
    good, bad = held[held.quality == 1].score, held[held.quality == 0].score
    pairs = [(g > b) + (g == b) / 2 for g in good for b in bad]
    assert np.mean(pairs) > 0.9 and (good >= 0.3).mean() > 0.95


def test_classifier_on_edge_cases(edge_docs, no_docs, labels, no_labels):
    for table in (labels, no_labels):
        model = quality_classifier.learn(edge_docs, table)
        scores = [r.score for r in quality_classifier.with_score(edge_docs.drop("f_words"), model).collect()]
        assert len(scores) == edge_docs.count() and all(0 <= s <= 1 for s in scores)
        assert quality_classifier.filter_documents(edge_docs, table).dtypes == edge_docs.dtypes
        assert quality_classifier.filter_documents(no_docs, table).count() == 0


def test_sample_of_labels_is_bounded(spark):
    docs, labels = labelled(spark, 800, 200)
    model = quality_classifier.learn(docs, labels, rows=200)
    kept = quality_classifier.with_score(docs, model).groupBy(F.col("doc_id") < 800).agg(F.avg("predicted")).collect()
    assert dict(map(tuple, kept)) == {True: 1.0, False: 0.0}


def test_pipeline_stages_take_edge_cases_and_nothing(spark, edge_docs, no_docs, labels, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sf"))
    labels.write.mode("overwrite").parquet(f"{folder}/labels.parquet")
    edge_docs.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "quality_classifier", "line_dedup", "near_dedup", "best_fit_packing"]
    for docs in (edge_docs, no_docs):
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, folder)
            rows = out.collect()
            if number < 4:
                assert out.dtypes == docs.dtypes and len(rows) <= docs.count()
            else:
                assert {r.doc_id for r in rows} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_near_copies_are_linked_by_their_texts_before_the_cut(spark):
    chance = random.Random(11)
    lines = [" ".join(f"w{chance.randint(0, 9999)}" for _ in range(12)) for _ in range(30)]
    other = [*lines[:10], "one line of its own with a few words more", *lines[10:20], "and another one", *lines[20:]]
    own = [" ".join(f"o{chance.randint(0, 9999)}" for _ in range(12)) for _ in range(30)]
    whole = spark.createDataFrame([
        (1, "\n".join(lines)), (2, "\n".join(other)), (3, "\n".join([*own, *lines[:5]])), (4, "x y"), (4, "x z\nq r")],
        "doc_id long, text string")
    with Scope(spark) as scope:
        cut = scope.stage(line_dedup.filter_documents(whole, scope), "cut")
        texts = {r.doc_id: r.text for r in cut.collect() if r.doc_id < 4}
        assert texts[1] == "\n".join(lines) and len(texts[2]) < 200 and texts[3] == "\n".join(own)
        before = line_dedup.texts_before(cut, whole, scope)
        assert sorted(r.doc_id for r in before.collect()) == [2, 3]
        assert sorted(r.doc_id for r in near_dedup.filter_documents(cut).collect()) == [1, 2, 3, 4, 4]
        assert sorted(r.doc_id for r in near_dedup.filter_documents(cut, before).collect()) == [1, 3, 4, 4]
        changed = cut.withColumn("text", F.concat("text", F.lit(" more")))  # not what is left of the whole texts
        assert line_dedup.texts_before(changed, whole, scope).count() == 0


def test_pipeline_run_equals_its_stages_by_hand(spark, sf_dir):
    """Each stage's decision, taken again from its own operator's verdicts in plain Python."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:4]:
        before = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        docs = stage(spark, docs, sf_dir)
        docs = docs.sparkSession.createDataFrame(docs.collect(), docs.schema)
        after = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        assert after.keys() <= before.keys() and docs.count() == len(after), name
        if name == "line_dedup":
            cut = dict(zip(before, lines_by_hand(list(before.items()))))
            assert after == {d: t for d, t in cut.items() if t == before[d] or t.strip()}
        else:
            assert all(before[d] == t for d, t in after.items()), name
    pieces = corpus_pipeline.run(spark, sf_dir).toPandas()
    assert set(pieces.doc_id) == set(after)
    assert (pieces.groupby("sequence_id").length.sum() <= 2048).all()


def test_long_lines_are_passages_wherever_they_stand(spark):
    line = " ".join(f"p{i}" for i in range(50))
    short = " ".join(f"q{i}" for i in range(49))
    rows = [(1, f"a b\n{line}\nc d"), (2, line), (3, f"x\ny z\n{line}"), (4, f"one\n{short}"), (5, f"{short}\ntwo")]
    with Scope(spark) as scope:
        cut = {r.doc_id: r.text for r in line_dedup.dedup_lines(
            spark.createDataFrame(rows, "doc_id long, text string"), scope).collect()}
        assert cut == {1: rows[0][1], 2: "", 3: "x\ny z", 4: rows[3][1], 5: rows[4][1]}
        kept = line_dedup.filter_documents(spark.createDataFrame(rows, "doc_id long, text string"), scope)
        assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 5]


def test_random_texts_keep_their_first_passage(spark):
    chance = random.Random(9)
    passage = [" ".join(f"p{chance.randint(0, 999)}" for _ in range(8)) for _ in range(40)]
    rows = [(i, "\n".join([f"own {i} a b", *passage, f"own {i} c d"])) for i in range(5)]
    with Scope(spark) as scope:
        cut = {r.doc_id: r.text for r in line_dedup.dedup_lines(
            spark.createDataFrame(rows, "doc_id long, text string"), scope).collect()}
    assert cut[0] == rows[0][1]
    for i in range(1, 5):
        assert f"own {i} a b" in cut[i] and len(cut[i]) < 0.3 * len(rows[i][1])
