import random
import re

import numpy as np
import pyarrow as pa
import pytest

from runlens.llm import near_dedup
from runlens.llm.batches import bounded
from runlens.llm.components import components_of_each, connected_components
from runlens.llm.shingles import shingle_sets
from runlens.sources.staging import Scope

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if 0 < len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_force(rows):
    """Component of every row, by its position, comparing all pairs."""
    sets = [shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc_id)
    smallest = {g: min((d for d in ids if d is not None), default=None) for g, ids in groups.items()}
    return sorted(((rows[i][0], len(sets[i]), smallest[find(i)]) for i in range(len(rows))), key=str)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(df).collect()), key=str)


def test_sets_equal_the_shingles_of_each_text(edge_rows):
    texts = [r[1] for r in edge_rows]
    values, offsets = shingle_sets(pa.array(texts))
    assert np.diff(offsets).tolist() == [len(shingles(t)) for t in texts]
    same = {}
    for t, a, b in zip(texts, offsets[:-1], offsets[1:]):
        assert same.setdefault(shingles(t), values[a:b].tobytes()) == values[a:b].tobytes()
    assert len(set(same.values())) == len(same)


def test_slices_of_a_batch_have_the_sets_of_their_own_texts(edge_rows):
    for texts in ([r[1] for r in edge_rows], [r[1] or "" for r in edge_rows]):
        whole = pa.array(texts, pa.string())
        for at in range(len(texts)):
            for part, alone in ((whole.slice(at), pa.array(texts[at:], pa.string())),
                                (whole.slice(at, 2), pa.array(texts[at : at + 2], pa.string()))):
                for x, y in zip(shingle_sets(part), shingle_sets(alone)):
                    assert (x == y).all()


def test_partitions_of_many_slices_equal_brute_force(spark):
    """One partition of more than 8 MB, so that batches are cut into slices."""
    rows = []
    for k in range(24):
        words = [f"Doc{k % 20}Word{i}" for i in range(36_000 - 500 * (k // 20))]
        rows.append((k, " ".join(words)))
    assert sum(len(text) for _, text in rows) > 8 << 20
    assert found(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)) == brute_force(rows)


def test_edge_cases_equal_brute_force(edge_docs, edge_rows):
    assert found(edge_docs) == brute_force([(r[0], r[1]) for r in edge_rows])


def test_empty_table(no_docs):
    assert near_dedup.near_duplicates(no_docs).count() == 0
    assert near_dedup.filter_documents(no_docs).columns == no_docs.columns


def family(count, edits, seed):
    """Variants of one text with up to ``edits`` of its words replaced: many pairs near the threshold."""
    chance = random.Random(seed)
    base = [f"w{chance.randint(0, 400)}" for _ in range(120)]
    rows = []
    for i in range(count):
        words = list(base)
        for at in chance.sample(range(120), chance.randint(0, edits)):
            words[at] = f"e{seed}x{i}x{at}"
        rows.append((1000 * seed + i, " ".join(words)))
    return rows


@pytest.mark.parametrize("block", [16, 512])
def test_families_of_variants_lose_no_link(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rows = family(120, 9, 1) + family(60, 5, 2) + [(i, f"text {i} " + "alone " * i) for i in range(20)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == brute_force(rows)


def test_short_texts_that_differ_in_one_word_lose_no_link(spark):
    rows = []
    for size in range(5, 21):
        for k in range(60):
            words = [f"s{size}x{k}x{i}" for i in range(size)]
            other = [[*words, "more"], [*words[:-1], "other"], ["more", *words]][k % 3]
            rows += [(len(rows) + i, " ".join(w)) for i, w in enumerate((words, other))]
    want = brute_force(rows)
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == want
    assert sum(doc_id != component for doc_id, _, component in want) > 500


@pytest.mark.parametrize("shared", [30, 600])  # sets that are listed, and sets that are estimated
def test_hot_buckets_are_compared_in_blocks(spark, monkeypatch, shared):
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    passage = " ".join(f"p{i}" for i in range(shared))
    own = [" ".join(f"o{k}x{i}" for i in range(shared * 2 // 3)) for k in range(30)]
    rows = [(k, f"{passage} {text}") for k, text in enumerate(own)]
    rows += [(100 + k, f"{passage} {text} and {k} more") for k, text in enumerate(own[:10])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    original, kept = Scope.stage, {}

    def stage(self, df, name):
        kept[name] = original(self, df, name)
        if name == "mates":
            kept["largest"] = max([0, *[r["count"] for r in kept[name].groupBy("key").count().collect()]])
        return kept[name]

    monkeypatch.setattr(Scope, "stage", stage)
    assert found(docs) == brute_force(rows)
    assert kept["largest"] <= 8  # no larger bucket is joined with itself


def test_a_large_family_of_a_hot_bucket_has_blocks_of_its_own(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    passage = " ".join(f"p{i}" for i in range(600))
    own = [" ".join(f"o{k}x{i}" for i in range(400)) for k in range(20)]
    rows = [(k, f"{passage} {text}") for k, text in enumerate(own)]
    rows += [(100 + k, f"{passage} {own[0]} and {k} more") for k in range(24)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    original, large = Scope.stage, []

    def stage(self, df, name):
        table = original(self, df, name)
        if name == "dealt":
            large.extend(r.large for r in table.collect())
        return table

    monkeypatch.setattr(Scope, "stage", stage)
    assert found(docs) == brute_force(rows)
    assert max(f.n for bucket in large for f in bucket) == 4  # 25 near copies, which are not compared once more


def test_one_row_of_each_component_stays(edge_docs, edge_rows):
    left = near_dedup.filter_documents(edge_docs).collect()
    components = {c for _, n, c in brute_force([(r[0], r[1]) for r in edge_rows]) if n}
    with_words = [r for r in left if shingles(r.text)]
    assert sorted(r.doc_id for r in with_words) == sorted(components)
    assert left[0].asDict().keys() == set(edge_docs.columns) and left[0].kept.startswith("own")


def test_estimate_is_close_and_registers_do_not_depend_on_the_batch():
    chance = np.random.default_rng(1)
    a = np.unique(chance.integers(0, 2**63, 4000, dtype=np.uint64))
    b = np.unique(np.concatenate([a[:3200], chance.integers(0, 2**63, 800, dtype=np.uint64)]))
    alone = [near_dedup.sketch(x, np.array([0, len(x)])) for x in (a, b)]
    both = near_dedup.sketch(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
    assert (both == np.vstack(alone)).all()
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs(near_dedup.estimate(both[:1], both[1:])[0] - true) < 0.1


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 20)] + [(7, 7), (201, 200), (200, 201)]
    with Scope(spark) as scope:
        got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long"), scope).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{100 + i: 100 for i in range(20)}, 200: 200, 201: 200}


def test_components_of_several_tables_share_their_rounds(spark):
    tables = [[(i, i + 1) for i in range(9)], [(9, 3), (3, 5), (20, 21)], []]
    with Scope(spark) as scope:
        graphs = [spark.createDataFrame(links, "a long, b long") for links in tables]
        got = [{r.node: r.root for r in found.collect()} for found in components_of_each(graphs, scope)]
    assert got == [{i: 0 for i in range(10)}, {3: 3, 5: 3, 9: 3, 20: 20, 21: 20}, {}]


def test_rounds_of_components_take_few_stages_and_leave_one_table(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 20)]
    staged, original = [], Scope.stage
    sc = spark.sparkContext

    class Counting(Scope):
        def stage(self, df, name):
            staged.append(name)
            return original(self, df, name)

    with Counting(spark) as scope:
        pairs = original(scope, spark.createDataFrame(links, "a long, b long"), "pairs")
        sc.setJobGroup("rounds-of-components", "")
        try:
            connected_components(pairs, scope)
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
        assert len(scope.paths) == 2  # the pairs and the last round
    tracker = sc.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("rounds-of-components") for s in tracker.getJobInfo(j).stageIds}
    ran = [s for s in stages if (info := tracker.getStageInfo(s)) and info.numCompletedTasks]
    assert len(ran) <= 5 * len(staged) and len(staged) >= 3


def test_slices_are_bounded_by_bytes_and_rows_and_leave_the_sketches_alike(monkeypatch):
    texts = ["a b c d e f", None, "", "x " * 300, "short", *[f"w{i} " * 9 + f"v{i}" for i in range(40)], "y z " * 500]
    batch = pa.RecordBatch.from_pydict(
        {"doc_id": list(range(len(texts))), "xh": [0] * len(texts), "text": texts},
        pa.schema([("doc_id", pa.int64()), ("xh", pa.int64()), ("text", pa.string())]))
    slices = list(bounded([batch, batch.slice(3, 0), batch.slice(2, 9)], most=100, rows=4))
    assert pa.Table.from_batches(slices).equals(pa.Table.from_batches([batch, batch.slice(2, 9)]))
    assert max(s.num_rows for s in slices) <= 4 and min(s.num_rows for s in slices) >= 1
    assert [s.num_rows for s in bounded([batch], most=1 << 30, rows=20)] == [20, 20, len(texts) - 40]
    assert [s.num_rows for s in bounded([batch], most=1 << 30)] == [len(texts)]
    whole = pa.Table.from_batches(near_dedup._sketches([batch])).to_pylist()
    monkeypatch.setattr(near_dedup, "SLICE_BYTES", 64)
    monkeypatch.setattr(near_dedup, "SLICE_ROWS", 3)
    assert pa.Table.from_batches(near_dedup._sketches([batch])).to_pylist() == whole
