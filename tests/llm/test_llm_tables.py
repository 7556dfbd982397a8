"""URL filter, top-k search and sharding."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from runlens.llm import sharding, topk, url_filter
from runlens.sources.staging import Scope


def test_rules_and_parts_of_urls(spark):
    rows = [
        (1, "http://A.Example.net/en/x?q", "a.example.net", "/en/x", "example.net/en/", "allow"),
        (2, "http://a.example.net/de/", "a.example.net", "/de/", "net/", "block"),
        (3, "http://badexample.net", "badexample.net", "", None, "allow"),
        (4, "http://example.com/de/1#f", "example.com", "/de/1", "example.com/de/", "block"),
        (5, "http://notexample.com/de/1", "notexample.com", "/de/1", None, "allow"),
        (6, "https://org/fr/", "org", "/fr/", "org/fr/", "allow"),
        (7, "no scheme", "", "", None, "allow"), (8, None, "", "", None, "allow"), (9, "", "", "", None, "allow"),
        (10, "x://h?://i/", "h", "", None, "allow"), (10, "x://h?://i/", "h", "", None, "allow"),
        (11, "ftp://ÄB.net:80/", "Äb.net:80", "/", None, "allow"),
    ]
    pages = spark.createDataFrame([(r[0], r[1], "own", "own") for r in rows], "page_id long, url string, rule string, bound string")
    none = spark.createDataFrame([], "url string, bad boolean")
    for outcomes in (none, pages.select("url", F.lit(None).cast("boolean").alias("bad"))):
        got = url_filter.judge(pages, outcomes).select("page_id", "url", "host", "path", "rule", "verdict").collect()
        assert Counter(map(tuple, got)) == Counter(rows)
    assert url_filter.judge(pages.limit(0), none).count() == 0


def reputation_by_hand(rows):
    """Bounds per host from (host, domain, suffix, n, x), in plain Python."""
    def weight(groups):
        groups = [g for g in groups if g[0] > 0]
        chance = sum(m * (1 - m) for _, _, m in groups)
        found = sum((x - n * m) ** 2 / n for n, x, m in groups)
        r = (found - chance) / (sum(n * m * (1 - m) for n, _, m in groups) - chance)
        return 1 / max(1e-4, min(0.99, r)) - 1

    def sums(keys):
        out = {}
        for row in rows:
            n, x = out.get(row[keys], (0, 0))
            out[row[keys]] = (n + row[3], x + row[4])
        return out

    everything = (sum(r[4] for r in rows) + 0.5) / (sum(r[3] for r in rows) + 1)
    suffixes, domains, hosts = sums(2), sums(1), sums(0)
    domain_of = {r[0]: (r[1], r[2]) for r in rows}
    suffix_of = {r[1]: r[2] for r in rows}
    w = weight([(n, x, everything) for n, x in suffixes.values()])
    up = {s: (w * everything + x) / (w + n) for s, (n, x) in suffixes.items()}
    w = weight([(n, x, up[suffix_of[d]]) for d, (n, x) in domains.items()])
    mid = {d: (w * up[suffix_of[d]] + x) / (w + n) for d, (n, x) in domains.items()}
    w = weight([(n, x, mid[domain_of[h][0]]) for h, (n, x) in hosts.items()])
    bounds = {}
    for h, (n, x) in hosts.items():
        mean = (w * mid[domain_of[h][0]] + x) / (w + n)
        bounds[h] = mean - 1.645 * math.sqrt(mean * (1 - mean) / (w + n + 1))
    return bounds


def test_reputation_shrinks_and_blocks_bad_hosts(spark):
    chance = random.Random(5)
    rows, counted = [], []
    for d in range(6):
        for h in range(5):
            domain, suffix = f"d{d}.{'com' if d % 2 else 'co.uk'}", "com" if d % 2 else "co.uk"
            rate = 0.9 if (d, h) == (1, 1) else 0.6 if d == 2 else 0.03
            n = chance.randint(1, 60)
            bad = [chance.random() < rate for _ in range(n)]
            rows += [(f"http://h{h}.{domain}/p", b) for b in bad]
            counted.append((f"h{h}.{domain}", domain, suffix, n, sum(bad)))
    outcomes = spark.createDataFrame(rows, "url string, bad boolean").repartition(5)
    got = {r.host: r.bound for r in url_filter.host_reputation(url_filter.with_parts(outcomes)).collect()}
    want = reputation_by_hand(counted)
    assert got.keys() == want.keys() and all(got[h] == pytest.approx(want[h]) for h in want)
    pages = spark.createDataFrame([(h, f"http://{h}/x") for h, *_ in counted], "page_id string, url string")
    blocked = {r.page_id for r in url_filter.judge(pages, outcomes).where("verdict = 'block'").collect()}
    assert blocked == {h for h in want if want[h] > url_filter.LIMIT} and any(".d2." in h for h in blocked)
    assert not any(".d3." in h for h in blocked)


def top_by_hand(rows, k):
    """Every query's best rows of (vec_id, vector), compared one by one in whole numbers."""
    good = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for query, q in {(i, tuple(v)) for i, v in good if i % 100 == 0}:
        scores = sorted((-sum(a * b for a, b in zip(q, c)), i) for i, c in good if i != query and len(c) == len(q))
        out |= {(query, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])}
    return out


@pytest.mark.parametrize("tile, queries, fan", [(8192, 2048, 32), (7, 2, 2)])
def test_search_equals_brute_force(spark, monkeypatch, tile, queries, fan):
    monkeypatch.setattr(topk, "TILE", tile)
    monkeypatch.setattr(topk, "QUERY_TILE", queries)
    monkeypatch.setattr(topk, "FAN", fan)
    chance = random.Random(7)
    rows = [(i, [chance.choice([-1.0, -0.5, 0.0, 0.25, 1.5]) for _ in range(4)]) for i in range(0, 500, 9)]
    rows += [(i, [1.0, 0.5, 0.25, 1.5]) for i in (100, 200, 201, 202, 203, 300)]  # ties
    rows += [(400, [1e18, 1.0, -1e18, 0.5]), (5, [1e17, 2.0, 1e17, 0.5])]  # sums beyond 2^53
    rows += [(600, [0.5, 0.5]), (601, [1.0, 1.0]), (700, [1.0, None, 0.0, 0.0]), (800, [float("nan")] * 4),
             (900, [float("inf"), 0.0, 0.0, 0.0]), (1000, None), (1100, []), (None, [1.0] * 4), (1200, [7.0])]
    # scores past 64 bits are held at the limits, so keep the two large vectors within them
    rows = [(i, v) for i, v in rows if i not in (400, 5)] + [(400, [1e8, 1.0, -1e8, 0.5]), (5, [1e7, 2.0, 1e7, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    with Scope(spark) as scope:
        got = topk.search(df, df.where("vec_id % 100 = 0"), 10, scope).collect()
    assert {tuple(r) for r in got} == top_by_hand(rows, 10) and len(got) == len({tuple(r) for r in got})


def test_search_of_nothing_and_of_repeated_rows(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int, tile int")
    same = spark.createDataFrame([(0, [1.0])] * 3 + [(1, [2.0])] * 12, "vec_id long, embedding array<float>")
    with Scope(spark) as scope:
        assert topk.search(empty, empty, 10, scope).count() == 0
        got = topk.search(same, same.where("vec_id = 0"), 10, scope).collect()
    assert [tuple(r) for r in sorted(got)] == [(0, n, 1, 2048 * 1024) for n in range(1, 11)]


def shards_of(spark, docs, shards=8):
    with Scope(spark) as scope:
        return sharding.shard(docs, scope, shards).select("doc_id", "text", "size", "shard", "slot").toPandas()


def test_shards_are_balanced_and_gapless(spark):
    chance = random.Random(11)
    rows = [(i, "z" * chance.randint(0, 400)) for i in range(6000)]
    rows += [(6000 + i, "hot text " * 12) for i in range(3000)]  # a third of all rows
    rows += [(9999, "hot text " * 12)] * 500 + [(7, None)] * 20
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = shards_of(spark, docs)
    assert Counter(zip(got.doc_id, got.text.where(got.text.notna(), None))) == Counter(rows)
    assert (got["size"] == got.text.map(lambda t: len(t.encode()) if t else 0) + 16).all()
    for _, part in got.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    loads = got.groupby("shard")["size"].sum()
    assert len(loads) == 8 and loads.max() - loads.min() < 0.03 * loads.mean()


def test_equal_texts_stay_together_where_they_can(spark):
    rows = [(i, f"text number {i // 4} " * 3) for i in range(4000)]
    got = shards_of(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert (got.groupby("text").shard.nunique() > 1).sum() <= 7  # at most one per border


def test_shards_of_edge_cases(spark, edge_docs, edge_rows, no_docs):
    got = shards_of(spark, edge_docs, 40)
    assert len(got) == len(edge_rows) and got.shard.between(0, 39).all()
    for _, part in got.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    assert shards_of(spark, no_docs).empty


def test_written_shards_hold_every_row(spark, edge_docs, tmp_path):
    with Scope(spark) as scope:
        sharding.write_shards(edge_docs, str(tmp_path / "shards"), scope, 4)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == edge_docs.count() and back.select("shard").distinct().count() <= 4


def test_checksums_are_unsigned(spark):
    got = spark.createDataFrame([("é",), (None,)], "t string").select(
        F.crc32(F.coalesce("t", F.lit("")).cast("binary")).alias("c")).collect()
    assert [r.c for r in got] == [zlib.crc32("é".encode()), 0]


def test_tile_selection_keeps_ties_in_order():
    ids = np.array([9, 3, 5, 1, 7])
    rows = np.ones((5, 2))
    q, r, s = topk.best_of_tile(np.ones((1, 2)), rows, np.array([100]), ids, 3)
    assert sorted(ids[r].tolist()) == [1, 3, 5] and set(s.tolist()) == {2} and set(q.tolist()) == {0}
