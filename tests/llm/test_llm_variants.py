"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from runlens.llm import variants
from runlens.sources.staging import Scope

DOCS = "doc_id long, text string, word string, n long, key string, form string"


def near(a, b):
    """One inserted, deleted or replaced code point apart."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def by_hand(rows):
    counts = Counter()
    for doc_id, text in rows:
        plain = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", plain):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    form, rows = {}, []
    for w, n in words.items():
        others = sorted((-m, o) for o, m in words.items() if near(w, o))
        form[w] = others[0][1] if others and -others[0][0] >= 10 * n else None
        rows.append([w, form[w], n, len(others), -others[0][0] if form[w] else None])
    for row in rows:
        root = row[0]
        while form[root]:
            root = form[root]
        row.insert(2, root)
    return sorted(map(tuple, rows))


def found(df):
    with Scope(df.sparkSession) as scope:
        return sorted(tuple(r) for r in variants.variants(df, scope).select(
            "word", "form", "root", "n", "n_near", "form_n").collect())


def table(spark, rows):
    return spark.createDataFrame([(*r, "own", 1, "own", "own") for r in rows], DOCS).repartition(4)


def misspelt(seed):
    """Texts of few words, often and seldom misspelt by one letter or more."""
    chance = random.Random(seed)
    letters = "abcdeéßÀxyz"
    words = ["".join(chance.choice(letters) for _ in range(chance.randint(6, 12))) for _ in range(40)]
    rows = []
    for doc_id in range(60):
        text = []
        for _ in range(120):
            w = chance.choice(words[: chance.randint(1, 40)])
            for _ in range(chance.choice([0, 0, 0, 0, 0, 1, 1, 2])):
                i, kind = chance.randrange(len(w)), chance.randrange(3)
                w = w[:i] + (chance.choice("aeé") if kind else "") + w[i + (kind != 1) :]
            text.append(w.upper() if chance.random() < 0.1 else w)
        rows.append((doc_id if doc_id % 7 else None, chance.choice([" ", "-", "1"]).join(text)))
    return rows + rows[:3] + [(100, None), (101, ""), (None, " \n"), (102, "z" * 30_000 + " " + "z" * 30_000)]


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_equal_brute_force(spark, seed):
    rows = misspelt(seed)
    want = by_hand(rows)
    assert found(table(spark, rows)) == want
    assert sum(form is not None for _, form, *_ in want) > 5 and max(len(w) for w, *_ in want) == 30_000


def test_chains_end_at_their_root_and_ties_take_the_first(spark):
    counts = {"aaaaaaaa": 2, "aaaaaaab": 20, "aaaaaabb": 200, "aaaaabbb": 2000, "qqqqqqq": 2, "qqqqqqqa": 20, "qqqqqqqb": 20}
    # documents whose checksum spares the word
    rows = [(next(d for d in range(100) if zlib.crc32(f"{d}:{w}".encode()) % 31), " ".join([w] * n)) for w, n in counts.items()]
    got = {w: (form, root, n, m, f) for w, form, root, n, m, f in found(table(spark, rows))}
    assert got["aaaaaaaa"] == ("aaaaaaab", "aaaaabbb", 2, 1, 20)
    assert got["aaaaabbb"] == (None, "aaaaabbb", 2000, 1, None)
    assert got["qqqqqqq"] == ("qqqqqqqa", "qqqqqqqa", 2, 2, 20)
    assert found(table(spark, rows)) == by_hand(rows)


def test_edge_cases_and_nothing(edge_docs, edge_rows, no_docs):
    assert found(edge_docs) == by_hand([(r[0], r[1]) for r in edge_rows])
    assert found(no_docs) == []


def test_near_words_share_a_signature():
    chance = random.Random(5)
    pairs = []
    for _ in range(3000):
        a = "".join(chance.choice("abcé") for _ in range(chance.randint(7, 15)))
        i, kind = chance.randrange(len(a)), chance.randrange(3)
        b = a[:i] + (chance.choice("abcd") if kind else "") + a[i + (kind != 1) :]
        if a != b:
            pairs.append(sorted((a, b), key=len))
    left, longer = variants.signatures([a for a, _ in pairs])
    right, _ = variants.signatures([b for _, b in pairs])
    for x, y, (a, b) in zip(left, right, pairs):
        assert np.isin(x[~longer], y[~longer] if len(a) == len(b) else y[longer]).any(), (a, b)


def test_words_are_counted_in_parts_of_bounded_size(spark, monkeypatch):
    rows = misspelt(3)
    want = found(table(spark, rows))
    monkeypatch.setattr(variants, "HELD", 5)
    assert found(table(spark, rows)) == want
