"""Spelling variants of words, grouped under the most frequent form.

1. Runs of letters are counted in the tasks that read the texts, and the counts added over the table:
   a word, however frequent, is one partial row per task. Only distinct words move from here on.
2. A word is the multiset of its letters, as a binary vector with one place for every letter and
   occurrence. One inserted or deleted letter changes one place, a replaced one two, so near words have a
   Hamming distance of at most two. Their places are partitioned into ``PARTS`` parts; of any two near
   words at least ``PARTS - 2`` parts are equal, so the enumerated signatures are the sets of so many parts.
3. An edit also leaves two thirds of the positions alone. A signature therefore holds, besides its
   parts, two of the three thirds of the word as they are written, in the three ways there are, for the word
   as the shorter one of a pair and as the longer one. Words whose multisets agree by chance share none.
4. Words meet by an equi-join on signatures and are verified by their edit distance inside the join, so
   that only near pairs become rows. The join is of written rows, so that a hot signature's rows are split.
5. Each word takes its most frequent near word as its form if that is ``TIMES`` times as frequent. As a
   form is so much more frequent, chains of forms are short, and pointer doubling finds their ends in
   a number of rounds known from the largest count.

Edge cases. Null, empty or blank texts hold no words. A null doc_id counts as an empty text where words are
drawn for deletion. Repeated rows count each. Of equally frequent forms the first in code-point order is
taken. Very long words are hashed in one pass like others. Empty table: no rows. Other columns of
the input are not read.
"""

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from math import log10

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.llm.batches import bounded
from runlens.llm.shingles import mix
from runlens.sources.staging import Scope

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH = 7
LEAST_COUNT = 2
TIMES = 10
#: One run in so many loses a letter, chosen by the checksum of document and run.
DRAWN = 31
DISTANCE = 2
PARTS = 3
HELD = 400_000  # words counted in a task before they are handed on
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})


def lowered(text: str) -> str:
    """``text`` with A-Z lower-cased, other letters as they are."""
    return text.lower() if text.isascii() else text.translate(_LOWER)


def drawn_word(doc_id: str, run: str) -> str:
    """The run, or the run without one letter if the checksum of document and run says so."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % DRAWN:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    runs = re.compile(f"[{LETTERS}]{{{LEAST_LENGTH},}}")  # greedy, so each match is a whole run
    held: Counter[str] = Counter()

    def handed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    for batch in bounded(batches):
        for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
            for run, n in Counter(runs.findall(lowered(text or ""))).items():
                word = drawn_word(doc_id, run)
                if len(word) >= LEAST_LENGTH:
                    held[word] += n
            if len(held) > HELD:
                yield handed()
                held.clear()
    yield handed()


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n): the words of the texts that are long and frequent enough."""
    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")
    found = texts.mapInArrow(_counted, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _part_sums(letters: np.ndarray, owner: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """For each part a hash of the places that every word has in it; equal sets have equal hashes."""
    order = np.lexsort((letters, owner))
    letter, word = letters[order], owner[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (letter[1:] != letter[:-1]) | (word[1:] != word[:-1])
    starts = np.flatnonzero(fresh)
    occurrence = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    place = mix(mix(letter.astype(np.uint64) | (occurrence.astype(np.uint64) << np.uint64(32))) + np.uint64(1))
    part = (place >> np.uint64(40)) % np.uint64(PARTS)
    sums = []
    for p in range(PARTS):
        total = np.concatenate([[np.uint64(0)], np.cumsum(np.where(part == p, place, np.uint64(0)), dtype=np.uint64)])
        sums.append(total[bounds[1:]] - total[bounds[:-1]])
    return sums


def signatures(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(keys, words x signatures; whether each signature is of the word as the longer one). A word is the
    shorter one in pairs of its own length, too."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    owner = np.repeat(np.arange(len(words)), lengths)
    with np.errstate(over="ignore"):
        parts = _part_sums(letters, owner, bounds)
        count = len(letters) + 1
        up, down = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(count - 1, b, np.uint64)]), dtype=np.uint64)
                    for b in (_BASE, pow(_BASE, -1, 2**64)))
        rolled = np.concatenate([[np.uint64(0)], np.cumsum(mix(letters.astype(np.uint64)) * up[:-1], dtype=np.uint64)])
        first, end = bounds[:-1], bounds[1:]

        def span(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return mix((rolled[b] - rolled[a]) * down[a])

        keys, longer = [], []
        for long in (False, True):
            least = lengths - long  # length of the shorter word of a pair
            third, two = least // 3, 2 * least // 3
            thirds = [
                span(first, first + two),
                mix(span(first, first + third)) + span(end - (least - two), end),
                span(end - (least - third), end),
            ]
            for way, written in enumerate(thirds):
                for number, chosen in enumerate(combinations(range(PARTS), PARTS - DISTANCE)):
                    kind = np.uint64(1 + way * 1000 + number)
                    key = mix(written + mix(least.astype(np.uint64) * np.uint64(2**16) + kind))
                    keys.append(mix(key ^ mix(sum(parts[p] for p in chosen) + np.uint64(3))))
                    longer.append(long)
    return np.stack(keys, axis=1), np.array(longer)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) -> one row per signature."""
    for batch in bounded(batches, "word", 1 << 20):
        keys, longer = signatures(batch.column("word").to_pylist())
        rows = pa.array(np.repeat(np.arange(batch.num_rows), keys.shape[1]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.ravel().view(np.int64)), batch.column("word").take(rows), batch.column("n").take(rows),
             pa.array(np.tile(longer, batch.num_rows))], names=["key", "word", "n", "longer"])


def near_words(words: DataFrame, scope: Scope) -> DataFrame:
    """(word, n, other, other_n): each two words that differ by one inserted, deleted or replaced letter, in
    both orders, ``words`` being distinct."""
    signed = scope.stage(words.select("word", "n").mapInArrow(_signed, "key long, word string, n long, longer boolean"),
                         "signatures")
    x, y = signed.where("NOT longer").hint("merge").alias("x"), signed.alias("y")
    met = (F.col("x.key") == F.col("y.key")) & (F.col("y.longer") | (F.col("x.word") < F.col("y.word"))) & (
        F.levenshtein("x.word", "y.word", 1) == 1)
    pairs = scope.stage(x.join(y, met).select(
        F.col("x.word").alias("word"), F.col("x.n").alias("n"), F.col("y.word").alias("other"),
        F.col("y.n").alias("other_n")).distinct(), "near-words")
    return pairs.union(pairs.select("other", "other_n", "word", "n"))


def roots_of(forms: DataFrame, most: int, scope: Scope) -> DataFrame:
    """(word, root): the end of each chain of (word, form), along which counts grow by ``TIMES`` up to
    ``most``."""
    steps = 1 + int(log10(max(most, 1)) / log10(TIMES))  # forms that a chain has at most
    roots = forms.select("word", F.col("form").alias("root"))
    done = 1
    while done < steps:
        ahead = roots.select(F.col("word").alias("at"), F.col("root").alias("end"))
        roots = scope.stage(roots.join(ahead.hint("merge"), F.col("root") == F.col("at"), "left").select(
            "word", F.coalesce("end", "root").alias("root")), "roots")
        done *= 2
    return roots


def variants(docs: DataFrame, scope: Scope) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``docs``. It reads tables of ``scope``."""
    words = scope.stage(count_words(docs), "words")
    near = near_words(words, scope).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("rank"), "other")).alias("best"))
    best_n = -F.col("best.rank")
    takes = best_n >= TIMES * F.col("n")
    formed = scope.stage(words.join(near.hint("merge"), "word", "left").select(
        "word", F.when(takes, F.col("best.other")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(takes, best_n).alias("form_n")), "forms")
    most = words.agg(F.max("n").alias("n")).first().n or 1
    ends = roots_of(formed.where("form IS NOT NULL").select("word", "form"), most, scope)
    return formed.join(ends.hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
