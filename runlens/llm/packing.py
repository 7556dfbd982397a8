"""Documents cut into token pieces and packed into as few fixed-length sequences as possible.

Packing needs no document, only how many pieces there are of each length: a table of at most
``CAPACITY`` numbers, whatever the corpus. Over it the driver plans runs of equal bins:

* a full piece is a sequence of its own;
* large items, above a third of the capacity, pair at most twice per bin: going down from the
  longest, each is matched with the longest large item that still fits;
* small items, longest first, go into the tightest gap that takes them, and open a new bin only if
  there is none.

Runs of equal bins are split rather than listed, so the plan has some thousand entries at most. A
piece finds its place by its length and its rank among the pieces of this length, which is its rank
within its task's part plus the counts of the parts before it. No group of pieces is collected.

Edge cases. Null text counts as empty, an empty document as its end mark alone. Repeated rows and ties
are pieces like any other, in no particular order. Null doc_id: packed, with a null id. Long texts are
tokenized whole. Empty table: no rows.
"""

from bisect import bisect_left, insort
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runlens.llm.batches import bounded
from runlens.llm.byte_bpe import encoder
from runlens.sources.staging import Scope

CAPACITY = 2048
END = 0

_PIECES = "piece int, start long, length int, ids binary, part int, rank_in_part long"
_NAMES = ["doc_id", *[c.split()[0] for c in _PIECES.split(", ")]]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids, part, rank_in_part): the pieces of every document, ``ids``
    as little-endian 32-bit numbers. A document longer than ``capacity`` is cut into full pieces,
    but for its first one. ``part`` and ``rank_in_part`` number the pieces of each length."""

    def pieces(batches):
        encode = encoder(tokenizer)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in bounded(batches):
            owner, piece, start, ids = [], [], [], []
            for row, tokens in enumerate(encode(batch.column("text"))):
                tokens = np.append(tokens, np.uint32(END))
                first = len(tokens) % capacity or capacity
                cuts = [0, *range(first, len(tokens) + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                    owner.append(row)
                    piece.append(k)
                    start.append(a)
                    ids.append(tokens[a:b].tobytes())
            lengths = np.fromiter((len(x) // 4 for x in ids), np.int64, len(ids))
            order = np.argsort(lengths, kind="stable")  # rank within equal lengths, in one pass
            ordered = lengths[order]
            runs = np.arange(len(ids)) - np.searchsorted(ordered, ordered)
            ranks = np.empty(len(ids), np.int64)
            ranks[order] = runs + seen[ordered]
            seen += np.bincount(lengths, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(lengths, pa.int32()), pa.array(ids, pa.binary()),
                 pa.array(np.full(len(ids), part), pa.int32()), pa.array(ranks)], names=_NAMES)

    key = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(pieces, f"doc_id {key}, {_PIECES}")


@dataclass
class Run:
    """``bins`` equal sequences from number ``first`` on, each filled up to ``used``."""

    first: int
    bins: int
    used: int


@dataclass
class Placement:
    """Pieces of one length with ranks from ``rank`` on: ``per_bin`` into each sequence from ``first``
    on, beginning at ``offset``."""

    length: int
    rank: int
    first: int
    per_bin: int
    offset: int


def plan_sequences(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Placement], int]:
    """Placements of all pieces, ``counts`` of them per length, and the number of sequences."""
    left = {length: n for length, n in counts.items() if n > 0}
    ranks: dict[int, int] = defaultdict(int)
    placements: list[Placement] = []
    gaps: dict[int, list[Run]] = defaultdict(list)
    widths: list[int] = []  # gaps with runs, ascending
    total = 0

    def keep(run: Run) -> None:
        gap = capacity - run.used
        if gap and run.bins:
            if not gaps[gap]:
                insort(widths, gap)
            gaps[gap].append(run)

    def put(length: int, run: Run, per_bin: int) -> None:
        placements.append(Placement(length, ranks[length], run.first, per_bin, run.used))
        ranks[length] += run.bins * per_bin
        left[length] -= run.bins * per_bin
        run.used += per_bin * length

    def open_bins(bins: int) -> Run:
        nonlocal total
        total += bins
        return Run(total - bins, bins, 0)

    large = sorted(length for length in left if 3 * length > capacity)
    for length in reversed(large):
        while left[length]:
            # the longest partner that fits; itself included, but then two are used per bin
            at = bisect_left(large, capacity - length + 1) - 1
            while at >= 0 and (not left[large[at]] or (large[at] == length and left[length] < 2)):
                at -= 1
            if at < 0:
                run = open_bins(left[length])
                put(length, run, 1)
            elif large[at] == length:
                run = open_bins(left[length] // 2)
                put(length, run, 2)
            else:
                run = open_bins(min(left[length], left[large[at]]))
                put(length, run, 1)
                put(large[at], run, 1)
            keep(run)

    for length in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        while left[length]:
            at = bisect_left(widths, length)
            if at == len(widths):
                bins = -(-left[length] // (capacity // length))
                run = open_bins(bins)
            else:
                gap = widths[at]
                run = gaps[gap].pop()
                if not gaps[gap]:
                    widths.pop(at)
            fit = (capacity - run.used) // length
            full = min(run.bins, left[length] // fit)
            if full:
                rest = Run(run.first + full, run.bins - full, run.used)
                run.bins = full
                put(length, run, fit)
                keep(run)
                run = rest
            if run.bins and 0 < left[length] < fit:  # the last bin takes what is left
                rest = Run(run.first + 1, run.bins - 1, run.used)
                run.bins = 1
                put(length, run, left[length])
                keep(run)
                run = rest
            keep(run)
    return placements, total


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (as written by :func:`token_pieces`) with ``sequence_id`` and ``offset``; token
    columns are read only if they are selected."""
    counted = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counted.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    lengths = {r.length: r.n for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    placements, _ = plan_sequences(lengths, capacity)  # at most ``capacity`` rows were collected
    placements.sort(key=lambda p: (p.length, p.rank))
    plan = np.array([(p.length, p.rank, p.first, p.per_bin, p.offset) for p in placements], np.int64).reshape(-1, 5)
    begins = np.searchsorted(plan[:, 0], np.arange(capacity + 2))

    @F.pandas_udf("struct<sequence_id long, offset long>")
    def place(length, rank):
        size, r = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        at = np.empty(len(size), np.int64)
        for value in np.unique(size):
            own = size == value
            a, b = begins[value], begins[value + 1]
            at[own] = a + np.searchsorted(plan[a:b, 1], r[own], side="right") - 1
        row = plan[at]
        nth = r - row[:, 1]
        return pd.DataFrame({"sequence_id": row[:, 2] + nth // row[:, 3],
                             "offset": row[:, 4] + nth % row[:, 3] * size})

    ranked = pieces.join(bases, ["part", "length"])
    placed = ranked.withColumn("at", place("length", F.col("base") + F.col("rank_in_part")))
    return placed.select(*pieces.columns, "at.sequence_id", "at.offset")


def pack_documents(docs: DataFrame, tokenizer: str, scope: Scope) -> DataFrame:
    """The pieces of all documents with their places; reads the written pieces of ``scope``."""
    return pack(scope.stage(token_pieces(docs, tokenizer), "pieces"))
