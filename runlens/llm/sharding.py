"""Balanced shards by histogram sort.

Every document has a 64-bit key: the high bits are a hash of its text, the low bits a hash of its
row. Sorted by key, equal texts lie together, and a text with a third of all rows still has many
keys. Cells, ``CELLS`` per shard, are cut out of this order at equal byte totals:

1. Probes are laid across the key range and every partition counts the exact bytes between them;
   only these sums, a bounded number, reach the driver.
2. A splitter is settled when the bytes below its probe miss its target by at most ``TOLERANCE`` of a
   cell. All others get new probes between the two nearest ones, first between whole texts, so that
   equal texts stay together where the tolerance allows, then within them.
3. With all splitters settled, the rows are exchanged once, by cell, and numbered in key order.

A shard is a run of cells, so no task sorts or holds a whole shard.

Edge cases. Null text: 16 bytes, checksum 0. Repeated rows have keys of their own. Fewer rows than
shards: some shards are empty. Rows larger than a cell: the shard is as near as whole rows allow.
"""

from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runlens.sources.staging import Scope

SHARDS = 40
CELLS = 8
ROW_BYTES = 16
TOLERANCE = 0.05
GROUP_BITS = 24  # low bits of a key, which tell apart the rows of one text
PROBES = 16
ROUNDS = 24
_LOW, _HIGH = -(2**63), 2**63


def with_keys(docs: DataFrame) -> DataFrame:
    """``docs`` with ``size`` and the sort key. The key's low bits hash the row's number in its
    partition, so it is written before it is used twice."""
    mask = (1 << GROUP_BITS) - 1
    low = F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit(mask))
    return docs.withColumns({
        "size": (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long"),
        "key": F.xxhash64("text").bitwiseAND(F.lit(~mask)).bitwiseOR(low),
    })


def bytes_between(keyed: DataFrame, probes: list[int]) -> np.ndarray:
    """Exact bytes of the rows below the first probe, between each two, and from the last one on."""
    bounds = np.array(probes, np.int64)

    def count(batches):
        sums = np.zeros(len(bounds) + 1, np.int64)
        for batch in batches:
            at = np.searchsorted(bounds, batch.column("key").to_numpy(), side="right")
            np.add.at(sums, at, batch.column("size").to_numpy())
        full = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(sums[full])], names=["place", "bytes"])

    found = keyed.select("key", "size").mapInArrow(count, "place long, bytes long").groupBy("place").agg(
        F.sum("bytes").alias("bytes")).collect()  # one row per probe at most
    sums = np.zeros(len(bounds) + 1, np.int64)
    for row in found:
        sums[row.place] = row.bytes
    return sums


def _spread(low: int, high: int, many: int) -> list[int]:
    """Up to ``many`` probes strictly between, on whole texts while there are any."""
    step = 1 << GROUP_BITS
    first, last = -(-(low + 1) // step), (high - 1) // step
    if first <= last:
        count = last - first + 1
        return [(first + i * count // many) * step for i in range(many)] if count > many else [
            p * step for p in range(first, last + 1)]
    gap = high - low - 1
    return [low + 1 + i * gap // many for i in range(many)] if gap > many else list(range(low + 1, high))


def find_splitters(keyed: DataFrame, parts: int) -> list[int]:
    """Keys that part the rows into ``parts`` runs of near-equal bytes: run i holds the keys from
    splitter i - 1 up to, not including, splitter i."""
    probes = sorted(set(_spread(_LOW, _HIGH, parts * 4)))
    below = np.cumsum(bytes_between(keyed, probes))
    total = int(below[-1])
    known = dict(zip(probes, map(int, below[:-1])))
    known[_LOW], known[_HIGH] = 0, total
    targets = [total * i // parts for i in range(1, parts)]
    most = TOLERANCE * total / parts
    chosen: list[int] = []
    for _ in range(ROUNDS):
        places = sorted(known)
        sums = [known[p] for p in places]
        chosen, fresh = [], set()
        for target in targets:
            at = bisect_left(sums, target)
            low, high = places[max(at - 1, 0)], places[at]
            best = min((low, high), key=lambda p: (abs(known[p] - target), p))
            chosen.append(best)
            if abs(known[best] - target) > most:
                fresh.update(_spread(low, high, PROBES))
        fresh -= known.keys()
        if not fresh:
            break
        probes = sorted(fresh)
        between = np.concatenate([[0], np.cumsum(bytes_between(keyed, probes))])
        known.update(zip(probes, map(int, between[1:-1])))
    return chosen


def assign(keyed: DataFrame, shards: int = SHARDS, cells: int = CELLS) -> DataFrame:
    """Written rows with ``size`` and ``key`` -> the same with ``shard`` and ``slot``."""
    splitters = find_splitters(keyed, shards * cells)
    bounds = np.array([min(s, _HIGH - 1) for s in splitters], np.int64)

    def cell(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, keys.to_numpy(), side="right").astype(np.int32))

    celled = keyed.withColumn("cell", F.pandas_udf(cell, "int")("key"))
    counts = {r.cell: r["count"] for r in celled.groupBy("cell").count().collect()}  # shards x cells rows
    bases = []
    for number in range(shards * cells):
        first = number - number % cells
        bases.append(sum(counts.get(c, 0) for c in range(first, number)))
    base = F.get(F.array(*[F.lit(b).cast("long") for b in bases]), F.col("cell"))
    # the key's hash bits are spread over all values, so ties are rows alike in all that is sorted
    order = Window.partitionBy("cell").orderBy("key", "doc_id")
    return celled.withColumns({
        "shard": F.floor(F.col("cell") / cells).cast("int"),
        "slot": base + F.row_number().over(order) - 1,
    }).drop("cell")


def shard(docs: DataFrame, scope: Scope, shards: int = SHARDS) -> DataFrame:
    """``docs`` with ``size``, ``shard`` and ``slot`` (gapless from 0 in each shard). Columns of the
    input that are named like these are replaced."""
    return assign(scope.stage(with_keys(docs.drop("size", "key", "shard", "slot")), "keyed"), shards).drop("key")


def write_shards(docs: DataFrame, path: str, scope: Scope, shards: int = SHARDS) -> None:
    """One folder per shard below ``path``; the exchange is that of the numbering."""
    shard(docs, scope, shards).write.partitionBy("shard").parquet(path)
