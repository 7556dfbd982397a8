"""Exact top-k search by integer inner product.

Candidates and queries are dealt onto a grid: ``TILE`` candidate rows by ``QUERY_TILE`` queries, each
row to one line of the grid and each query to one column. A cell is one task-sized matrix product;
of every query's scores only the best k of the tile are kept, by partial selection. The lists of a
query are then merged as a tree, ``FAN`` tiles at a time, so no step holds more than ``FAN`` lists of
a query. Work is queries x rows, as exact search is; memory is one cell.

Products run in floating point while all sums are whole numbers below 2^53, else in whole numbers of
any size; scores beyond 64 bits are held at the limits of a long.

Edge cases. A vector that is null, empty or holds a null or non-finite component takes no part, nor
does a null id. Only vectors of equal length are compared. Ties go to the smaller vec_id, then to
either of rows equal in both. Every row is a candidate, repeated or not, but rows with the query's id
are the query's own. Queries equal in id and vector are one; a query without candidates has no rows.
"""

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.sources.staging import Scope

SCALE = 1024
TILE = 8192
QUERY_TILE = 2048
FAN = 32


def valid(vector: Column) -> Column:
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    """floor(SCALE * x) of every component, as float64 or, beyond 2^53, as Python numbers."""
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    scaled = np.floor(flat * SCALE)
    if len(scaled) and np.abs(scaled).max() >= 2.0**53:
        scaled = np.array([int(np.floor(x)) * SCALE if x == np.floor(x) else int(np.floor(x * SCALE))
                           for x in flat.tolist()], object)
    return scaled.reshape(rows, -1)


def best_of_tile(queries: np.ndarray, rows: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int):
    """(query index, row index, score) of every query's k best rows; ties to the smaller id."""
    order = np.argsort(ids, kind="stable")
    rows, ids = rows[order], ids[order]
    peak = float(np.abs(queries).max()) * float(np.abs(rows).max()) * rows.shape[1]
    if rows.dtype != object and queries.dtype != object and peak < 2.0**53:
        scores = (queries @ rows.T).astype(np.int64)
    else:
        exact = np.vectorize(int, otypes=[object])
        scores = exact(queries).dot(exact(rows).T)
        scores = np.clip(scores, -(2**63), 2**63 - 1).astype(np.int64)
    found_q, found_r, found_s = [], [], []
    for q in range(len(queries)):
        line, open_ = scores[q], np.ones(len(ids), bool)
        lo, hi = np.searchsorted(ids, own[q], "left"), np.searchsorted(ids, own[q], "right")
        open_[lo:hi] = False
        places = np.flatnonzero(open_)
        line = line[places]
        if len(line) > k:  # all above the k-th score, and of the rows that tie with it the first
            least = np.partition(line, len(line) - k)[len(line) - k]
            above = np.flatnonzero(line > least)
            picked = np.concatenate([above, np.flatnonzero(line == least)[: k - len(above)]])
            places, line = places[picked], line[picked]
        found_q.append(np.full(len(places), q))
        found_r.append(order[places])
        found_s.append(line)
    return np.concatenate(found_q), np.concatenate(found_r), np.concatenate(found_s)


_TOP = pa.schema([("query_no", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()),
                  ("score", pa.int64()), ("tile", pa.int64())])


def _cell(queries: pa.Table, rows: pa.Table, k: int) -> pa.Table:
    if not queries.num_rows or not rows.num_rows:
        return _TOP.empty_table()
    own, ids = queries.column("vec_id").to_numpy(), rows.column("vec_id").to_numpy()
    q, r, s = best_of_tile(_matrix(queries.column("v"), len(own)), _matrix(rows.column("v"), len(ids)),
                           own, ids, k)
    tile = np.full(len(q), rows.column("tile")[0].as_py())
    return pa.Table.from_arrays(
        [pa.array(queries.column("query_no").to_numpy()[q]), pa.array(own[q]), pa.array(ids[r]), pa.array(s),
         pa.array(tile)], schema=_TOP)


def _best(lists: DataFrame, k: int, *group: str) -> DataFrame:
    order = Window.partitionBy("query_no", *group).orderBy(F.desc("score"), "vec_id")
    return lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(vectors: DataFrame, queries: DataFrame, k: int, scope: Scope) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of ``vectors`` for each row of ``queries``,
    both with ``vec_id`` and ``embedding``; staged tables are in ``scope``."""

    def usable(df: DataFrame) -> DataFrame:
        return df.where(F.col("vec_id").isNotNull() & valid(F.col("embedding"))).select(
            F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))

    asked = scope.stage(usable(queries).dropDuplicates(["vec_id", "v"]).withColumn(
        "query_no", F.monotonically_increasing_id()), "queries")
    rows = usable(vectors)
    tiles = max(1, -(-rows.count() // TILE))
    columns = max(1, -(-asked.count() // QUERY_TILE))
    every = F.sequence(F.lit(0).cast("long"), F.lit(columns - 1).cast("long"))
    lines = F.sequence(F.lit(0).cast("long"), F.lit(tiles - 1).cast("long"))
    left = asked.select(
        "query_no", "vec_id", "v", F.size("v").alias("dim"),
        F.pmod(F.xxhash64("query_no"), F.lit(columns)).alias("column"), F.explode(lines).alias("tile"))
    right = rows.select(
        "vec_id", "v", F.size("v").alias("dim"),
        F.pmod(F.monotonically_increasing_id(), F.lit(tiles)).alias("tile"), F.explode(every).alias("column"))
    key = ["dim", "column", "tile"]
    cell = partial(_cell, k=k)
    lists = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
        lambda a, b: cell(a, b), "query_no long, query_id long, vec_id long, score long, tile long")
    while tiles > FAN:
        lists = _best(lists.withColumn("tile", F.floor(F.col("tile") / FAN)), k, "tile").drop("rank")
        tiles = -(-tiles // FAN)
    return _best(lists, k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
