"""Removal of multi-line passages that occur again anywhere in a table of texts.

1. The lines of a text are hashed. A chunk ends after a line where a rolling hash over the last
   ``ROLL`` line hashes hits 0 modulo ``MEAN_LINES``, so the boundaries depend on nearby lines only: a
   passage moved to another place or text is cut alike, but for its ends. A chunk has ``MIN_LINES``
   to ``MAX_LINES`` lines. A line of ``LONG_WORDS`` words or more is a passage by itself: it is cut
   off on both sides.
2. The shortest runs of ``LONG_WORDS`` words from every line and up to every line are hashed as well,
   in one pass over prefix sums. Those inside a passage of so many words cover it, so it is found
   whatever stands around it. A text of fewer words, of ``MIN_LINES`` lines with words or more, is a
   run as a whole, so that a copy of it goes as a whole.
3. Chunks and runs are grouped over the whole table by a 128-bit hash; only a hash, a place and sizes
   move. Copies of a hot chunk collapse to one partial row per task.
4. The first occurrence stays: smallest doc_id, then text hash, then place. What occurs again points
   to it; neighbours that point to neighbours are joined, so that a line moves about once.
5. The bytes of what is to go and of what it points to are compared, by grouping on the text. A hash
   that stands for different texts removes nothing.

Only chunks with two lines that hold a word, at least, and runs of ``LONG_WORDS`` words are ever removed.
An occurrence that overlaps the first one of its text loses the lines after that only.

A document is known by doc_id, the hash and the byte length of its text, so that nothing depends on
how Spark splits the input. Edge cases: rows that repeat doc_id and text count as one document and are
cut alike, each keeping the first occurrence if it is theirs. Null doc_id: comes after all others.
Null and empty texts stay as they are. Columns of the input are kept, but for those named like the
ones added.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.llm.batches import bounded
from runlens.llm.shingles import mix
from runlens.sources.staging import Scope

ROLL = 2
MEAN_LINES = 3
MIN_LINES = 2
MAX_LINES = 64
LONG_WORDS = 50
_IDENTITY = ["__id", "__h", "__bytes"]
_CHUNKS = "__id string, __h long, __bytes int, first int, n int, key binary"
_OF = ["of_id", "of_h", "of_bytes"]  # the document of a first occurrence
_PIECES = "of_id string, of_h long, of_bytes int, at int, n int, piece binary"
_BASE = 0x9E3779B97F4A7C17  # odd, so that it has an inverse modulo 2^64


def is_long(line: bytes) -> bool:
    return len(line) >= 2 * LONG_WORDS - 1 and len(line.split()) >= LONG_WORDS


def removable(lines: list[bytes]) -> bool:
    """Whether a chunk of these lines may go if it occurs elsewhere."""
    return sum(1 for line in lines if line.strip()) >= MIN_LINES or is_long(lines[0])


def chunk_bounds(hashes: np.ndarray, long: list[int] = ()) -> list[int]:
    """Ends (exclusive) of the chunks of a text with these line hashes; ``long`` numbers its long lines."""
    lines = len(hashes)
    with np.errstate(over="ignore"):
        rolled = mix(hashes)
        for k in range(1, ROLL):
            rolled[k:] = mix(rolled[k:] ^ (hashes[:-k] * np.uint64(2 * k + 1)))
    ends, start = [], 0
    forced = {at for line in long for at in (line, line + 1)}
    cuts = set((np.flatnonzero(rolled % np.uint64(MEAN_LINES) == 0) + 1).tolist())
    for at in sorted(cuts | forced):
        while at - start > MAX_LINES:
            start += MAX_LINES
            ends.append(start)
        if at - start >= (1 if at in forced else MIN_LINES):
            ends.append(at)
            start = at
    while lines - start > MAX_LINES:
        start += MAX_LINES
        ends.append(start)
    if start < lines:
        ends.append(lines)
    return ends


def runs(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First lines and ends (exclusive) of the shortest runs that hold ``LONG_WORDS`` words from a line on
    or up to a line, of a text whose lines have so many ``words``."""
    lines = len(words)
    total = np.concatenate([[0], np.cumsum(words)])
    if total[-1] < LONG_WORDS:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = np.searchsorted(total, total[:-1] + LONG_WORDS)
    starts = np.searchsorted(total, total[1:] - LONG_WORDS, side="right") - 1
    from_line, to_line = np.flatnonzero(ends <= lines), np.flatnonzero(starts >= 0)
    spans = np.unique(np.concatenate([
        from_line * (lines + 1) + ends[from_line], starts[to_line] * (lines + 1) + to_line + 1]))
    return spans // (lines + 1), spans % (lines + 1)


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of ``_BASE`` and of its inverse, modulo 2^64."""
    with np.errstate(over="ignore"):
        return tuple(
            np.cumprod(np.concatenate([[np.uint64(1)], np.full(count - 1, base, np.uint64)]), dtype=np.uint64)
            for base in (_BASE, pow(_BASE, -1, 2**64)))


def run_keys(digests: list[bytes], first: np.ndarray, end: np.ndarray, powers: tuple) -> list[bytes]:
    """128-bit hashes of the runs of lines with these 128-bit digests, each in constant time."""
    halves = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
    up, down = (p[:, None] for p in powers)
    with np.errstate(over="ignore"):
        sums = np.zeros((len(halves) + 1, 2), np.uint64)
        np.cumsum(halves * up[: len(halves)], axis=0, out=sums[1:])
        keys = (sums[end] - sums[first]) * down[first]
        data = mix(keys ^ mix((end - first).astype(np.uint64))[:, None]).tobytes()
    return [data[k : k + 16] for k in range(0, len(data), 16)]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Identity and text -> the chunks and runs that could be removed."""
    powers = _powers(1024)
    for batch in bounded(batches):
        owner, first, size, keys = [], [], [], []
        for row, text in enumerate(batch.column("text").cast(pa.large_binary()).to_pylist()):
            lines = (text or b"").split(b"\n")
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, lines), np.uint64, len(lines))
            words = np.fromiter((len(line.split()) for line in lines), np.int64, len(lines))
            start = 0
            for end in chunk_bounds(hashes, np.flatnonzero(words >= LONG_WORDS).tolist()):
                if removable(lines[start:end]):
                    owner.append(row)
                    first.append(start)
                    size.append(end - start)
                    keys.append(xxhash.xxh3_128_digest(b"\n".join(lines[start:end])))
                start = end
            begin, end = runs(words)
            if not len(begin) and np.count_nonzero(words) >= MIN_LINES:
                begin, end = np.array([0]), np.array([len(lines)])
            if len(begin):
                if len(lines) > len(powers[0]):
                    powers = _powers(2 * len(lines))
                owner.extend([row] * len(begin))
                first.extend(begin.tolist())
                size.extend((end - begin).tolist())
                keys.extend(run_keys([xxhash.xxh3_128_digest(line) for line in lines], begin, end, powers))
        rows = pa.array(owner, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c).take(rows) for c in _IDENTITY],
             pa.array(first, pa.int32()), pa.array(size, pa.int32()), pa.array(keys, pa.binary())],
            names=[*_IDENTITY, "first", "n", "key"])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts and the line ranges asked of them -> for each its first occurrence and its bytes."""
    for batch in bounded(batches):
        texts, asked = batch.column("text").cast(pa.large_binary()), batch.column("asked")
        flat, found, at = asked.flatten(), [], 0
        first, size = flat.field("first").to_pylist(), flat.field("n").to_pylist()
        for text, count in zip(texts, asked.value_lengths().to_pylist()):
            lines = text.as_py().split(b"\n")
            found += [b"\n".join(lines[a : a + n]) for a, n in zip(first[at : at + count], size[at : at + count])]
            at += count
        yield pa.RecordBatch.from_arrays(
            [*[flat.field(c) for c in (*_OF, "at", "n")], pa.array(found, pa.binary())],
            names=[*_OF, "at", "n", "piece"])


def _cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
    """Texts without the lines of their spans; null stays null."""

    def one(text, gone):
        if text is None or gone is None:
            return text
        lines = text.split("\n")
        stay = np.ones(len(lines), bool)
        for span in gone:
            stay[span["first"] : span["first"] + span["n"]] = False
        return "\n".join(line for line, keep in zip(lines, stay) if keep)

    return pd.Series([one(t, s) for t, s in zip(texts, spans)], dtype=object)


def _identified(docs: DataFrame) -> DataFrame:
    return docs.withColumns({
        "__id": F.col("doc_id").cast("string"),
        "__h": F.xxhash64("text"),
        "__bytes": F.coalesce(F.octet_length("text"), F.lit(0)),
    })


def _same(a: str, b: str):
    return (F.col(f"{a}.__id").eqNullSafe(F.col(f"{b}.__id"))
            & (F.col(f"{a}.__h") == F.col(f"{b}.__h")) & (F.col(f"{a}.__bytes") == F.col(f"{b}.__bytes")))


def _joined(spans: DataFrame, *by: str) -> DataFrame:
    """Line ranges (first, n) with those of equal ``by`` that touch or overlap joined."""
    order = Window.partitionBy(*by).orderBy("first", "n")
    before = F.max(F.col("first") + F.col("n")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.coalesce(F.col("first") > before, F.lit(True)).cast("int")
    part = F.sum("starts").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbered = spans.withColumn("starts", starts).withColumn("part", part)
    return numbered.groupBy(*by, "part").agg(
        F.min("first").alias("first"), (F.max(F.col("first") + F.col("n")) - F.min("first")).alias("n")).drop("part")


def _again(chunks: DataFrame, repeated: DataFrame, place: Column) -> DataFrame:
    """What is not the first occurrence of its key, without the lines that it shares with that, the first
    occurrence's document, and ``shift``, the lines between both."""
    found = chunks.join(repeated.hint("merge"), "key").where(place != F.col("low")).select(
        *_IDENTITY, "first", "n", F.col("low.doc").cast("string").alias("of_id"), F.col("low.__h").alias("of_h"),
        F.col("low.__bytes").alias("of_bytes"), (F.col("low.first") - F.col("first")).alias("shift"))
    own = (F.col("of_id").eqNullSafe(F.col("__id")) & (F.col("of_h") == F.col("__h"))
           & (F.col("of_bytes") == F.col("__bytes")))
    shared = F.when(own, F.greatest(F.col("shift") + F.col("n"), F.lit(0))).otherwise(0)
    return found.withColumn("shared", shared).withColumns({
        "first": F.col("first") + F.col("shared"), "n": F.col("n") - F.col("shared")}).drop("shared")


def removed_spans(docs: DataFrame, scope: Scope) -> DataFrame:
    """Per document that loses lines: its identity and ``spans``, the line ranges that go."""
    texts = _identified(docs).select(*_IDENTITY, "text")
    chunks = scope.stage(texts.mapInArrow(_chunks, _CHUNKS), "chunks")
    number = F.col("__id").cast(dict(docs.dtypes)["doc_id"])  # doc_id order, not text order
    place = F.struct(F.col("__id").isNull().alias("last"), number.alias("doc"), "__h", "__bytes", "first")
    ends = chunks.groupBy("key").agg(F.min(place).alias("low"), F.max(place).alias("high"))
    # written, so that a hot key's rows can be split in the join
    repeated = scope.stage(ends.where("low <> high").select("key", "low"), "repeated-keys")
    again = scope.stage(
        _joined(_again(chunks, repeated, place), *_IDENTITY, *_OF, "shift").withColumn(
            "at", F.col("first") + F.col("shift")).drop("shift"), "repeated")
    target = ["first", "n", *_OF, "at"]
    lows = again.select(*_OF, "at", "n").distinct().select(
        *[F.col(o).alias(c) for o, c in zip(_OF, _IDENTITY)], F.col("at").alias("first"), "n", *_OF, "at")
    asked = again.select(*_IDENTITY, *target).union(lows).groupBy(*_IDENTITY).agg(
        F.collect_list(F.struct(*target)).alias("asked"))
    pieces = texts.alias("t").join(asked.hint("merge").alias("s"), _same("t", "s")).select(
        "text", "asked").mapInArrow(_pieces, _PIECES)
    of = F.struct(*_OF, "at", "n").alias("of")  # null ids are equal within it
    unequal = scope.stage(
        pieces.select(of, "piece").groupBy("of", "piece").agg(F.count("*").alias("c"))
        .groupBy("of").agg(F.count("*").alias("c")).where("c > 1").select("of"), "unequal")
    gone = again.withColumn("of", of).join(unequal, "of", "left_anti")
    return _joined(gone, *_IDENTITY).groupBy(*_IDENTITY).agg(F.collect_list(F.struct("first", "n")).alias("spans"))


def dedup_lines(docs: DataFrame, scope: Scope) -> DataFrame:
    """``docs`` with the cut ``text``, ``removed`` (the spans, null where nothing went), ``n_lines``
    before and ``n_removed_lines``. It reads tables of ``scope``."""
    spans = scope.stage(removed_spans(docs, scope), "spans")
    rows = _identified(docs.drop("removed", "n_lines", "n_removed_lines"))
    joined = rows.alias("t").join(spans.hint("merge").alias("s"), _same("t", "s"), "left").select(
        *[F.col(f"t.`{c}`") for c in rows.columns if c not in _IDENTITY], F.col("s.spans").alias("removed"))
    lines = F.size(F.split("text", "\n"))
    none = F.col("removed").isNull()
    # a filter of the cut text stays above the cut: below it, the cut would run once more, in workers of its own
    cut = F.pandas_udf(_cut, "string").asNondeterministic()(F.when(~none, F.col("text")), F.col("removed"))
    return joined.withColumns({
        "n_lines": F.when(F.col("text").isNull(), 0).otherwise(lines).cast("long"),
        "n_removed_lines": F.coalesce(
            F.aggregate("removed", F.lit(0), lambda a, s: a + s["n"]), F.lit(0)).cast("long"),
        "__cut": cut,
    }).withColumn("text", F.when(none, F.col("text")).otherwise(F.col("__cut"))).drop("__cut")


def filter_documents(docs: DataFrame, scope: Scope) -> DataFrame:
    """The documents with their cut texts and, if there is such a column, their new ``n_chars``. A
    document that lost lines and has no word left goes: all it held stays elsewhere."""
    own = F.struct(*docs.columns).alias("__row")
    cut = dedup_lines(docs.select("doc_id", "text", own), scope)
    left = cut.where(F.col("removed").isNull() | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    new = {"text": F.col("text"), "n_chars": F.when(F.col("removed").isNull(), F.col("__row.n_chars")).otherwise(
        F.length("text"))} if "n_chars" in docs.columns else {"text": F.col("text")}
    kinds = dict(docs.dtypes)
    return left.select(*[
        new[c].cast(kinds[c]).alias(c) if c in new else F.col(f"__row.`{c}`") for c in docs.columns])


def texts_before(docs: DataFrame, whole: DataFrame, scope: Scope) -> DataFrame:
    """(doc_id, text): the whole texts of those ``docs`` that lost lines, written. A document is known by a doc_id
    that neither table repeats, and by its lines, which its whole text holds, too."""

    def lines(df: DataFrame, name: str) -> DataFrame:
        hashes = F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.xxhash64(x))
        rows = df.where("doc_id IS NOT NULL").select("doc_id", hashes.alias("lines"))
        return rows.groupBy("doc_id").agg(F.count("*").alias("n"), F.max("lines").alias(name)).where("n = 1").drop("n")

    both = lines(docs, "left").join(lines(whole, "held").hint("merge"), "doc_id")
    cut = both.where((F.size("left") < F.size("held")) & (F.size(F.array_except("left", "held")) == 0))
    ids = scope.stage(cut.select("doc_id"), "cut-documents")
    return scope.stage(whole.select("doc_id", "text").join(ids, "doc_id", "left_semi"), "texts-before")
