"""Near-duplicate documents by HyperMinHash.

1. Every document becomes its set of five-word shingles. Documents with equal sets form a class; a
   group of copies, however large, is one row from here on.
2. A class is sketched in one pass over its set: hashes fall into buckets, and the smallest of a
   bucket is kept as a register of its leading-zero count and the mantissa bits that follow. Empty
   buckets borrow a register along fixed pseudo-random probes, so small sets have full sketches.
3. ``BANDS`` bands of ``BAND_WIDTH`` compressed registers are bucket keys. At the threshold 0.75 a
   pair shares none of them with probability (1 - 0.75^5)^56 = 3e-7; above it with less.
4. Each member of a bucket is paired with the bucket's first member. Of pairs whose set sizes fit, those
   with a set of at most ``FEW`` shingles are near if they are links on their full sets, which such
   sets carry along; the others if their Jaccard estimate, from one bit per register and corrected for
   accidental agreement, is within six standard deviations of the threshold. The deviation is that of
   registers of which some are borrowed, thus equal to others. Members of a bucket that this leaves
   in different families of near pairs are then paired with each other, in buckets of more than ``BLOCK``
   members each two blocks that hold different families in one task, so that only what is near becomes a row. So bucket mates that may be
   linked share a family, while groups of near copies cost a multiple of their size only.
5. Near pairs of larger sets whose estimate from whole registers, corrected for collisions, is not below the
   threshold by six standard deviations are decided on their full sets, computed again from the
   whole texts. The links give components.
6. A family that still holds several components is compared completely: its sets are dealt into
   blocks, each two blocks that can hold a link meet in one task, exact intersections come from
   matrix products, and a spanning forest of the links found is returned. Blocks of one component
   are not compared with each other. There is no cap.

Documents may have a second text, such as the one before an earlier step cut it: they are then linked if
any of their texts are.

Edge cases. Null, empty or blank text: no shingles, a component of its own, kept, whatever its second text. Null doc_id: takes
part; the smallest of its component is taken over the ids that are not null; a component without
any has a null id, and all its rows are kept. Repeated rows are equal sets. Empty table: no rows.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.llm.batches import MOST_BYTES, bounded
from runlens.llm.components import components_of_each, connected_components
from runlens.llm.shingles import mix, shingle_sets
from runlens.sources.staging import Scope, stage

THRESHOLD = 75  # percent
BANDS, BAND_WIDTH = 56, 5
REGISTERS = BANDS * BAND_WIDTH
MANTISSA = 10
SIGNATURE_BITS = 256
PROBES = 64
DEVIATIONS = 6
#: Pairs with a set of so many shingles are never estimated; LISTED is the largest set that may link to it.
FEW = 256
LISTED = 100 * FEW // THRESHOLD
#: Sets, and shingles of them, in a block of a family that is compared completely.
BLOCK, BLOCK_SHINGLES = 512, 1 << 19
#: Texts that a worker sketches at once; its memory follows from both.
SLICE_BYTES, SLICE_ROWS = 1 << 20, 1024
COLUMNS = 4096

_SKETCH = ("n_shingles long, hi long, lo long, registers binary, few array<long>, "
           + ", ".join(f"s{i} long" for i in range(SIGNATURE_BITS // 64)))


def _probe_table() -> np.ndarray:
    """For every attempt the bucket that each empty bucket looks into."""
    with np.errstate(over="ignore"):
        cells = np.arange(PROBES * REGISTERS, dtype=np.uint64) + np.uint64(1)
        return (mix(mix(cells)) % np.uint64(REGISTERS)).astype(np.int64).reshape(PROBES, REGISTERS)


def sketch(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Registers (texts x REGISTERS, uint16) of sorted distinct 64-bit sets; 0 only for empty sets.

    A register is 1 + (leading zeros << MANTISSA | mantissa) of the smallest hash's place within its
    bucket: equal hashes give equal registers, and smaller ones do not give smaller registers, which
    only equality tests need.
    """
    docs = len(offsets) - 1
    owners = np.repeat(np.arange(docs), np.diff(offsets))
    scaled = (values >> np.uint64(32)) * np.uint64(REGISTERS)
    bucket, place = (scaled >> np.uint64(32)).astype(np.int64), scaled & np.uint64(0xFFFFFFFF)
    first = np.ones(len(values), bool)
    if len(values) > 1:  # values ascend, so the first of a bucket is its smallest
        first[1:] = (bucket[1:] != bucket[:-1]) | (owners[1:] != owners[:-1])
    place, rows, columns = place[first], owners[first], bucket[first]
    bits = np.frexp(place.astype(np.float64))[1].astype(np.uint64)  # bit length
    below = place - np.where(place > 0, np.uint64(1) << (np.maximum(bits, 1) - np.uint64(1)), 0).astype(np.uint64)
    mantissa = np.where(
        bits > MANTISSA, below >> np.where(bits > MANTISSA, bits - np.uint64(MANTISSA + 1), 0).astype(np.uint64),
        below << np.where(bits > MANTISSA, 0, np.uint64(MANTISSA + 1) - np.maximum(bits, 1)).astype(np.uint64),
    )
    found = np.zeros((docs, REGISTERS), np.uint16)
    found[rows, columns] = 1 + (((np.uint64(32) - bits) << np.uint64(MANTISSA)) | mantissa)
    full = found.copy()
    row, column = np.nonzero((found == 0) & (np.diff(offsets) > 0)[:, None])
    for probe in _probe_table():
        if not len(row):
            break
        borrowed = found[row, probe[column]]
        full[row, column] = borrowed
        left = borrowed == 0
        row, column = row[left], column[left]
    for step in range(1, REGISTERS):  # very small sets: the next full bucket
        if not len(row):
            break
        borrowed = found[row, (column + step) % REGISTERS]
        full[row, column] = borrowed
        left = borrowed == 0
        row, column = row[left], column[left]
    return full


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard estimate of rows of registers, corrected for accidental collisions: two unrelated
    smallest hashes agree in the leading zeros with probability 1/3 and then in all mantissa bits."""
    chance = 2.0**-MANTISSA / 3
    return np.maximum(((a == b).mean(axis=1) - chance) / (1 - chance), 0.0)


def _spread(n: np.ndarray) -> np.ndarray:
    """Sum of the squared shares that the values of a set of ``n`` have in its registers: 1 / REGISTERS if
    none is borrowed. A value found in ``own`` buckets lends about (REGISTERS - own) / own registers."""
    own = REGISTERS * -np.expm1(-n / REGISTERS)
    lent = (REGISTERS - own) / own
    return own * (lent + (1 + lent) ** 2) / REGISTERS**2


def _least_estimate(n: np.ndarray) -> np.ndarray:
    share = THRESHOLD / 100
    return share - DEVIATIONS * (share * (1 - share) * _spread(n)) ** 0.5


def _listed(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The sets of up to LISTED shingles; null for larger ones."""
    small = sizes <= LISTED
    offsets = np.concatenate([[0], np.cumsum(np.where(small, sizes, 0))]).astype(np.int32)
    held = values[np.repeat(small, sizes)].view(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(held), mask=pa.array(~small))


def _sketches(batches):
    """(doc_id, xh, text) -> sketch columns."""
    for batch in bounded(batches, most=SLICE_BYTES, rows=SLICE_ROWS):
        values, offsets = shingle_sets(batch.column("text"))
        registers = sketch(values, offsets)
        signature = np.packbits(registers[:, :SIGNATURE_BITS] & 1, axis=1).view(np.int64)
        prints = [xxhash.xxh3_128_intdigest(values[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
        halves = np.array([(p >> 64, p & (2**64 - 1)) for p in prints], np.uint64).reshape(-1, 2).view(np.int64)
        columns = [
            batch.column("doc_id"), batch.column("xh"), pa.array(np.diff(offsets)),
            pa.array(halves[:, 0]), pa.array(halves[:, 1]),
            pa.array([r.tobytes() for r in registers], pa.binary()),
            _listed(values, np.diff(offsets)),
            *[pa.array(signature[:, i]) for i in range(signature.shape[1])],
        ]
        yield pa.RecordBatch.from_arrays(columns, names=_SKETCH_NAMES)


_SKETCH_NAMES = ["doc_id", "xh"] + [c.split()[0] for c in _SKETCH.split(", ")]


def _stack(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _band_keys(batches):
    """(node, registers) -> (band key, node), one row per band."""
    for batch in bounded(batches, "registers", MOST_BYTES // 4):
        parts = _stack(batch.column("registers")).reshape(-1, BANDS, BAND_WIDTH).astype(np.uint64)
        with np.errstate(over="ignore"):
            keys = np.broadcast_to(mix(np.arange(1, BANDS + 1, dtype=np.uint64)), parts.shape[:2])
            for k in range(BAND_WIDTH):
                keys = mix(keys ^ parts[:, :, k])
        nodes = np.repeat(batch.column("node").to_numpy(), BANDS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(keys).ravel().view(np.int64)), pa.array(nodes)], names=["key", "node"])


def _likely(batches):
    """Pairs with registers -> pairs whose estimate may belong to a link."""
    for batch in batches:
        n = batch.column("n").to_numpy()
        near = (n <= FEW) | (estimate(_stack(batch.column("ra")), _stack(batch.column("rb"))) >= _least_estimate(n))
        yield batch.select(["a", "b"]).filter(pa.array(near))


def _full_sets(batches):
    """(node, hi, lo, text) -> (node, set) where the text has the node's set."""
    for batch in bounded(batches, most=SLICE_BYTES):
        values, offsets = shingle_sets(batch.column("text"))
        rows = []
        for i, (hi, lo) in enumerate(zip(batch.column("hi").to_pylist(), batch.column("lo").to_pylist())):
            data = values[offsets[i] : offsets[i + 1]].tobytes()
            if xxhash.xxh3_128_intdigest(data) == ((hi % 2**64) << 64 | lo % 2**64):
                rows.append((i, data))
        nodes = batch.column("node").take(pa.array([i for i, _ in rows], pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [nodes, pa.array([d for _, d in rows], pa.binary())], names=["node", "members"])


def _links(batches):
    """Pairs with both full sets -> the pairs that are links."""
    for batch in batches:
        near = np.zeros(batch.num_rows, bool)
        for i, (a, b) in enumerate(zip(batch.column("sa"), batch.column("sb"))):
            x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (a, b))
            small, large = (x, y) if len(x) <= len(y) else (y, x)
            at = np.searchsorted(large, small)
            both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
            near[i] = 100 * both >= THRESHOLD * (len(x) + len(y) - both)
        yield batch.select(["a", "b"]).filter(pa.array(near))


def _intersections(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of the sets, and of the intersection of each two."""
    sizes = np.array([len(s) for s in sets])
    values, place, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = seen > 1  # what one set alone holds adds to no intersection
    column = np.cumsum(common) - 1
    held = common[place]
    row_of, column_of = np.repeat(np.arange(len(sets)), sizes)[held], column[place][held]
    by_column = np.argsort(column_of, kind="stable")
    row_of, column_of = row_of[by_column], column_of[by_column]
    both = np.zeros((len(sets), len(sets)), np.float32)
    for low in range(0, int(common.sum()), COLUMNS):
        a, b = np.searchsorted(column_of, [low, low + COLUMNS])
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[row_of[a:b], column_of[a:b] - low] = 1
        both += part @ part.T  # whole numbers below 2^24, so exact
    return sizes, both


def _block_links(rows: pa.Table) -> pa.Table:
    """The sets of two blocks -> a spanning forest of the links between different components."""
    nodes, roots = rows.column("node").to_numpy(), rows.column("root").to_numpy()
    sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in rows.column("members")]
    sizes, both = _intersections(sets)
    union = sizes[:, None] + sizes[None, :] - both
    linked = (100.0 * both >= THRESHOLD * union) & (roots[:, None] < roots[None, :])
    parent = np.arange(len(sets))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for group in np.unique(roots, return_inverse=True)[1:]:
        first = {}
        for x, g in enumerate(group.tolist()):
            parent[x] = first.setdefault(g, x)
    forest = []
    for x, y in np.argwhere(linked).tolist():
        i, j = find(x), find(y)
        if i != j:
            parent[max(i, j)] = min(i, j)
            forest.append((x, y))
    pairs = np.array(forest, np.int64).reshape(-1, 2)
    return pa.table({"a": nodes[pairs[:, 0]], "b": nodes[pairs[:, 1]]})


def _mates(rows: pa.Table) -> pa.Table:
    """Two blocks of a bucket -> its pairs from different families that may be linked, as ``_may_link`` has it."""
    nodes, roots, n = (rows.column(c).to_numpy() for c in ("node", "root", "n_shingles"))
    few = [np.array(s, np.int64).view(np.uint64) for s in rows.column("few").to_pylist() if s is not None]
    bits = np.stack([rows.column(f"s{i}").to_numpy().view(np.uint64) for i in range(SIGNATURE_BITS // 64)])
    apart = sum(np.bitwise_count(b[:, None] ^ b[None, :]).astype(np.int64) for b in bits)
    least, most = np.minimum(n[:, None], n[None, :]), np.maximum(n[:, None], n[None, :])
    part = (1 - THRESHOLD / 100) / 2
    spread = _spread(n) + (1 / SIGNATURE_BITS - 1 / REGISTERS)
    cut = SIGNATURE_BITS * (part + DEVIATIONS * (part * (1 - part) * spread) ** 0.5)
    near = apart <= np.maximum(cut[:, None], cut[None, :])  # that of the smaller set
    listed = np.flatnonzero(n <= LISTED)
    if len(listed):
        linked = np.zeros(near.shape, bool)
        sizes, both = _intersections(few)
        linked[np.ix_(listed, listed)] = 100.0 * both >= THRESHOLD * (sizes[:, None] + sizes[None, :] - both)
        near = np.where(least <= FEW, linked, near)
    near &= (100 * least >= THRESHOLD * most) & (roots[:, None] != roots[None, :])
    a, b = np.nonzero(near & (nodes[:, None] < nodes[None, :]))
    return pa.table({"a": nodes[a], "b": nodes[b]})


def _hamming(x: str, y: str):
    return sum(F.bit_count(F.col(f"{x}.s{i}").bitwiseXOR(F.col(f"{y}.s{i}")))
               for i in range(SIGNATURE_BITS // 64))


def _may_link(x: str, y: str):
    """Sizes fit, and small sets are linked, or the one-bit estimate 1 - 2 h / bits (half of all unrelated
    bits agree) is near."""
    n, m = F.col(f"{x}.n_shingles"), F.col(f"{y}.n_shingles")
    both = F.size(F.array_intersect(f"{x}.few", f"{y}.few"))
    linked = 100 * both >= THRESHOLD * (n + m - both)
    part = (1 - THRESHOLD / 100) / 2
    own = REGISTERS * -F.expm1(-F.least(n, m) / REGISTERS)
    lent = (REGISTERS - own) / own
    spread = own * (lent + (1 + lent) * (1 + lent)) / REGISTERS**2 + (1 / SIGNATURE_BITS - 1 / REGISTERS)
    most = SIGNATURE_BITS * (part + DEVIATIONS * F.sqrt(part * (1 - part) * spread))
    return (100 * F.least(n, m) >= THRESHOLD * F.greatest(n, m)) & F.when(
        F.least(n, m) <= FEW, linked).otherwise(_hamming(x, y) <= most)


class _Classes:
    """The staged classes of a document table and the steps that link them."""

    def __init__(self, docs: DataFrame, scope: Scope, second: DataFrame | None = None):
        self.scope = scope
        kind = dict(docs.dtypes)["doc_id"]

        def texts(rows: DataFrame) -> DataFrame:
            return rows.select(F.col("doc_id").cast(kind).alias("doc_id"), "text", F.xxhash64("text").alias("xh"))

        named = ["doc_id", "xh", "n_shingles", "hi", "lo"]
        signs = [f"s{i}" for i in range(SIGNATURE_BITS // 64)]
        with Scope(docs.sparkSession) as drafts:  # of the sketches only the names of sets outlive the classes

            def sketches(rows: DataFrame) -> DataFrame:
                return drafts.stage(rows.mapInArrow(_sketches, f"doc_id {kind}, xh long, {_SKETCH}"), "sketches")

            self.docs, every, self.seconds = texts(docs), sketches(texts(docs)), None
            self.members = scope.stage(every.select(named), "members")
            if second is not None:
                self.docs, seconds = self.docs.union(texts(second)), sketches(texts(second))
                self.seconds, every = scope.stage(seconds.select(named), "members"), every.union(seconds)
            grouped = every.where("n_shingles > 0").groupBy("hi", "lo", "n_shingles").agg(
                F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "xh")).alias("rep"),
                *[F.first(c).alias(c) for c in ["registers", "few", *signs]])
            self.table = scope.stage(
                grouped.select(F.monotonically_increasing_id().alias("node"), "hi", "lo", "n_shingles",
                               F.col("rep.doc_id").alias("doc_id"), F.col("rep.xh").alias("xh"),
                               "registers", "few", *signs), "classes")
        self.small = self.table.select("node", "n_shingles", "few", *signs)

    def bonds(self) -> DataFrame:
        """(a, b): the classes of the two texts of a document, written."""
        named = self.table.select("node", "hi", "lo", "n_shingles")

        def nodes(rows: DataFrame, name: str) -> DataFrame:
            known = rows.where("doc_id IS NOT NULL AND n_shingles > 0").select("doc_id", "hi", "lo", "n_shingles")
            return known.join(named.hint("merge"), ["hi", "lo", "n_shingles"]).select("doc_id", F.col("node").alias(name))

        both = nodes(self.members, "a").join(nodes(self.seconds, "b").hint("merge"), "doc_id")
        return self.scope.stage(both.where("a <> b").select("a", "b").distinct(), "bonds")

    def bands(self) -> DataFrame:
        return self.table.select("node", "registers").mapInArrow(_band_keys, "key long, node long")

    def buckets(self) -> DataFrame:
        """(key, node, low): the members of buckets that more than one class fell into."""
        ends = self.bands().groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"))
        shared = self.scope.stage(ends.where("low <> high").select("key", "low"), "shared")
        return self.scope.stage(self.bands().join(shared.hint("merge"), "key"), "buckets")

    def near(self, pairs: DataFrame) -> DataFrame:
        """Pairs that pass sizes and the test for theirs, written."""
        x, y = self.small.hint("merge").alias("x"), self.small.hint("merge").alias("y")
        found = pairs.join(x, F.col("a") == F.col("x.node")).join(
            y, (F.col("b") == F.col("y.node")) & _may_link("x", "y"))
        return self.scope.stage(found.select("a", "b"), "near")

    def families(self, buckets: DataFrame, families: DataFrame) -> DataFrame:
        """(node, root) of the families of near pairs, grown until no two bucket mates that are near are apart."""
        placed = self.scope.stage(_rooted(buckets.select("key", "node"), families), "rooted-buckets")
        mixed = placed.groupBy("key").agg(
            F.min("root").alias("l"), F.max("root").alias("h"), F.ceil(F.count("*") / BLOCK).alias("blocks"))
        mixed = self.scope.stage(mixed.where("l <> h").select("key", "blocks"), "mixed")
        placed = placed.join(mixed.hint("merge"), "key")
        mates = self.scope.stage(placed.where("blocks = 1").join(self.small.hint("merge"), "node"), "mates")
        x, y = mates.alias("x"), mates.alias("y")
        apart = (F.col("x.key") == F.col("y.key")) & (F.col("x.node") < F.col("y.node")) & (
            F.col("x.root") != F.col("y.root")) & _may_link("x", "y")
        few = x.join(y, apart).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
        crowded = self.scope.stage(placed.where("blocks > 1").select("key", "node", "root"), "crowded")
        pairs = few.union(self.apart_in(crowded)) if _has_rows(crowded) else few
        more = self.scope.stage(pairs.distinct(), "more")
        if not _has_rows(more):
            return families
        return connected_components(_stars(families).union(more), self.scope)

    def apart_in(self, crowded: DataFrame) -> DataFrame:
        """(a, b): the pairs of different families that may be linked, of the members (key, node, root) of large
        buckets. A large family has blocks of its own, which do not meet each other; small ones share blocks."""
        held = crowded.groupBy("key", "root").agg(F.count("*").alias("c"))
        large = F.collect_list(F.when(F.col("c") >= BLOCK, F.struct("root", F.ceil(F.col("c") / BLOCK).alias("n"))))
        small = F.ceil(F.sum(F.when(F.col("c") < BLOCK, F.col("c")).otherwise(0)) / BLOCK)
        dealt = self.scope.stage(held.groupBy("key").agg(large.alias("large"), small.alias("small")), "dealt")
        none = F.lit(None).cast("long").alias("of")
        shared = F.transform(F.filter(F.sequence(F.lit(0).cast("long"), "small"), lambda i: i < F.col("small")),
                             lambda i: F.struct(none, i.alias("number")))
        owned = F.flatten(F.transform("large", lambda x: F.transform(
            F.sequence(F.lit(0).cast("long"), x["n"] - 1),
            lambda i: F.struct(x["root"].alias("of"), i.alias("number")))))
        own = F.get(F.filter("large", lambda x: x["root"] == F.col("root")), F.lit(0))["n"]
        number = F.pmod(F.xxhash64("node"), F.coalesce("own", "small")).alias("number")
        block = F.struct(F.when(F.col("own").isNotNull(), F.col("root")).alias("of"), number)
        placed = crowded.join(dealt.hint("merge"), "key").withColumn("own", own).select(
            "key", "node", "root", block.alias("block"), F.concat(shared, owned).alias("blocks"))
        apart = F.col("block.of").isNull() | F.col("other.of").isNull() | (F.col("block.of") != F.col("other.of"))
        met = placed.join(self.small.hint("merge"), "node").withColumn("other", F.explode("blocks")).where(apart)
        return met.withColumns({"one": F.least("block", "other"), "two": F.greatest("block", "other")}).drop(
            "block", "blocks", "other").groupBy("key", "one", "two").applyInArrow(_mates, "a long, b long")

    def contested(self, families: DataFrame, roots: DataFrame) -> DataFrame:
        """(a, b): links within families of several components, enough to join what is linked."""
        member = _rooted(families.withColumnRenamed("root", "family"), roots)
        split = member.groupBy("family").agg(F.min("root").alias("l"), F.max("root").alias("h")).where("l <> h")
        member = self.scope.stage(member.join(split.select("family"), "family"), "contested")
        if not _has_rows(member):
            return self.scope.stage(families.sparkSession.createDataFrame([], "a long, b long"), "links")
        weighed = member.join(self.small.select("node", "n_shingles"), "node")
        need = F.greatest(F.count("*") / BLOCK, F.sum("n_shingles") / BLOCK_SHINGLES)
        sizes = weighed.groupBy("family", "root").agg(need.alias("need"))
        own = F.col("need") >= 1  # a large component has blocks of its own, small ones share blocks
        many = sizes.groupBy("family").agg(F.ceil(F.sum(F.when(~own, F.col("need")).otherwise(0.0))).alias("small"))
        number = F.when(own, F.pmod(F.xxhash64("node"), F.ceil("need"))).otherwise(
            F.pmod(F.xxhash64("root"), F.greatest("small", F.lit(1))))
        block = F.struct(F.when(own, F.col("root")).alias("of"), number.alias("number"))
        placed = self.scope.stage(
            member.join(sizes, ["family", "root"]).join(many, "family").select(
                "family", "node", "root", block.alias("block")), "placed")
        blocks = placed.groupBy("family").agg(F.collect_set("block").alias("blocks"))
        met = placed.join(blocks, "family").select(
            "family", "node", "root", "block", F.explode("blocks").alias("other"))
        apart = F.col("block.of").isNull() | F.col("other.of").isNull() | (F.col("block.of") != F.col("other.of"))
        meets = met.where(apart).select(
            "family", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "node", "root")
        sets = self.full_sets(placed.select("node"))
        rows = meets.join(sets.hint("merge"), "node").select("family", "one", "two", "node", "root", "members")
        found = rows.groupBy("family", "one", "two").applyInArrow(_block_links, "a long, b long")
        return self.scope.stage(found, "links")

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Pairs that pass the estimates, written."""
        table = self.table.select("node", "n_shingles", "registers").hint("merge")
        x, y = table.alias("x"), table.alias("y")
        both = pairs.join(x, F.col("a") == F.col("x.node")).join(y, F.col("b") == F.col("y.node"))
        both = both.select("a", "b", F.least("x.n_shingles", "y.n_shingles").alias("n"),
                           F.col("x.registers").alias("ra"), F.col("y.registers").alias("rb"))
        return self.scope.stage(both.mapInArrow(_likely, "a long, b long"), "likely")

    def full_sets(self, nodes: DataFrame) -> DataFrame:
        """(node, members): full sets, written. Texts are read again, of one document of each class."""
        wanted = self.scope.stage(
            self.table.select("node", "hi", "lo", F.col("doc_id").alias("id"), F.col("xh").alias("h"))
            .join(nodes.distinct(), "node"), "wanted")
        texts = self.docs.join(
            wanted.hint("merge"), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("xh") == F.col("h")))
        return self.scope.stage(
            texts.select("node", "hi", "lo", "text").mapInArrow(_full_sets, "node long, members binary")
            .dropDuplicates(["node"]), "sets")

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs that are links on their full sets, written."""
        sets = self.full_sets(pairs.select(F.col("a").alias("node")).union(pairs.select("b")))
        x = sets.select(F.col("node").alias("a"), F.col("members").alias("sa")).hint("merge")
        y = sets.select(F.col("node").alias("b"), F.col("members").alias("sb")).hint("merge")
        both = pairs.join(x, "a").join(y, "b").select("a", "b", "sa", "sb")
        return self.scope.stage(both.mapInArrow(_links, "a long, b long"), "links")


def _rooted(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """``nodes`` with the ``root`` of their component: their own id if they have no link."""
    return nodes.join(roots.hint("merge"), "node", "left").withColumn("root", F.coalesce("root", "node"))


def _stars(roots: DataFrame) -> DataFrame:
    """Components found before, as the links of their nodes to their root: joining them further takes few rounds."""
    return roots.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))


def _has_rows(df: DataFrame) -> bool:
    return len(df.take(1)) > 0


def near_duplicates(docs: DataFrame, second: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, xh (hash of its text), n_shingles, component_id, kept and
    root (the component, null without shingles), written to the shared folder; intermediate tables
    are removed. ``second`` holds (doc_id, text) of documents that have a second text."""
    with Scope(docs.sparkSession) as scope:
        classes = _Classes(docs, scope, second)
        buckets = classes.buckets()
        near = classes.near(buckets.where("node <> low").select(
            F.col("low").alias("a"), F.col("node").alias("b")).distinct())
        links = classes.links(classes.likely(near))
        if second is not None:
            links = links.union(classes.bonds())
        families, roots = components_of_each([near, links], scope)
        more = classes.contested(classes.families(buckets, families), roots)
        if _has_rows(more):
            roots = connected_components(_stars(roots).union(more), scope)
        rooted = scope.stage(
            _rooted(classes.table.select("node", "hi", "lo", "n_shingles", "doc_id"), roots), "rooted")
        named = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
        by_class = rooted.join(named, "root").select("hi", "lo", "n_shingles", "root", "component_id")
        found = classes.members.select("doc_id", "xh", "n_shingles", "hi", "lo").join(
            by_class, ["hi", "lo", "n_shingles"], "left")
        own = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        named_rows = found.withColumn("component_id", own)
        kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
        return stage(named_rows.select("doc_id", "xh", "n_shingles", "component_id", kept.alias("kept"), "root"),
                     "near-duplicates")


def filter_documents(docs: DataFrame, second: DataFrame | None = None) -> DataFrame:
    """One row of each component, with its own columns: where a component's id repeats, or is null,
    the row with the smallest text hash. Rows without shingles stay, once per id and text."""
    found = near_duplicates(docs, second).where("kept")
    linked = found.where("root is not null").groupBy("root", "doc_id").agg(F.min("xh").alias("h"))
    winners = linked.select(F.col("doc_id").alias("id"), "h").union(
        found.where("root is null").select("doc_id", "xh")).distinct()
    marked = docs.withColumn("__xh", F.xxhash64("text"))
    stay = marked.join(winners, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("__xh") == F.col("h")),
                       "left_semi")
    return stay.dropDuplicates(["doc_id", "__xh"]).drop("__xh")
