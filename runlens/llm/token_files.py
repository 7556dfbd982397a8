"""Token ids in flat binary files that training loops map into memory.

A folder of token files holds, for every partition of the documents in ascending doc_id order,

* ``<name>.ids``: the ids of its documents in a row, little-endian unsigned integers of 16 bits if the
  vocabulary allows that, else of 32;
* ``<name>.offsets``: little-endian 64-bit numbers, one more than documents: where each begins among the
  ids of its partition;
* ``<name>.keys``: the doc_ids as little-endian 64-bit numbers, 0 where null;

and the table ``manifest`` with the sizes of all partitions and their bases, which are prefix sums over the
sizes: the number of documents, and of ids, before the partition. So the place of any document in the whole
corpus is a base plus an offset. The manifest is written last; without it a folder holds nothing.

Texts are exchanged once, by range of doc_id and, within one id, by row, so that a repeated id is split as
well; they must be a table that reads alike each time, as written ones do. The tasks that receive them in order
encode and write as rows come, under names of their own attempt: an attempt that is lost or doubled leaves
files that no manifest names, and that are removed in the end. The folder must be one that all executors and
the driver share. Local and mounted folders are mapped into memory, others (hdfs, s3, gs, as pyarrow
knows them) read by ranges.

Edge cases. Null text counts as empty and holds the end mark alone. Null doc_ids come first. Rows with
equal ids follow each other, in any order. Very long texts may fill a partition of their own. Empty
table: a manifest without rows. Other columns are not read.
"""

import uuid
from collections.abc import Iterator
from contextlib import ExitStack
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.llm.batches import MOST_BYTES, bounded
from runlens.llm.byte_bpe import encoder, vocabulary_size

PART_BYTES = 128 << 20  # of the texts of a file; less where there are few files, down to LEAST_PART_BYTES
LEAST_PART_BYTES = 2 << 20
PARTS_PER_CORE = 3
SPAN_BYTES = 32 << 20  # of ids that one task reads back
_MANIFEST = ("name string, width int, documents long, ids long, nulls long, first_document long, first_id long")


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and its path there."""
    system, path = pafs.FileSystem.from_uri(folder)
    return system, path.rstrip("/")


def _written(batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str, end: int) -> Iterator[pa.RecordBatch]:
    """Documents in order -> the files of a partition; one row that describes them."""
    width = 2 if max(vocabulary_size(tokenizer) - 1, end) < 2**16 else 4
    kind, ids_of = f"<u{width}", encoder(tokenizer)
    system, path = _open(folder)
    name = f"{TaskContext.get().partitionId():08d}-{uuid.uuid4().hex}"
    documents = ids = nulls = 0
    with ExitStack() as stack:
        streams = []
        for batch in bounded(batches):
            if not streams:
                streams = [stack.enter_context(system.open_output_stream(f"{path}/{name}.{part}"))
                           for part in ("ids", "offsets", "keys")]
                streams[1].write(np.zeros(1, "<i8").tobytes())
            ends = []
            for tokens in ids_of(batch.column("text")):
                streams[0].write(np.append(tokens, np.uint32(end)).astype(kind).tobytes())
                ids += len(tokens) + 1
                ends.append(ids)
            streams[1].write(np.array(ends, "<i8").tobytes())
            keys = batch.column("doc_id")
            streams[2].write(keys.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
            nulls += keys.null_count
            documents += batch.num_rows
    if documents:
        yield pa.RecordBatch.from_pylist([{"name": name, "width": width, "documents": documents, "ids": ids,
                                           "nulls": nulls, "first_document": 0, "first_id": 0}], _SCHEMA)


_SCHEMA = pa.schema([("name", pa.string()), ("width", pa.int32()), *[
    (c, pa.int64()) for c in ("documents", "ids", "nulls", "first_document", "first_id")]])


def write(docs: DataFrame, tokenizer: str, end: int, folder: str) -> None:
    """Write the token files of ``docs`` (doc_id of a whole-number type, text) to the new ``folder``, with the
    id ``end`` behind every document."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), "text")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cores = spark.sparkContext.defaultParallelism
    parts = max(1, -(-size // PART_BYTES), min(PARTS_PER_CORE * cores, -(-size // LEAST_PART_BYTES)))
    system, path = _open(folder)
    system.create_dir(path)
    ordered = texts.repartitionByRange(parts, "doc_id", "row").sortWithinPartitions("doc_id", "row")
    found = ordered.mapInArrow(
        lambda batches: _written(batches, folder, tokenizer, end), _MANIFEST).collect()  # one row per file
    found.sort(key=lambda r: r.name)
    documents, ids = (np.cumsum([0, *[r[c] for r in found]]).tolist() for c in ("documents", "ids"))
    based = [(r.name, r.width, r.documents, r.ids, r.nulls, d, i) for r, d, i in zip(found, documents, ids)]
    known = {r.name for r in found}
    for file in system.get_file_info(pafs.FileSelector(path)):
        if file.base_name.partition(".")[0] not in known:
            system.delete_file(file.path)
    spark.createDataFrame(based, _MANIFEST).coalesce(1).write.parquet(f"{folder}/manifest")


@lru_cache(maxsize=16)
def _mapped(folder: str, file: str, kind: str):
    """A function (first, count) -> numbers of a file: a view of its memory map, or a range that is read."""
    system, path = _open(folder)
    if isinstance(system, pafs.LocalFileSystem):
        numbers = np.memmap(f"{path}/{file}", kind, "r")
        return lambda first, count: numbers[first : first + count]
    opened, width = system.open_input_file(f"{path}/{file}"), np.dtype(kind).itemsize
    return lambda first, count: np.frombuffer(opened.read_at(count * width, first * width), kind)


def _read(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Spans of documents -> the documents."""
    for batch in batches:
        for span in batch.to_pylist():
            name, width = span["name"], span["width"]
            offsets, keys, ids = (_mapped(folder, f"{name}.{kind}", how) for kind, how in (
                ("offsets", "<i8"), ("keys", "<i8"), ("ids", f"<u{width}")))
            at, last = span["first"], span["first"] + span["many"]
            while at < last:
                bounds = offsets(at, min(last - at, 65536) + 1)
                # as many documents as fit, one at least
                many = max(1, int(np.searchsorted(bounds[1:], bounds[0] + MOST_BYTES // 4, side="right")))
                bounds = np.asarray(bounds[: many + 1])
                held = ids(int(bounds[0]), int(bounds[-1] - bounds[0])).astype("<u4").tobytes()
                cuts = (bounds - bounds[0]) * 4
                number = np.arange(at, at + many)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.asarray(keys(at, many)), mask=number < span["nulls"]),
                     pa.array(number + span["first_document"]), pa.array(bounds[:-1] + span["first_id"]),
                     pa.array(np.diff(bounds)),
                     pa.array([held[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())], pa.binary())],
                    names=["doc_id", "number", "start", "n_tokens", "ids"])
                at += many


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, number, start, n_tokens, ids) of every document of the token files in ``folder``: its place
    among all documents and all ids, and its ids as little-endian 32-bit numbers."""
    manifest = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    size = F.col("ids") * F.col("width") / F.col("documents")  # mean of a document
    many = F.greatest(F.lit(1.0), F.floor(F.lit(float(SPAN_BYTES)) / size)).cast("long")
    spans = manifest.withColumn("step", many).select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("documents") - 1, F.col("step"))).alias("first"))
    spans = spans.withColumn("many", F.least("step", F.col("documents") - F.col("first")))
    count = spans.count()
    return spans.repartition(max(count, 1)).mapInArrow(
        lambda batches: _read(batches, folder), "doc_id long, number long, start long, n_tokens long, ids binary")


class TokenFiles:
    """Random access to the documents of a folder, by their number, without Spark: what a training loop reads."""

    def __init__(self, folder: str):
        self.folder = folder
        system, path = _open(folder)
        table = pq.read_table(f"{path}/manifest", filesystem=system)
        self.parts = sorted(table.to_pylist(), key=lambda r: r["first_document"])
        self.firsts = [r["first_document"] for r in self.parts]

    def __len__(self) -> int:
        return sum(r["documents"] for r in self.parts)

    def __getitem__(self, number: int) -> np.ndarray:
        if not 0 <= number < len(self):
            raise IndexError(number)
        part = self.parts[int(np.searchsorted(self.firsts, number, side="right")) - 1]
        first, end = _mapped(self.folder, f"{part['name']}.offsets", "<i8")(number - part["first_document"], 2)
        return _mapped(self.folder, f"{part['name']}.ids", f"<u{part['width']}")(int(first), int(end - first))
