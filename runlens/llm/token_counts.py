"""Token totals kept up to date by signed changes.

A change is a row of group columns with a sign: +1 for an inserted document, -1 for a deleted one, and
both for a revised one, the old counts negative and the new ones positive. A batch of changes is
reduced to one signed sum per group before anything moves further, and committed under an id of the
caller's choice:

* the sums are written aside, then renamed to ``batch=<id>``, in one step of the file system;
* a batch whose id is already committed, or was folded into a compacted base, is ignored, so a
  batch that is delivered again, or retried after a lost executor or driver, counts once;
* totals are the sums over base and batches; groups that cancel to no documents vanish.

Two writers may commit different ids at a time; compaction must have the folder to itself.

Edge cases. Null group columns are groups of their own. Null and empty texts have 0 tokens and count
as documents. Repeated rows count as often as they occur. Deleting what was never inserted leaves
negative totals, which are shown. An empty batch is committed as empty. Columns of the changes other
than groups and counts are ignored.
"""

import re
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.llm import pieces
from runlens.llm.batches import bounded
from runlens.llm.byte_bpe import encoder
from runlens.sources.staging import remove_folder

GROUPS = ("source", "lang", "tokenizer")
COUNTS = ("n_docs", "n_tokens")
_SCHEMA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


def count_tokens(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, source, lang, n_tokens) of every whole text, by the tokenizer in a file: a sentencepiece model
    (``.model``), or byte-level BPE of the tokenizers library."""
    kept = ["doc_id", "source", "lang"]

    def encoded(texts: pa.Array) -> Iterator[np.ndarray]:
        if tokenizer.endswith(".model"):
            return pieces.model(tokenizer).encode([t or "" for t in texts.to_pylist()])
        return encoder(tokenizer)(texts)

    def count(batches):
        for batch in bounded(batches):
            n = np.fromiter(map(len, encoded(batch.column("text"))), np.int64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(n)], names=[*kept, "n_tokens"])

    kinds = dict(docs.dtypes)
    return docs.select(*kept, "text").mapInArrow(count, ", ".join(f"{c} {kinds[c]}" for c in kept) + ", n_tokens long")


def _signed(counted: DataFrame, sign: int) -> DataFrame:
    return counted.select(*GROUPS, F.lit(sign).cast("long").alias("n_docs"),
                          (sign * F.col("n_tokens")).cast("long").alias("n_tokens"))


def inserts(counted: DataFrame) -> DataFrame:
    """Changes for new documents: rows with the group columns and ``n_tokens``."""
    return _signed(counted, 1)


def deletes(counted: DataFrame) -> DataFrame:
    """Changes for documents that go, as they were counted."""
    return _signed(counted, -1)


def revisions(before: DataFrame, after: DataFrame) -> DataFrame:
    """Changes for documents counted anew, under the same or other groups."""
    return deletes(before).unionByName(inserts(after))


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*GROUPS).agg(*[F.sum(c).cast("long").alias(c) for c in COUNTS])


class Rollup:
    """Totals below ``path``, a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        folder = self._path(self.path)
        self.fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        self.fs.mkdirs(folder)

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _folders(self, kind: str) -> list[str]:
        names = [s.getPath().getName() for s in self.fs.listStatus(self._path(self.path))]
        return sorted(n for n in names if re.match(f"{kind}=", n))

    def _base(self) -> str | None:
        """The newest complete base; an older one may be left by an interrupted compaction."""
        return max(self._folders("base"), key=lambda n: int(n[5:]), default=None)

    def _folded(self) -> set[str]:
        """Folder names of batches that the base holds."""
        base = self._base()
        if base is None:
            return set()
        rows = self.spark.read.schema("batch string").parquet(f"{self.path}/{base}/batches")
        return {r.batch for r in rows.toLocalIterator()}

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Add a batch of changes; False if its id was committed before, and nothing is added."""
        name = f"batch={quote(batch_id, safe='')}"
        target = self._path(f"{self.path}/{name}")
        if self.fs.exists(target) or name in self._folded():
            return False
        aside = f"{self.path}/_writing-{name[6:]}"
        _summed(changes.select(*GROUPS, *COUNTS)).write.mode("overwrite").parquet(aside)
        done = not self.fs.exists(target) and self.fs.rename(self._path(aside), target)
        remove_folder(self.spark, aside)
        return done

    def _rows(self, batches: list[str]) -> DataFrame:
        base = self._base()
        paths = [f"{self.path}/{n}" for n in batches] + ([f"{self.path}/{base}/totals"] if base else [])
        if not paths:
            return self.spark.createDataFrame([], _SCHEMA)
        return self.spark.read.schema(_SCHEMA).parquet(*paths)

    def totals(self) -> DataFrame:
        """One row per group: (source, lang, tokenizer, n_docs, n_tokens)."""
        folded = self._folded()
        pending = [n for n in self._folders("batch") if n not in folded]
        return _summed(self._rows(pending)).where("n_docs <> 0 or n_tokens <> 0")

    def compact(self) -> None:
        """Fold all committed batches into a new base, then remove what it replaces. Until the base is
        renamed into place readers use the old one; after that, batches it names are passed over."""
        folded, base = self._folded(), self._base()
        pending = [n for n in self._folders("batch") if n not in folded]
        if pending:
            number = int(base[5:]) + 1 if base else 0
            aside = f"{self.path}/_writing-base-{number}"
            _summed(self._rows(pending)).write.mode("overwrite").parquet(f"{aside}/totals")
            names = [(n,) for n in sorted(folded.union(pending))]
            self.spark.createDataFrame(names, "batch string").coalesce(1).write.mode("overwrite").parquet(
                f"{aside}/batches")
            self.fs.rename(self._path(aside), self._path(f"{self.path}/base={number}"))
        newest = self._base()
        held = self._folded()
        for name in self._folders("base") + self._folders("batch"):
            if (name.startswith("base=") and name != newest) or name in held:
                remove_folder(self.spark, f"{self.path}/{name}")
