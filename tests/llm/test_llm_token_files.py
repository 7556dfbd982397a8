"""Token files: exact round trips against the tokenizers library."""

import os
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from runlens.llm import token_files
from runlens.llm.token_files import TokenFiles
from runlens.sources.staging import new_folder

PATH = public_tokenizers.path("byte_bpe_50k.json")


def ids_of(text, end=2):
    library = Tokenizer.from_file(PATH)
    return [*library.encode(text or "", add_special_tokens=False).ids, end]


def written(df, end=2):
    folder = new_folder(df.sparkSession, "token-files")
    token_files.write(df, PATH, end, folder)
    return folder, token_files.read(df.sparkSession, folder).orderBy("number").collect()


def check(rows, got, end=2):
    assert [r.number for r in got] == list(range(len(rows)))
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got]).tolist()][:-1]
    order = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert order == sorted(order)
    want = Counter((i, tuple(ids_of(t, end))) for i, t in rows)
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got) == want
    assert all(r.n_tokens == len(r.ids) // 4 for r in got)


@pytest.mark.parametrize("part_bytes", [4 << 20, 1000])
def test_edge_cases_come_back(spark, edge_docs, edge_rows, monkeypatch, part_bytes):
    monkeypatch.setattr(token_files, "PART_BYTES", part_bytes)
    monkeypatch.setattr(token_files, "SPAN_BYTES", part_bytes)
    folder, got = written(edge_docs)
    check([(r[0], r[1]) for r in edge_rows], got)
    files = TokenFiles(folder)
    assert len(files) == len(got) and (part_bytes > 1000 or len(files.parts) > 20)
    for r in got:
        assert files[r.number].astype("<u4").tobytes() == r.ids and files[r.number].dtype == np.uint16
    with pytest.raises(IndexError):
        files[len(files)]


def test_a_repeated_id_is_split_over_files(spark, monkeypatch):
    monkeypatch.setattr(token_files, "PART_BYTES", 500)
    rows = [(7, f"text number {k}") for k in range(400)] + [(None, "x")] * 200 + [(k, "") for k in range(100)]
    folder, got = written(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    check(rows, got)
    parts = TokenFiles(folder).parts
    assert max(p["documents"] for p in parts) < 200 and sum(p["nulls"] for p in parts) == 200


def test_wide_ids_take_32_bits(spark):
    rows = [(1, "some words"), (2, None)]
    folder, got = written(spark.createDataFrame(rows, "doc_id int, text string"), end=70_000)
    check(rows, got, end=70_000)
    assert TokenFiles(folder)[1].tolist() == [70_000] and TokenFiles(folder)[1].dtype == np.uint32


def test_nothing_and_files_of_lost_attempts(spark, no_docs, monkeypatch):
    folder, got = written(no_docs)
    assert got == [] and len(TokenFiles(folder)) == 0
    folder = new_folder(spark, "token-files")
    os.makedirs(folder)
    with open(f"{folder}/00000000-lost.ids", "wb") as f:
        f.write(b"1234")
    token_files.write(spark.createDataFrame([(1, "a")], "doc_id long, text string"), PATH, 2, folder)
    assert not os.path.exists(f"{folder}/00000000-lost.ids")
    assert TokenFiles(folder)[0].tolist() == ids_of("a")


def test_registered_query(spark, sf_dir):
    got = entry.queries()["op13_token_files"](spark, sf_dir).orderBy("start").collect()
    docs, start = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect(), 0
    assert len(got) == len(docs)
    for r, d in zip(got, docs):
        ids = np.array(ids_of(d.text), "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d.doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
