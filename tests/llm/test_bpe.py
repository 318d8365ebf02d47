import hashlib
import struct

import pytest
from tokenizers import Tokenizer

from millrace.llm import bpe
from millrace.llm.queries import QUERIES

PATH = bpe.default_path()
TEXTS = [
    None,
    "",
    " \n\t ",
    "Hello, WORLD's 42 cats!!",
    "H̱ ẖ İstanbul ΣΑΣ Ω \x1ca\x85b\xa0c　d",
    "a<|startoftext|>b <|STARTOFTEXT|> <|endoftext|>",
    "中文 1²½ \U0001f600 I'LL you'll",
    "word " * 20_000 + "x" * 5_000,
    "Hello, WORLD's 42 cats!!",
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def test_round_trip_as_the_library_does(spark, library):
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, bucket int")
    found = bpe.decode(bpe.encode(docs, PATH), PATH)
    assert set(found.columns) == {"doc_id", "ids", "bucket", "decoded"}
    for row in found.collect():
        want = library.encode(TEXTS[row["doc_id"]] or "", add_special_tokens=False).ids
        assert row["ids"] == want
        assert row["decoded"] == library.decode(want, skip_special_tokens=False)
    assert found.count() == len(TEXTS)


def test_empty_table_and_odd_ids(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(none, PATH), PATH).collect() == []
    odd = spark.createDataFrame([(1, [5, None, -1, 10**6]), (2, None)], "doc_id long, ids array<int>")
    found = {r["doc_id"]: r["decoded"] for r in bpe.decode(odd, PATH).collect()}
    assert found == {1: bpe.pieces(PATH)[5], 2: ""}


def test_registered_query_digests(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    found = {r["doc_id"]: r for r in QUERIES["op1_bpe"](spark, "/root/testdata/sf0.001").collect()}
    assert len(found) == len(docs)
    for row in docs:
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        got = found[row["doc_id"]]
        assert got["n_tokens"] == len(ids)
        assert got["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert got["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
