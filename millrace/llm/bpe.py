"""BPE encoding and decoding through a table of distinct words.

Documents are dealt into buckets of bounded size, as packed words.  Each bucket
sends its distinct words to the parts of one table, dealt by the word; a part
encodes every distinct word once and sends the ids back, and each document looks its
words up by position.  Decoding joins ids to the pieces of the vocabulary.  What is
shuffled are packed pages of documents, words and ids, not single rows.

Defined results: a null or empty text has no ids and decodes to the empty text;
special tokens written in a text become their ids, as the library does; repeated
rows are encoded one by one; an empty table gives an empty table; other columns
stay, and a column named like a result is replaced by it.
"""

from __future__ import annotations

import json
import math
import os
import re
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

from millrace.llm.frames import named_again, parts_for, plain_names

#: Bytes of text in a bucket: what one task holds, with its words and ids.
BUCKET_BYTES = 12_000_000
#: Characters whose normal form, case and white space Python and the library agree on.
PLAIN = r"\t-\r \x21-\u024f\u2010-\u2027\u2030-\u205e\u20ac"
#: In front of special tokens written in a text; words have no capital letters.
SPECIAL = "S"


def _spec(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


@cache
def splitter(path: str) -> Callable[[str], list[str]]:
    """The words of a text: what white space separates once the text is normalized.

    No token spans white space, so a word has the same ids wherever it stands.
    Special tokens are words of their own.  Texts of plain characters are
    normalized by Python, others by the library; its vocabulary isn't needed here.
    """
    spec = _spec(path)
    specials = [t["content"] for t in spec["added_tokens"]]
    special = re.compile("(" + "|".join(map(re.escape, specials)) + ")")
    spec["added_tokens"], spec["model"] = [], {"type": "BPE", "vocab": {}, "merges": []}
    normalizer = Tokenizer.from_str(json.dumps(spec)).normalizer
    odd = re.compile(f"[^{PLAIN}]").search

    def plain(text: str) -> list[str]:
        if odd(text) is None:
            return text.lower().split()
        # The normalizer leaves blanks as the only white space.
        return [w for w in normalizer.normalize_str(text).split(" ") if w]

    def of(text: str | None) -> list[str]:
        if not text:
            return []
        if not any(s in text for s in specials):
            return plain(text)
        found: list[str] = []
        for part in special.split(text):
            if part in specials:
                found.append(SPECIAL + part)
            elif part:
                found += plain(part)
        return found

    return of


@cache
def word_encoder(path: str) -> Callable[[list[str]], list[bytes]]:
    """Words of ``splitter`` to ids as little-endian 32-bit integers."""
    spec = _spec(path)
    special = {SPECIAL + t["content"]: t["id"] for t in spec["added_tokens"]}
    spec["normalizer"], spec["added_tokens"] = None, []
    # Spark runs the tasks side by side; threads within one only add memory.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    model = Tokenizer.from_str(json.dumps(spec))

    def encode(words: list[str]) -> list[bytes]:
        rows = model.encode_batch_fast(words, add_special_tokens=False)
        ids = ([special[w]] if w in special else r.ids for w, r in zip(words, rows, strict=True))
        return [np.asarray(x, "<u4").tobytes() for x in ids]

    return encode


def pieces(path: str) -> list[str]:
    """The vocabulary by id: as long as the tokenizer's, whatever the corpus."""
    found = Tokenizer.from_file(path).get_vocab(with_added_tokens=True)
    out = [""] * (max(found.values()) + 1)
    for piece, i in found.items():
        out[i] = piece
    return out


def _pack(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))
    with pa.ipc.new_stream(sink, batch.schema, options=options) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack(page: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(page.as_buffer()).read_all()


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _deal(path: str, text: str) -> Callable:
    """Pages of the rows of each bucket, with texts as words, one a line (null: none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter(path)
        for batch in batches:
            bucket = batch["bucket"].to_numpy()
            rest, texts = batch.drop_columns([text, "bucket"]), batch[text]
            order = np.argsort(bucket, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
                if len(rows):
                    words = pa.array(["\n".join(split(texts[i].as_py())) or None for i in rows.tolist()], pa.large_string())
                    page = _pack(rest.take(pa.array(rows)).append_column("words", words))
                    yield pa.record_batch({"bucket": pa.array(bucket[rows[:1]], pa.int32()), "page": pa.array([page], pa.binary())})

    return run


def _split(page: pa.Table) -> tuple[np.ndarray, pa.Array]:
    """How many words each row of a page has, and all of them."""
    lists = pc.split_pattern(page["words"].combine_chunks(), "\n")
    counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return counts, lists.flatten()


def _bucket_words(pages: pa.Table, parts: int) -> tuple[np.ndarray, pa.Array]:
    """The distinct words of a bucket, by the part of the word table they belong to, sorted."""
    none = pa.array([], pa.large_string())
    words = pc.unique(pa.concat_arrays([none, *[_split(_unpack(page))[1] for page in pages["page"]]]))
    words = words.take(pc.array_sort_indices(words))
    part = np.fromiter((zlib.crc32(w.encode()) % parts for w in words.to_pylist()), np.int64, len(words))
    order = np.argsort(part, kind="stable")
    return part[order], words.take(pa.array(order))


def _word_pages(parts: int) -> Callable:
    """A bucket's distinct words, a page for each part of the word table."""

    def run(pages: pa.Table) -> pa.Table:
        part, words = _bucket_words(pages, parts)
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
        spans = [(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a]
        made = [_pack(pa.record_batch({"word": words.slice(a, b - a)})) for a, b in spans]
        return pa.table(
            {
                "bucket": pa.array([pages["bucket"][0].as_py()] * len(spans), pa.int32()),
                "part": pa.array([int(part[a]) for a, _ in spans], pa.int32()),
                "page": pa.array(made, pa.binary()),
            }
        )

    return run


def _encode_pages(path: str) -> Callable:
    """Pages of words to pages of ids in the same order; a part's words are encoded once each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_encoder(path)
        table: dict[str, bytes] = {}
        for batch in batches:
            for bucket, part, page in zip(batch["bucket"], batch["part"], batch["page"], strict=True):
                words = _unpack(page)["word"].to_pylist()
                new = [w for w in words if w not in table]
                table.update(zip(new, encode(new), strict=True))
                ids = [table[w] for w in words]
                values = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
                lists = _lists(values, np.array([len(x) // 4 for x in ids]))
                made = _pack(pa.record_batch({"ids": lists}))
                yield pa.record_batch(
                    {
                        "bucket": pa.array([bucket.as_py()], pa.int32()),
                        "part": pa.array([part.as_py()], pa.int32()),
                        "page": pa.array([made], pa.binary()),
                    }
                )

    return run


def _place(names: list[str], parts: int, packed: bool, schema: pa.Schema) -> Callable:
    def run(pages: pa.Table, known: pa.Table) -> pa.Table:
        _, words = _bucket_words(pages, parts)
        # Pages of ids in the order of the words: by part, then sorted.
        lists = [_unpack(page)["ids"].combine_chunks() for page in known.sort_by("part")["page"]]
        ids = np.concatenate([np.zeros(0, np.int32), *[x.flatten().to_numpy() for x in lists]])
        sizes = np.concatenate([np.zeros(0, np.int64), *[np.diff(x.offsets.to_numpy()) for x in lists]])
        starts = np.cumsum(sizes) - sizes
        if not len(pages):
            return schema.empty_table()
        docs = pa.concat_tables([_unpack(page) for page in pages["page"]])
        counts, flat = _split(docs)
        placed = pc.index_in(flat, value_set=words).to_numpy(zero_copy_only=False)
        n = sizes[placed]
        ends = np.concatenate([[0], np.cumsum(n)])
        values = ids[np.repeat(starts[placed] - ends[:-1], n) + np.arange(ends[-1])]
        offsets = ends[np.concatenate([[0], np.cumsum(counts)])].astype(np.int32)
        if packed:
            data = pa.py_buffer(values.astype("<u4"))
            column = pa.BinaryArray.from_buffers(pa.binary(), len(docs), [None, pa.py_buffer(4 * offsets), data])
        else:
            column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
        return pa.table({c: docs[c] for c in names} | {"ids": column})

    return run


def encode(docs: DataFrame, path: str, text: str = "text", out: str = "ids", packed: bool = False) -> DataFrame:
    """Replace each whole text by its token ids; other columns stay.

    The ids are an array of int, or ``packed`` as little-endian 32-bit integers.
    """
    plain, names = plain_names(docs)
    column = names.pop(text)
    plain = plain.withColumn(column, F.col(column).cast("string"))
    buckets = parts_for(plain, column, BUCKET_BYTES)
    # The vocabulary grows more slowly than the text.
    parts = max(3 * docs.sparkSession.sparkContext.defaultParallelism, math.ceil(buckets**0.6))
    key = F.pmod(F.xxhash64(*plain.columns), F.lit(buckets)).cast("int")
    dealt = plain.withColumn("bucket", key).mapInArrow(_deal(path, column), "bucket int, page binary").repartition(buckets, "bucket")
    words = dealt.groupBy("bucket").applyInArrow(_word_pages(parts), "bucket int, part int, page binary")
    known = words.repartition(parts, "part").mapInArrow(_encode_pages(path), "bucket int, part int, page binary")
    known = known.repartition(buckets, "bucket")
    kept = list(names.values())
    kind = T.BinaryType() if packed else T.ArrayType(T.IntegerType())
    schema = T.StructType([*plain.select(*kept).schema.fields, T.StructField("ids", kind)])
    placed = dealt.groupBy("bucket").cogroup(known.groupBy("bucket"))
    return named_again(placed.applyInArrow(_place(kept, parts, packed, to_arrow_schema(schema)), schema), names, **{out: "ids"})


def decode(encoded: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the text of each row's ids: their pieces, as the library joins them.

    The ids are an array or packed.  The pieces go to every executor: one string for
    each id of the vocabulary, whose size the tokenizer file fixes.  An id outside the
    vocabulary and a null among the ids add nothing; null ids decode to the empty text.
    """
    plain, names = plain_names(encoded)
    table = plain.sparkSession.sparkContext.broadcast(pieces(path))
    column, kept = names[ids], list(names.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(table.value)
        piece = pa.array([f"{p} " for p in table.value], pa.large_string())
        for batch in batches:
            for rows in (batch.slice(i, 500) for i in range(0, len(batch), 500)):
                each = [_ids(x) for x in rows[column]]
                each = [x[(x >= 0) & (x < size)] for x in each]
                joined = piece.take(pa.array(np.concatenate(each)))
                # The pieces lie one after the other; rows are cut out of them.
                cuts = np.concatenate([[0], np.cumsum([len(x) for x in each])])
                where = np.frombuffer(joined.buffers()[1], np.int64)[: len(joined) + 1] if len(joined) else np.zeros(1, np.int64)
                texts = pa.LargeStringArray.from_buffers(len(each), pa.py_buffer(where[cuts].copy()), joined.buffers()[2])
                made = pc.utf8_rtrim(texts, characters=" ").cast(pa.string())
                yield pa.record_batch([rows[n] for n in kept] + [made], [*kept, "text"])

    schema = T.StructType([*plain.schema.fields, T.StructField("text", T.StringType())])
    return named_again(plain.mapInArrow(run, schema), names, **{out: "text"})


def _ids(row: pa.Scalar) -> np.ndarray:
    if not row.is_valid:
        return np.zeros(0, np.int32)
    if isinstance(row, pa.BinaryScalar):
        return np.frombuffer(row.as_buffer(), "<u4")
    return row.values.drop_null().to_numpy()


def default_path() -> str:
    """The tokenizer file that the registered query and the pipeline use."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
