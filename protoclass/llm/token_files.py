"""Operator 1: token ids in Simple-8b files.

``write_token_files`` orders the documents by id with a range partitioning
(ties on the id by a hash of the text, so a hot id spreads), tokenises and packs
them in the same tasks, and writes segments: runs of whole documents of about
``SEGMENT_IDS`` ids as one binary value of the layout in ``simple8b``. The
files are Parquet, one for each range partition ("shard"), so that any store
that Spark writes to can hold them. ``read_token_files`` decodes them.

Defined results: a null or empty text has the end id alone; null ids sort
first; repeated rows are documents of their own; an empty table has no segment;
columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import os
import re
import string
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from protoclass.llm.common import CACHES, in_worker, shuffle_partitions, table, text_batches
from protoclass.session import scratch_path

SEGMENT_IDS = 1 << 18
END_ID = 2
#: Words in the young half of a Python worker's cache. When it is full, it
#: becomes the old half, from which words that are met again come back.
CACHE_WORDS = 300_000
#: Texts taken out of an Arrow batch at a time.
ROWS_AT_ONCE = 256
CACHE_WORD_CHARS = 64
CACHE_MARKS = 10_000

_OTHER_SPACE = re.compile(r"[^\S \n]")

SEGMENTS = "shard int, segment int, shard_start bigint, n_ids bigint, doc_ids array<bigint>, payload binary"
_SEGMENTS = pa.schema([("shard", pa.int32()), ("segment", pa.int32()), ("shard_start", pa.int64()), ("n_ids", pa.int64()),
                       ("doc_ids", pa.list_(pa.int64())), ("payload", pa.binary())])


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte:
    itself if printable in Latin-1, else the next letter from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(0x100 + i) for i, b in enumerate(others)}


class _Marks(dict):
    """Bounded cache from the marks behind a word to their ids as bytes."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer = tokenizer

    def __missing__(self, marks: str) -> bytes:
        ids = _ids(self.tokenizer, marks)
        if len(self) < CACHE_MARKS and len(marks) <= CACHE_WORD_CHARS:
            self[marks] = ids
        return ids


class _Words(dict):
    """Bounded cache from words (runs without blanks) behind ``lead`` to their
    ids as bytes; None: must be tokenised within the text."""

    def __init__(self, tokenizer, lead: str):
        super().__init__()
        self.tokenizer, self.merge, self.lead = tokenizer, tokenizer.model.tokenize, lead
        self.letters = _byte_letters()
        self.lead_letters = lead.translate(self.letters)
        self.marks = _Marks(tokenizer)
        self.old: dict[str, bytes | None] = {}

    def __missing__(self, word: str) -> bytes | None:
        if len(self) >= CACHE_WORDS:
            self.old = dict(self)
            self.clear()
        if word in self.old:
            ids = self[word] = self.old[word]
            return ids
        body = word.rstrip(string.punctuation)
        if body.isalpha() and (body.isascii() or max(body) < "\u0250"):
            if body != word:
                return self[body] + self.marks[word[len(body) :]]
            letters = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
            ids = array("I", [t.id for t in self.merge(self.lead_letters + letters)]).tobytes()
        elif _OTHER_SPACE.search(word):  # can tie a word to its neighbours
            ids = None
        else:
            ids = _ids(self.tokenizer, self.lead + word)
        if len(word) <= CACHE_WORD_CHARS:
            self[word] = ids
        return ids


class Encoder:
    """Whole texts to arrays of ids.

    Byte-level vocabularies split a text into words with the blank before them
    before they merge, so a text whose words stand one blank or newline apart
    is the concatenation of its words' ids. Texts of another shape go whole.
    ``plain`` is off for vocabularies that split otherwise.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.first, self.next = _Words(self.tokenizer, ""), _Words(self.tokenizer, " ")
        self.newline = _ids(self.tokenizer, "\n")
        probes = ["The words, don\'t they.\nA (few) 12 \u00e9t\u00e9s, etc.", "a  b \n\n c\n \nd ", "x!!\ty"]
        self.plain = all(self._by_words(t) in (None, _ids(self.tokenizer, t)) for t in probes)

    def _by_words(self, text: str) -> bytes | None:
        lines = text.split("\n")
        if "" in lines or "  " in text or " \n" in text or "\n " in text or text[0] == " " or text[-1] == " ":
            return None
        first, get, out = self.first, self.next.__getitem__, []
        try:
            for line in lines:
                words = line.split(" ")
                out.append(first[words[0]] + b"".join(map(get, words[1:])))
        except TypeError:  # a None among them
            return None
        return self.newline.join(out)

    def encode(self, text: str) -> np.ndarray:
        data = (self._by_words(text) if self.plain else None) if text else b""
        return np.frombuffer(_ids(self.tokenizer, text) if data is None else data, "<u4")


def _ids(tokenizer, text: str) -> bytes:
    return array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


_ENCODERS: dict[str, Encoder] = {}


CACHES["token_files"] = _ENCODERS.clear


def encoder(path: str) -> Encoder:
    """The worker's encoder; kept between tasks because loading takes time."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Writes the ids of all documents, in ascending ``doc_id`` order, to ``path``."""
    from protoclass.llm import simple8b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        shard = TaskContext.get().partitionId()
        ids: list[np.ndarray] = []
        doc_ids: list[int | None] = []
        segment = start = held = 0
        end = np.array([end_id], "<u4")

        def close() -> pa.RecordBatch:
            lengths = np.array([len(x) + 1 for x in ids[::2]], np.int64)  # each followed by the end id
            return pa.RecordBatch.from_pydict(
                {"shard": [shard], "segment": [segment], "shard_start": [start], "n_ids": [held], "doc_ids": [doc_ids],
                 "payload": [simple8b.to_bytes(np.concatenate(ids), lengths)]}, schema=_SEGMENTS)

        for b in (b.slice(a, ROWS_AT_ONCE) for b in batches for a in range(0, b.num_rows, ROWS_AT_ONCE)):
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                row = enc.encode(text or "")
                ids += row, end
                doc_ids.append(doc_id)
                held += len(row) + 1
                if held >= SEGMENT_IDS:
                    yield close()
                    segment, start, held, ids, doc_ids = segment + 1, start + held, 0, [], []
        if ids:
            yield close()

    spark = docs.sparkSession
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text"), F.col("text")]
    ranged = narrow.repartitionByRange(shuffle_partitions(spark), *order[:2]).sortWithinPartitions(*order)
    segments = ranged.mapInArrow(in_worker("token_files", run), SEGMENTS)
    with text_batches(spark):
        # Pages are cut by size from the first row on: by default the size of a page is looked
        # at after 100 rows, and so many segments are compressed and read in one piece.
        segments.write.option("parquet.page.size.row.check.min", 1).parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document from the files: doc_id, start (ids before it in the
    whole order), n_tokens, ids_crc32, shard, and ids (array<bigint>; not
    decoded into rows unless it is selected by ``with_ids``)."""
    return _read(spark, path, with_ids=True)


def read_token_digests(spark: SparkSession, path: str) -> DataFrame:
    """As ``read_token_files`` without the ids."""
    return _read(spark, path, with_ids=False)


def _read(spark: SparkSession, path: str, with_ids: bool) -> DataFrame:
    from protoclass.llm import simple8b

    segments = spark.read.schema(SEGMENTS).parquet(path)
    # One row for each shard, of which there are as many as shuffle partitions.
    shards = segments.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    w = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select(F.col("shard").alias("_shard"), F.coalesce(F.sum("n").over(w), F.lit(0)).alias("_base"))
    joined = segments.join(F.broadcast(shards), F.col("shard") == F.col("_shard"))
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("shard", pa.int32())]
    schema = pa.schema(fields + [("ids", pa.list_(pa.int64()))] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (b.slice(a, 1) for b in batches for a in range(b.num_rows)):
            for shard, start, base, doc_ids, data in zip(*(b.column(c).to_pylist() for c in ("shard", "shard_start", "_base", "doc_ids", "payload")), strict=True):
                ids, lengths = simple8b.from_bytes(data)
                ends = np.cumsum(lengths)
                starts = ends - lengths
                small = ids.astype("<u4")
                columns = [pa.array(doc_ids, pa.int64()), pa.array(starts + (start + base)), pa.array(lengths),
                           pa.array([zlib.crc32(small[a:z]) for a, z in zip(starts, ends, strict=True)], pa.int64()),
                           pa.array(np.full(len(lengths), shard, np.int32))]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(starts, ends[-1:]), pa.int32()), pa.array(ids.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    ddl = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, shard int" + ", ids array<bigint>" * with_ids
    return joined.select("shard", "shard_start", "_base", "doc_ids", "payload").mapInArrow(in_worker("token_files", run), ddl)


def token_ids(docs: DataFrame, tokenizer: str | None = None, path: str | None = None) -> DataFrame:
    """Writes the files (to a fresh shared folder unless ``path`` is given) and
    returns their digests, one row per document."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-files")
    write_token_files(docs, path, tokenizer or public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_digests(spark, path)


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_ids(table(spark, sf_dir, "documents"))
