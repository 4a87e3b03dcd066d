"""Operator 4: substring dedup by hashing lines, and the sentences in them.

Every line of a text is normalised (lower case, blanks as one) and hashed whole
to 128 bits, however short it is; so whole repeated lines and paragraphs are
found. On a second level a line is cut behind sentence ends, and its units of at
least ``MIN_WORDS`` words are hashed alike, for lines whose rest differs. Over
all documents the earliest occurrence of a digest, by (doc_id, hash of the text,
start), stays; the others are removed, with their offsets in the original text
kept: a line as the spans of all its units, short ones too.

Not found, in lines that are not repeated whole: units below ``MIN_WORDS``, and
runs that do not begin and end where a unit does.

Digests are counted by an aggregate with partial results per task, so a line of
a third of all documents is one row per task; occurrences meet the first one in
a join that adaptive execution splits where a digest is hot. Only lines and
units of repeated digests come out, and a document's own are its longest list.

Defined results: null and empty texts and blank lines have no unit; a unit that
repeats inside a document goes like any other; of repeated rows (one id and
text) each keeps what the first keeps; null ids sort first; an empty table gives
no rows; other columns are not read, and pass through ``without_repeats`` as
they came.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from protoclass.llm.common import in_worker, packed, same, table, written

MIN_WORDS = 8
_UNIT = re.compile(r"[^\n]+?(?:[.!?]+(?=\s)|(?=\n)|\Z)")


def units(text: str, min_words: int = MIN_WORDS) -> list[tuple[int, int, bytes]]:
    """(start, end, digest) of every unit of enough words, in code points (the second level alone)."""
    out = []
    for m in _UNIT.finditer(text):
        words = m[0].lower().split()
        if len(words) >= min_words:
            start = m.end() - len(m[0].lstrip())
            out.append((start, m.end(), xxhash.xxh3_128_digest(" ".join(words).encode())))
    return out


def lines(text: str, min_words: int = MIN_WORDS) -> Iterator[tuple[list[tuple[int, int]], bytes]]:
    """(spans, digest) of every line, with the spans of all its units, and of
    every unit of enough words in a line that has others beside it."""
    at = 0
    for line in text.split("\n"):
        words = line.lower().split()
        if words:
            spans, long = [], []
            for m in _UNIT.finditer(line):
                own = m[0].lower().split()
                if own:
                    spans.append((at + m.end() - len(m[0].lstrip()), at + m.end()))
                    if len(own) >= min_words:
                        long.append((spans[-1:], own))
            yield spans, xxhash.xxh3_128_digest(" ".join(words).encode())
            if len(spans) > 1:
                for span, own in long:
                    yield span, xxhash.xxh3_128_digest(" ".join(own).encode())
        at += len(line) + 1


def occurrences(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, text_hash, spans (start, stop), digest of every line and unit."""
    span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("spans", pa.list_(span)), ("digest", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (b.slice(a, 256) for b in batches for a in range(0, b.num_rows, 256)):
            ids, hashes, starts, stops, digests, offsets = [], [], [], [], [], [0]
            for doc_id, h, text in zip(b.column("doc_id").to_pylist(), b.column("text_hash").to_pylist(), b.column("text").to_pylist(), strict=True):
                for spans, digest in lines(text or "", min_words):
                    ids.append(doc_id)
                    hashes.append(h)
                    for start, stop in spans:
                        starts.append(start)
                        stops.append(stop)
                    offsets.append(len(starts))
                    digests.append(digest)
            flat = pa.StructArray.from_arrays([pa.array(starts, pa.int64()), pa.array(stops, pa.int64())], fields=list(span))
            spans = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat, type=pa.list_(span))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hashes, pa.int64()), spans, pa.array(digests, pa.binary())], schema=schema)

    text = F.col("text").cast("string")
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"), text.alias("text"))
    return narrow.mapInArrow(in_worker("unit_dedup", run), "doc_id bigint, text_hash bigint, spans array<struct<start: bigint, stop: bigint>>, digest binary")


def repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Every occurrence to remove: doc_id, text_hash, spans, and kept_doc_id,
    kept_start (the occurrence that stays). A unit may be in two: its line's and its own."""
    found = written(occurrences(docs, min_words), "unit-occurrences")
    place = F.struct("doc_id", "text_hash", F.col("spans")[0]["start"].alias("start"))
    # A unit of equal rows is at one place: it counts once.
    first = (found.groupBy("digest").agg(F.min(place).alias("first"), F.max(place).alias("last"))
             .filter(F.col("first") != F.col("last")).select(F.col("digest").alias("_digest"), "first"))
    later = found.join(first, F.col("digest") == F.col("_digest")).filter(place != F.col("first"))
    return later.select("doc_id", "text_hash", "spans", F.col("first.doc_id").alias("kept_doc_id"), F.col("first.start").alias("kept_start"))


def by_document(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document that loses text: doc_id, text_hash, n_removed,
    removed_chars, kept_doc_ids (where its units stay), spans (start, stop)."""
    spans = F.array_sort(F.array_distinct(F.flatten(F.collect_set("spans"))))
    out = repeats(docs, min_words).groupBy("doc_id", "text_hash").agg(spans.alias("spans"), F.array_sort(F.collect_set("kept_doc_id")).alias("kept_doc_ids"))
    chars = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"])
    return out.select("doc_id", "text_hash", F.size("spans").cast("bigint").alias("n_removed"), chars.alias("removed_chars"), "kept_doc_ids", "spans")


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """All documents, their texts without the removed units."""
    gone = by_document(docs, min_words).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "spans")
    text = F.col("row.text").cast("string")
    rows = packed(docs, doc_id=F.col("doc_id").cast("bigint"), text_hash=F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    rows = rows.join(gone, same([F.col("doc_id"), F.col("text_hash")], [F.col("_id"), F.col("_hash")]), "left")
    state = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("parts"))
    kept = F.aggregate("spans", state, lambda s, x: F.struct(
        x["stop"].alias("at"), F.concat(s["parts"], F.array(F.substring(text, (s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int")))).alias("parts")),
        lambda s: F.concat(F.array_join(s["parts"], ""), F.substring(text, (s["at"] + 1).cast("int"), F.length(text))))
    new = F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(kept)
    return rows.select(*((new if c == "text" else F.col("row").getField(c)).alias(c) for c in docs.columns))


def op4_unit_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document that loses repeated units."""
    out = by_document(table(spark, sf_dir, "documents"))
    told = F.array_join(F.transform("spans", lambda s: F.concat(s["start"].cast("string"), F.lit(":"), s["stop"].cast("string"))), ",")
    return out.select("doc_id", "n_removed", "removed_chars", "kept_doc_ids", told.alias("spans"))
