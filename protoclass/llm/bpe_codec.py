"""Operator 12: BPE encoding by a queue of merge ranks, and decoding.

A text is cut at special tokens, normalised (NFC, lower case) and split into
words as the tokenizer file says; a word's UTF-8 bytes, written as letters, are
the symbols of a doubly linked list. A priority queue holds the rank and place
of every neighbouring pair that can merge; the lowest rank merges first, the
leftmost of equal ones. An entry whose symbols have changed since it was queued
is stale and is skipped. That takes n log n steps for a word of n bytes, so
one very long word costs what its length does. Words, and runs without white
space, that come again are looked up in bounded caches. Decoding puts the vocabulary's strings together.

Texts are worked on where they lie: nothing is shuffled, and a task holds one
Arrow batch of texts.

Defined results: null and empty texts, and texts of white space alone, have no
ids and decode to the empty text; repeated rows are documents; a null id stays
null; an empty table gives no rows; columns other than ``doc_id`` and ``text``
are not read. Texts are encoded whole, whatever their length.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from protoclass.llm.common import CACHES, in_worker, table

CACHE_WORDS = 150_000
CACHE_WORD_CHARS = 64
#: Texts taken out of an Arrow batch at a time.
ROWS_AT_ONCE = 256

_SEPARATORS = re.compile("[\x1c-\x1f]")


def byte_letters() -> list[str]:
    """The letter for each byte in byte-level vocabularies: itself where Latin-1
    prints it, else the next unused letter from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def merge(symbols: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """The symbols after all merges; ``ranks`` maps a pair to (rank, merged symbol)."""
    n = len(symbols)
    symbols = list(symbols)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    after[-1:] = [-1]
    queue = []
    for i in range(n - 1):
        found = ranks.get((symbols[i], symbols[i + 1]))
        if found:
            queue.append((found[0], i, symbols[i], symbols[i + 1], found[1]))
    heapq.heapify(queue)
    while queue:
        _, i, left, right, merged = heapq.heappop(queue)
        j = after[i]
        if symbols[i] != left or j < 0 or symbols[j] != right:  # stale
            continue
        symbols[i], symbols[j] = merged, -1
        after[i] = k = after[j]
        if k >= 0:
            before[k] = i
            found = ranks.get((merged, symbols[k]))
            if found:
                heapq.heappush(queue, (found[0], i, merged, symbols[k], found[1]))
        h = before[i]
        if h >= 0:
            found = ranks.get((symbols[h], merged))
            if found:
                heapq.heappush(queue, (found[0], h, symbols[h], merged, found[1]))
    return [s for s in symbols if s >= 0]


class _Recent(dict):
    """Bounded cache of what ``make`` gives for a text. When the young half is
    full it becomes the old one, from which texts that are met again come back."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, text: str) -> bytes:
        value = self.old.get(text)
        if value is None:
            value = self.make(text)
        if len(text) <= CACHE_WORD_CHARS:
            if len(self) >= CACHE_WORDS:
                self.old = dict(self)
                self.clear()
            self[text] = value
        return value


class Codec:
    """Encoder and decoder of a byte-level BPE vocabulary with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        kinds = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        split, letters = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}, {}])[:2]
        special = spec["added_tokens"]
        if (model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or split.get("type") != "Split" or not split.get("invert")
                or letters.get("type") != "ByteLevel" or letters.get("use_regex") or letters.get("add_prefix_space") or spec["decoder"] or spec["post_processor"]
                or model.get("dropout") or model.get("continuing_subword_prefix") or model.get("byte_fallback") or model.get("ignore_merges")
                or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in special)):
            raise ValueError(f"{path} is not a vocabulary of the kind that this codec reads")
        # What the white space between words becomes makes no difference: the split drops it.
        # White space is Unicode's property of that name, as in the file's own engine.
        self.split = regex.compile(split["pattern"]["Regex"].replace("\\s", "\\p{White_Space}"))
        vocab: dict[str, int] = model["vocab"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.ranks = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        ends = model.get("end_of_word_suffix") or ""
        self.inner = [vocab[c] for c in byte_letters()]
        self.last = [vocab[c + ends] for c in byte_letters()]
        self.special = {t["content"]: t["id"] for t in special}
        # Of tokens that begin at the same place the longest counts.
        by_length = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, by_length)) + ")") if special else None
        self.strings = {i: s for s, i in vocab.items()} | {i: s for s, i in self.special.items()}
        # Words, and runs without white space, to their ids as bytes.
        self.words = _Recent(lambda word: array("i", merge(self.symbols(word), self.ranks)).tobytes())
        self.pieces = _Recent(lambda piece: b"".join(map(self.words.__getitem__, self.split.findall(piece))))

    def symbols(self, word: str) -> list[int]:
        data = word.encode("utf-8", "surrogatepass")
        out = [self.inner[b] for b in data]
        out[-1] = self.last[data[-1]]
        return out

    def _plain(self, text: str) -> bytes:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # every sigma alike, also at a word's end
        text = text.lower()
        # No word goes over white space. Python takes four control characters for it that Unicode does not.
        pieces = [text] if _SEPARATORS.search(text) else text.split()
        return b"".join(map(self.pieces.__getitem__, pieces))

    def encode(self, text: str) -> np.ndarray:
        if not any(s in text for s in self.special):
            return np.frombuffer(self._plain(text), np.int32)
        out = []
        for part in self.cut.split(text):
            out.append(array("i", [self.special[part]]).tobytes() if part in self.special else self._plain(part))
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The vocabulary's strings, a blank between any two (the file names no decoder)."""
        return " ".join(map(self.strings.__getitem__, ids.tolist()))


_CODECS: dict[str, Codec] = {}
CACHES["bpe_codec"] = _CODECS.clear


def codec(path: str) -> Codec:
    """The worker's codec; kept between tasks because loading takes time."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encoded(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, ids array<int> and decoded (the text that the ids stand for) of every document."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(tokenizer)
        for b in (b.slice(a, ROWS_AT_ONCE) for b in batches for a in range(0, b.num_rows, ROWS_AT_ONCE)):
            ids = [c.encode(t or "") for t in b.column("text").to_pylist()]
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            rows = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), rows, pa.array(map(c.decode, ids), pa.string())], schema=schema)

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(in_worker("bpe_codec", run), "doc_id bigint, ids array<int>, decoded string")


def op12_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return rows.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
