"""Operator 7: secret scans by token efficiency.

Base spans come from three fixed patterns. The method adds spans of kind
``efficiency``: runs of credential letters that a tiktoken vocabulary needs
many tokens for (few characters a token), as random strings do and words do
not, with or without digits. Left out are runs without a letter (plain numbers),
digests of usual lengths in hexadecimal, UUIDs, identifiers made of words of
under ``MIN_RUN`` letters joined by marks, names of mail and web hosts, and runs
inside a base span.

Defined results: null and empty texts have no span (the digest is that of the
empty string); overlapping base spans of different kinds all stay; repeated
rows each get a row; an empty table gives no rows; only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from protoclass.llm.common import table

#: Characters per token below which a run counts as random.
MAX_CHARS_PER_TOKEN = 2.2
MIN_RUN = 16

# The base patterns, and the least lengths of what they capture.
ASSIGN_KEYS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run of hex letters is taken whole, so short runs never shift a long one
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
KINDS = ("assign", "access", "hex", "efficiency")

_RUN = re.compile(r"[A-Za-z0-9+/_=.-]{%d,}" % MIN_RUN)
_LETTER = re.compile(r"[A-Za-z]")
_DIGEST = re.compile(r"(?:[0-9a-f]{16}|[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128}"
                     r"|[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})", re.I)
#: Words of letters, too short for a run of their own, or numbers, joined by marks: dotted names, paths, slugs.
_IDENTIFIER = re.compile(r"[._/=+-]*(?:(?:WORD|[0-9]{1,8})[._/=+-]+)*(?:(?:WORD)[0-9]{0,4}|[0-9]{1,8})[._/=+-]*".replace("WORD", r"[A-Z]?[a-z]{1,%d}|[A-Z]{1,%d}" % (MIN_RUN - 2, MIN_RUN - 1)))

Span = tuple[str, int, int]


class Vocabulary:
    """Token counts under a tiktoken rank file."""

    def __init__(self, ranks: str, pattern: str = public_tokenizers.PATTERN):
        import tiktoken

        with open(ranks, "rb") as f:  # a file of the installed library, on every machine
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=merges, special_tokens={})

    def chars_per_token(self, run: str) -> float:
        return len(run) / len(self.encoding.encode_ordinary(run))


_VOCABULARIES: dict[str, Vocabulary] = {}


def vocabulary(ranks: str) -> Vocabulary:
    if ranks not in _VOCABULARIES:
        _VOCABULARIES[ranks] = Vocabulary(ranks)
    return _VOCABULARIES[ranks]


def base_spans(text: str) -> list[Span]:
    """All base spans, by start and then kind as listed."""
    lower = text.lower()
    spans: list[Span] = []
    if any(k in lower for k in ASSIGN_KEYS):
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def added_spans(text: str, base: list[Span], words: Vocabulary, most: float = MAX_CHARS_PER_TOKEN) -> list[Span]:
    """The spans that the token-efficiency test adds."""
    out = []
    for m in _RUN.finditer(text):
        run = m[0]
        core = run.strip("._=-+/")
        if (len(core) < MIN_RUN or not _LETTER.search(core) or _DIGEST.fullmatch(core) or _IDENTIFIER.fullmatch(core)
                or any(a <= m.start() and m.end() <= z for _, a, z in base)):
            continue
        if words.chars_per_token(core) < most:
            out.append(("efficiency", *m.span()))
    return out


def _told(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{z}" for k, a, z in spans)


def secret_scan(docs: DataFrame, ranks: str | None = None, most: float = MAX_CHARS_PER_TOKEN) -> DataFrame:
    """One row per document: doc_id, counts of the base kinds, n_efficiency,
    base_sha256, spans (kind:start:end in code points, end exclusive), and
    ``found``: the spans with their texts."""
    ranks = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(ranks)
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                text = text or ""
                base = base_spans(text)
                spans = sorted(base + added_spans(text, base, words, most), key=lambda s: (s[1], KINDS.index(s[0])))
                n = {k: sum(s[0] == k for s in spans) for k in KINDS}
                rows.append({"doc_id": doc_id, **{f"n_{k}": n[k] for k in KINDS},
                             "base_sha256": hashlib.sha256(_told(base).encode()).hexdigest(), "spans": _told(spans),
                             "found": [{"kind": k, "start": a, "end": z, "text": text[a:z]} for k, a, z in spans]})
            yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_efficiency bigint, base_sha256 string, "
                                  "spans string, found array<struct<kind: string, start: bigint, end: bigint, text: string>>")


_SCHEMA = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string()),
                     ("found", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("text", pa.string())])))])


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents")).drop("found")
