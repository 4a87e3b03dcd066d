import hashlib
import random

import public_tokenizers
import pytest
from helpers import clashing, documents
from tokenizers import Tokenizer

from protoclass.llm.bpe_codec import Codec, encoded, merge
from protoclass.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def codec():
    return Codec(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def same(codec, library, texts):
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        ids = codec.encode(text)
        assert ids.tolist() == want.ids, text
        assert codec.decode(ids) == library.decode(want.ids, skip_special_tokens=False)


def plain_merge(symbols, ranks):
    """All pairs looked at again after every merge."""
    symbols = list(symbols)
    while True:
        found = [(ranks[p][0], i, ranks[p][1]) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
        if not found:
            return symbols
        _, i, merged = min(found)
        symbols[i : i + 2] = [merged]


def test_queue_against_plain_merging():
    rng = random.Random(5)
    for _ in range(300):
        pairs = [(a, b) for a in range(4) for b in range(4)]
        rng.shuffle(pairs)
        ranks = {p: (i, 10 + i) for i, p in enumerate(pairs[:8])}
        more = [(a, b) for a in range(10, 18) for b in [*range(4), *range(10, 18)]]
        rng.shuffle(more)
        ranks |= {p: (8 + i, 30 + i) for i, p in enumerate(more[:30])}
        symbols = [rng.randrange(4) for _ in range(rng.randrange(1, 40))]
        assert merge(symbols, ranks) == plain_merge(symbols, ranks)
    assert merge([1, 1, 1, 1, 1], {(1, 1): (0, 2), (2, 2): (1, 3)}) == [3, 1]


def test_against_the_library(codec, library):
    rng = random.Random(7)
    pool = [chr(c) for c in [*range(0x20, 0x250), *range(0x300, 0x400), *range(0x2000, 0x2070), 0x1F600, 0x4E2D, 0xAC00, 0x1100, 0x1161, 0x1C, 0x85, 0x180E, 0xFEFF]]
    texts = ["", " \n\t", "ΑΣ ΣΑΣ. ΟΔΟΣ", "İSTANBUL ẞ ǅ Å K ﬁ", "don't I'LL we'Ve '' 's 'S", "1234 ½ Ⅷ ٣", "a <|endoftext|>b<|startoftext|><|ENDOFTEXT|> <|endoftext", "👍🏽👩‍👩‍👧 é ̈́"]
    texts += ["".join(rng.choice(pool) for _ in range(rng.randrange(1, 40))) for _ in range(3000)]
    same(codec, library, texts)


def test_very_long_word_and_text(codec, library):
    same(codec, library, ["ab" * 100_000, "é" * 50_000, "word " * 200_000])


def test_rows(spark):
    rows = [(1, "Hello, World"), (2, None), (3, ""), (None, "x"), (1, "Hello, World")]
    docs = documents(spark, rows)
    got = encoded(clashing(docs, "ids", "decoded"), PATH).collect()
    assert sorted((str(r.doc_id), len(r.ids), r.decoded) for r in got) == [("1", 3, "hello</w> ,</w> world</w>"), ("1", 3, "hello</w> ,</w> world</w>"), ("2", 0, ""), ("3", 0, ""), ("None", 1, "x</w>")]
    assert encoded(documents(spark, []), PATH).count() == 0


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        Codec(public_tokenizers.path("byte_bpe_50k.json"))


def test_query_on_whole_table(spark, library):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for r, e in zip(rows, library.encode_batch([r.text or "" for r in rows], add_special_tokens=False), strict=True):
        want[r.doc_id] = (len(e.ids), sha(" ".join(map(str, e.ids))), sha(library.decode(e.ids, skip_special_tokens=False)))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op12_bpe_codec"](spark, SF).collect()}
    assert got == want
