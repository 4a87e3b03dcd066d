import zlib

import numpy as np
import public_tokenizers
from helpers import clashing, documents, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from protoclass.llm import simple8b
from protoclass.llm.queries import QUERIES
from protoclass.llm.token_files import Encoder, _ids, read_token_files, token_ids, write_token_files

SF = "/root/testdata/sf0.001"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=3000))
def test_round_trip(values):
    ids = np.array(values, np.uint64)
    cut = len(ids) // 3
    got, lengths = simple8b.from_bytes(simple8b.to_bytes(ids, np.array([cut, len(ids) - cut])))
    assert got.tolist() == values and lengths.tolist() == [cut, len(ids) - cut]


def test_blocks_decode_alone_and_small_ids_pack_tightly():
    ids = np.ones(5000, np.uint64)
    words, firsts, escaped = simple8b.pack(ids)
    assert len(firsts) == 6 and not len(escaped) and len(words) == 4 * 18 + 16
    one = words[firsts[2] : firsts[3]]
    part = simple8b.unpack(one, np.array([0, len(one)], np.uint32), escaped, 1024)
    assert (part == 1).all()


def test_encoder_equals_whole_text():
    path = public_tokenizers.path("byte_bpe_50k.json")
    enc = Encoder(path)
    texts = ["", " ", "a\t b", "  x \n\n  y  ", "don't 's\xa0z they're", "a\r\n b", "é<|endoftext|>x 123 !!", "foo, bar. 'x' (y)...", "½ ¼x µ ßü",
             "a\nb\nC. d,", "tail ", "\nhead", "x\n \ny", "　wide 漢字 ", "word*** %%% a.b", "A'S it's' '"]
    for t in texts:
        assert enc.encode(t).tobytes() == _ids(enc.tokenizer, t), t


def test_files_against_brute_force(spark, workdir):
    long = prose(5, 60_000)
    rows = [(7, "one two"), (3, None), (3, ""), (None, "null id"), (9, long), (7, "one two"), (7, "other"), (-1, "neg\n\n  ative")]
    docs = clashing(documents(spark, rows), "ids", "shard", "payload", "_base")
    write_token_files(docs, f"{workdir}/t", public_tokenizers.path("byte_bpe_50k.json"))
    got = [r for r in read_token_files(spark, f"{workdir}/t").orderBy("start").collect()]
    tokenizer = Encoder(public_tokenizers.path("byte_bpe_50k.json")).tokenizer
    start = 0
    assert [r.doc_id for r in got] == [None, -1, 3, 3, 7, 7, 7, 9]
    want = {None: ["null id"], -1: ["neg\n\n  ative"], 3: ["", ""], 7: ["one two", "one two", "other"], 9: [long]}
    for doc_id, texts in want.items():
        mine = [r for r in got if r.doc_id == doc_id]
        ids = sorted(tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in texts)
        assert sorted(r.ids for r in mine) == ids
    for r in got:
        assert (r.start, r.n_tokens) == (start, len(r.ids))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        start += r.n_tokens


def test_empty_table(spark):
    assert token_ids(documents(spark, [])).count() == 0


def test_query_on_whole_table(spark):
    rows = {r.doc_id: r for r in QUERIES["op1_token_ids"](spark, SF).collect()}
    tokenizer = Encoder(public_tokenizers.path("byte_bpe_50k.json")).tokenizer
    start = 0
    for d in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect():
        ids = tokenizer.encode(d.text, add_special_tokens=False).ids + [2]
        r = rows[d.doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(rows) == 200


def test_words_are_those_of_a_plain_greedy_reading():
    """Every word takes the narrowest width whose ids all fit (zeros stand behind a block's end)."""
    rng = np.random.default_rng(5)
    ids = np.minimum(rng.integers(0, 1 << 16, 3000), 1 << rng.integers(0, 16, 3000)).astype(np.uint64)
    ids[500:900] = 1
    words, firsts, escaped = simple8b.pack(ids)
    want = []
    for a in range(0, len(ids), simple8b.BLOCK_IDS):
        block, at = [*map(int, ids[a : a + simple8b.BLOCK_IDS])], 0
        while at < len(block):
            for s, width in enumerate(simple8b.WIDTHS, 1):
                part = block[at : at + 60 // width]
                if max(part) < 1 << width:
                    break
            want.append(s << 60 | sum(v << j * width for j, v in enumerate(part)))
            at += 60 // width
    assert words.tolist() == want and not len(escaped) and firsts[-1] == len(want)
