"""Simple-8b coding of id streams: vectorised packing and unpacking.

A stream is cut into blocks of ``BLOCK_IDS`` ids. A block is a run of 64-bit
words; the top four bits of a word select how many ids it holds and in how
many bits each, the first id in the lowest bits. Selector 0 is the escape: the
word's lower 60 bits are an index into the stream's list of raw 64-bit values,
for an id of more than 60 bits. The last word of a block may hold fewer ids
than its selector allows. The index of every block's first word is stored, so
blocks decode independently and all words of one selector decode together.
"""

from __future__ import annotations

import numpy as np

BLOCK_IDS = 1024

# Bits per id for selectors 1 to 14; a word holds 60 // bits ids.
WIDTHS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)

_ONE = np.uint64(1)
_POWERS = _ONE << np.arange(64, dtype=np.uint64)
#: Bits of every small id.
_BITS = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.uint8)
MAGIC = b"S8B1"
_HEAD = np.dtype("<u8")


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, first word of every block and the end, escaped values)."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(1, np.uint32), np.zeros(0, np.uint64)
    # A row per block, with zeros behind it: a word that ends there holds them, too.
    blocks = -(-n // BLOCK_IDS)
    row = BLOCK_IDS + 60
    flat = np.zeros((blocks, row), np.uint64)
    flat[:-1, :BLOCK_IDS] = ids[: (blocks - 1) * BLOCK_IDS].reshape(-1, BLOCK_IDS)
    flat[-1, : n - (blocks - 1) * BLOCK_IDS] = ids[(blocks - 1) * BLOCK_IDS :]
    flat = flat.ravel()
    top = int(ids.max())
    if top < len(_BITS):
        bits = _BITS[flat]
    elif top < 1 << 53:
        bits = np.frexp(flat.astype(np.float64))[1].astype(np.uint8)
    else:
        bits = np.searchsorted(_POWERS, flat, "right").astype(np.uint8)
    # From wide to narrow: the narrowest selector whose ids all fit stays.
    selector = np.zeros(len(flat), np.uint8)
    places = len(flat) - 60
    for s in range(len(WIDTHS), 0, -1):
        width = WIDTHS[s - 1]
        if width >= top.bit_length():
            selector[:] = s
            continue
        narrow = bits <= width
        # runs of twice the length by one step each, the last two may overlap
        fits, run, count = narrow, 1, 60 // width
        while run < count:
            step = min(run, count - run)
            fits = fits[: len(fits) - step] & fits[step:]
            run += step
        fits = fits[:places]
        if not fits.any():
            break
        np.copyto(selector[:places], s, where=fits)
    take = np.array([1, *(60 // w for w in WIDTHS)], np.int64)[selector]
    # Walk all blocks in step from word to word.
    at = np.arange(blocks) * row
    ends = at + np.minimum(BLOCK_IDS, n - np.arange(blocks) * BLOCK_IDS)
    steps = []
    while len(at):
        steps.append(at)
        at = at + take[at]
        live = at < ends
        if not live.all():
            at, ends = at[live], ends[live]
    begins = np.zeros(len(flat), bool)
    begins[np.concatenate(steps)] = True
    start = np.flatnonzero(begins)
    chosen = selector[start]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s in np.flatnonzero(np.bincount(chosen)):
        at_s = np.flatnonzero(chosen == s)
        if s == 0:
            words[at_s] = np.arange(len(at_s), dtype=np.uint64)
            continue
        width, first = WIDTHS[s - 1], start[at_s]
        value = flat[first]
        for j in range(1, 60 // width):
            value |= flat[first + j] << np.uint64(j * width)
        words[at_s] |= value
    firsts = np.searchsorted(start, np.arange(blocks + 1) * row).astype(np.uint32)
    return words, firsts, flat[start[chosen == 0]]


def unpack(words: np.ndarray, firsts: np.ndarray, escaped: np.ndarray, n: int) -> np.ndarray:
    """The ids of a packed stream of ``n`` ids."""
    if not n:
        return np.zeros(0, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.uint8)
    before = np.append(0, np.cumsum(np.array([1, *(60 // w for w in WIDTHS)], np.int64)[selector]))
    # A row per block with room behind it for what a last word holds too many.
    row = BLOCK_IDS + 60
    first = firsts.astype(np.int64)
    blocks = len(first) - 1
    start = before[:-1] + np.repeat(np.arange(blocks) * row - before[first[:-1]], np.diff(first))
    out = np.empty(blocks * row, np.uint64)
    for s in np.flatnonzero(np.bincount(selector)):
        at_s = np.flatnonzero(selector == s)
        word, place = words[at_s], start[at_s]
        if s == 0:
            out[place] = escaped[(word & np.uint64((1 << 60) - 1)).astype(np.int64)]
            continue
        width = WIDTHS[s - 1]
        mask = np.uint64((1 << width) - 1)
        for j in range(60 // width):
            out[place + j] = (word >> np.uint64(j * width)) & mask
    return out.reshape(blocks, row)[:, :BLOCK_IDS].reshape(-1)[:n]


def to_bytes(ids: np.ndarray, doc_lengths: np.ndarray) -> bytes:
    """One segment: magic, the five counts, document lengths, block offsets,
    words, escaped values; all little-endian."""
    words, firsts, escaped = pack(ids)
    head = np.array([len(ids), len(doc_lengths), len(firsts), len(words), len(escaped)], _HEAD)
    return b"".join((MAGIC, head.tobytes(), np.asarray(doc_lengths, "<u8").tobytes(), firsts.astype("<u4").tobytes(),
                     words.astype("<u8").tobytes(), escaped.astype("<u8").tobytes()))


def from_bytes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(ids, document lengths) of a segment."""
    if data[:4] != MAGIC:
        raise ValueError("not a Simple-8b segment")
    n, docs, blocks, n_words, n_escaped = (int(x) for x in np.frombuffer(data, _HEAD, 5, 4))
    at = 4 + 40
    lengths = np.frombuffer(data, "<u8", docs, at)
    at += 8 * docs
    firsts = np.frombuffer(data, "<u4", blocks, at)
    at += 4 * blocks
    words = np.frombuffer(data, "<u8", n_words, at)
    escaped = np.frombuffer(data, "<u8", n_escaped, at + 8 * n_words)
    return unpack(words, firsts, escaped, n), lengths.astype(np.int64)
