"""Simple-8b: unsigned integers in 64-bit words, a selector in the top four bits and equal fields in the other sixty.

Layout of a coded array, little-endian: magic ``S8B1``, block size (u32), number of values (u64), number of blocks (u32), word
offset of each block and the end (u32 each), words (u64). A block starts at a word of its own, so blocks decode alone.
Selector 0 is an escape: the next word holds one value of more than 60 bits as it is. Selector 1 stands for 120 zeros.
Fields past the end of a block are zero and are ignored.
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"S8B1"
BLOCK = 512
ESCAPE, ZEROS = 0, 1
#: Fields per word and bits per field, by selector.
FIELDS = [(1, 64), (120, 0), *((60 // bits, bits) for bits in (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60))]
_HEAD = struct.Struct("<4sIQI")


def _choices(padded: np.ndarray, block: int) -> np.ndarray:
    """For each place of each block the selector that packs most values from there on.

    A selector fits where the widest of its next values fits its fields. The widest of the next n values follows from
    two overlapping shorter runs, so all selectors take one pass each over bytes.
    """
    # The exponent of a value as a float is its width; above 2**53 rounding can only make it one bit wider.
    exponent = (padded.astype(np.float64).view(np.int64) >> 52) - 1022
    widest = np.maximum(exponent, 0).astype(np.uint8)
    fits = np.zeros(padded.shape, np.uint8)
    run = 1
    for fields, bits in FIELDS[:0:-1]:
        while run < fields:
            step = min(run, fields - run)
            widest[:, : padded.shape[1] - step] = np.maximum(widest[:, : padded.shape[1] - step], widest[:, step:])
            run += step
        fits += widest <= bits
    # More and narrower fields fit only where fewer and wider ones do, so the number of selectors that fit names the best.
    fits = fits[:, :block]
    return np.where(fits == 0, np.uint8(ESCAPE), np.uint8(len(FIELDS)) - fits)


def encode(ids: np.ndarray, block: int = BLOCK) -> bytes:
    """All blocks are packed side by side: each step places one word of every block that is not yet finished."""
    ids = np.asarray(ids, np.uint64)
    blocks = -(-len(ids) // block)
    values = np.zeros(blocks * block, np.uint64)
    values[: len(ids)] = ids
    values = values.reshape(blocks, block)
    sizes = np.full(blocks, block)
    if blocks:
        sizes[-1] = len(ids) - (blocks - 1) * block
    counts = np.array([fields for fields, _ in FIELDS])
    padded = np.zeros((blocks, block + 120), np.uint64)
    padded[:, :block] = values
    chosen = _choices(padded, block)
    at, open_blocks = np.zeros(blocks, np.int64), np.arange(blocks)
    steps = []
    while len(open_blocks):
        here = at[open_blocks]
        selector = chosen[open_blocks, here]
        steps.append((open_blocks, here, selector))
        at[open_blocks] = here + counts[selector]
        open_blocks = open_blocks[at[open_blocks] < sizes[open_blocks]]
    if not steps:
        return _HEAD.pack(MAGIC, block, 0, 0) + np.zeros(1, "<u4").tobytes()
    where, start, selector = (np.concatenate(x) for x in zip(*steps, strict=True))
    order = np.argsort(where, kind="stable")  # steps of a block come in order
    where, start, selector = where[order], start[order], selector[order]
    length = np.where(selector == ESCAPE, 2, 1)
    place = np.cumsum(length) - length
    words = np.zeros(int(length.sum()), np.uint64)
    for k, (fields, bits) in enumerate(FIELDS):
        own = np.flatnonzero(selector == k)
        if k == ESCAPE:
            words[place[own] + 1] = padded[where[own], start[own]]
            continue
        word = np.full(len(own), np.uint64(k) << np.uint64(60))
        for j in range(fields if bits else 0):
            word |= padded[where[own], start[own] + j] << np.uint64(bits * j)
        words[place[own]] = word
    offsets = np.concatenate([np.searchsorted(where, np.arange(blocks)), [len(where)]])
    offsets = np.append(place, len(words))[offsets].astype("<u4")
    return _HEAD.pack(MAGIC, block, len(ids), blocks) + offsets.tobytes() + words.astype("<u8").tobytes()


def decode(coded: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """The values of the blocks ``first`` to before ``last`` (all by default)."""
    magic, block, total, blocks = _HEAD.unpack_from(coded)
    if magic != MAGIC:
        raise ValueError("not a Simple-8b array")
    last = blocks if last is None else min(last, blocks)
    if first >= last:
        return np.zeros(0, np.uint64)
    offsets = np.frombuffer(coded, "<u4", blocks + 1, _HEAD.size).astype(np.int64)
    base = _HEAD.size + 4 * (blocks + 1)
    words = np.frombuffer(coded, "<u8", offsets[last] - offsets[first], base + 8 * offsets[first])
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    for k in np.flatnonzero(selector == ESCAPE):  # a word behind an escape is no selector, whatever its top bits are
        if not raw[k]:
            raw[k + 1] = True
    counts = np.where(raw, 0, np.array([fields for fields, _ in FIELDS])[selector])
    owner = np.searchsorted(offsets[first : last + 1] - offsets[first], np.arange(len(words)), side="right") - 1
    start = np.cumsum(counts) - counts
    block_first = start[np.minimum(offsets[first:last] - offsets[first], max(len(words) - 1, 0))]
    start = start - block_first[owner]
    sizes = np.full(last - first, block)
    if last == blocks:
        sizes[-1] = total - (blocks - 1) * block
    out = np.zeros((last - first) * block, np.uint64)
    for k, (fields, bits) in enumerate(FIELDS):
        own = np.flatnonzero((selector == k) & ~raw)
        if k == ESCAPE:
            out[owner[own] * block + start[own]] = words[own + 1]
            continue
        if not bits or not len(own):
            continue
        mask = np.uint64((1 << bits) - 1)
        for j in range(fields):
            place = start[own] + j
            inside = place < block
            out[(owner[own] * block + place)[inside]] = ((words[own] >> np.uint64(bits * j)) & mask)[inside]
    return out[: int(sizes.sum())]
