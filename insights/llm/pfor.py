"""Patched frame-of-reference coding of token ids.

Ids are cut into blocks of 256.  Of each block the minimum is subtracted, and the
differences are packed at the width that the chosen percentile of them needs; the
few that need more stand in the block's exception list (position and difference)
and are patched in on reading.  An index gives where each block starts, so any
block can be read without the ones before it.

Layout, little-endian: magic "PFR1", ids (uint64), blocks (uint32), block starts
(blocks + 1 times uint32, from the first block's first byte); then per block minimum
(uint32), width (uint8), exceptions (uint8), packed words (8 * width times uint32),
exception positions (uint8 each), exception differences (uint32 each).
The last block is filled up with its own last id.
"""

from __future__ import annotations

import struct

import numpy as np

BLOCK = 256
PERCENTILE = 0.95
_HEAD = struct.Struct("<4sQI")
_MAGIC = b"PFR1"
_BLOCK_HEAD = 6


def _widths(x: np.ndarray) -> np.ndarray:
    """Bits that each number needs."""
    return np.frexp(x.astype(np.float64))[1].astype(np.uint8)


def _pack(rows: np.ndarray, width: int) -> np.ndarray:
    """(n, 256) numbers below 2**width to (n, 8 * width) words of 32 bits."""
    out = np.zeros((rows.shape[0], 8, width), np.uint32)
    lanes = rows.reshape(-1, 8, 32)
    for j in range(32):
        word, bit = divmod(j * width, 32)
        out[:, :, word] |= lanes[:, :, j] << np.uint32(bit)
        if bit + width > 32:
            out[:, :, word + 1] |= lanes[:, :, j] >> np.uint32(32 - bit)
    return out.reshape(rows.shape[0], -1)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    lanes = words.reshape(words.shape[0], 8, width)
    out = np.empty((words.shape[0], 8, 32), np.uint32)
    mask = np.uint32((1 << width) - 1)
    for j in range(32):
        word, bit = divmod(j * width, 32)
        x = lanes[:, :, word] >> np.uint32(bit)
        if bit + width > 32:
            x = x | (lanes[:, :, word + 1] << np.uint32(32 - bit))
        out[:, :, j] = x & mask
    return out.reshape(words.shape[0], BLOCK)


def encode(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """``percentile``: over 0, so that a block has 255 exceptions at most."""
    ids = np.asarray(ids, dtype=np.uint32)
    n = len(ids)
    blocks = -(-n // BLOCK)
    if not n:
        return _HEAD.pack(_MAGIC, 0, 0) + np.zeros(1, "<u4").tobytes()
    rows = np.pad(ids, (0, blocks * BLOCK - n), mode="edge").reshape(blocks, BLOCK)
    low = rows.min(axis=1)
    rest = rows - low[:, None]
    at = max(1, min(BLOCK - 1, int(percentile * BLOCK)))
    width = _widths(np.partition(rest, at, axis=1)[:, at])
    over = rest >= (np.uint64(1) << width.astype(np.uint64))[:, None]
    extra = over.sum(axis=1)
    size = _BLOCK_HEAD + 32 * width.astype(np.int64) + 5 * extra
    starts = np.concatenate([[0], np.cumsum(size)])
    body = np.empty(starts[-1], np.uint8)
    at = starts[:-1]
    head = np.empty((blocks, _BLOCK_HEAD), np.uint8)
    head[:, :4] = low.astype("<u4")[:, None].view(np.uint8)
    head[:, 4], head[:, 5] = width, extra
    body[at[:, None] + np.arange(_BLOCK_HEAD)] = head
    for w in np.unique(width[width > 0]):
        of = np.flatnonzero(width == w)
        packed = _pack(np.where(over[of], np.uint32(0), rest[of]), int(w)).astype("<u4").view(np.uint8)
        body[(at[of] + _BLOCK_HEAD)[:, None] + np.arange(32 * int(w))] = packed
    row, position = np.nonzero(over)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(extra) - extra, extra)
    lists = at + _BLOCK_HEAD + 32 * width.astype(np.int64)
    body[lists[row] + nth] = position.astype(np.uint8)
    value = np.ascontiguousarray(rest[row, position].astype("<u4")).view(np.uint8).reshape(-1, 4)
    body[((lists + extra)[row] + 4 * nth)[:, None] + np.arange(4)] = value
    return _HEAD.pack(_MAGIC, n, blocks) + starts.astype("<u4").tobytes() + body.tobytes()


def decode(data: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of blocks ``first`` to ``last`` (end exclusive; all by default)."""
    magic, n, blocks = _HEAD.unpack_from(data)
    if magic != _MAGIC:
        raise ValueError("not a block file of token ids")
    last = blocks if last is None else min(last, blocks)
    starts = np.frombuffer(data, "<u4", blocks + 1, _HEAD.size).astype(np.int64) + _HEAD.size + 4 * (blocks + 1)
    if first >= last:
        return np.empty(0, np.uint32)
    raw = np.frombuffer(data, np.uint8)
    at = starts[first:last]
    head = raw[at[:, None] + np.arange(_BLOCK_HEAD)]
    low = np.ascontiguousarray(head[:, :4]).view("<u4")[:, 0].astype(np.uint32)
    width, extra = head[:, 4], head[:, 5].astype(np.int64)
    out = np.zeros((last - first, BLOCK), np.uint32)
    for w in np.unique(width):
        of = np.flatnonzero(width == w)
        if w:
            words = raw[(at[of] + _BLOCK_HEAD)[:, None] + np.arange(32 * int(w))].view("<u4")
            out[of] = _unpack(words, int(w))
    row = np.repeat(np.arange(last - first), extra)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(extra) - extra, extra)
    lists = at + _BLOCK_HEAD + 32 * width.astype(np.int64)
    position = raw[lists[row] + nth]
    value = raw[((lists + extra)[row] + 4 * nth)[:, None] + np.arange(4)]
    out[row, position] = np.ascontiguousarray(value).view("<u4")[:, 0] if len(row) else 0
    return (out + low[:, None]).reshape(-1)[: min(n, last * BLOCK) - first * BLOCK]
