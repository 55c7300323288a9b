"""Token files in word-aligned Simple-8b coding.

A 64-bit word holds a selector in its top 4 bits and, in the other 60, as many
ids as fit at the selector's width. An id of 2^60 or more is an escape: selector
15, then the id in a word of its own. Ids are packed in blocks of BLOCK, and
each block starts a new word, whose place is in the block's offset: all blocks
of a file are packed and unpacked side by side, a word of each at a time.

File (little-endian): MAGIC, then int64 n_rows, n_ids, n_words, start (ids of
the partition before this file); then the rows' lengths (int64), the block
offsets in words (int64, one more than blocks), the words (uint64).
"""

from __future__ import annotations

import numpy as np

MAGIC = b"S8BTOK01"
BLOCK = 256
#: Fixed values of the coding: ids per word and bits per id, by selector from 0.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
WIDTHS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
ESCAPE = 15


def _bits(ids: np.ndarray) -> np.ndarray:
    """Bits that each id needs, 1 at least."""
    out = np.ones(len(ids), np.uint8)
    for width in range(1, 64):
        over = ids >= np.uint64(1 << width)
        if not over.any():
            break
        out += over
    return out


def _selectors(bits: np.ndarray) -> np.ndarray:
    """For each place of the blocks (rows of ``bits``, 0 beyond a block's end)
    the densest selector whose ids all fit from there on."""
    n = bits.shape[1]
    best = np.full(bits.shape, ESCAPE, np.uint8)
    wide = bits.copy()  # the most bits of the next ``reach`` ids
    reach = 1
    for selector in range(len(COUNTS) - 1, -1, -1):
        count = int(COUNTS[selector])
        while reach < count:
            step = min(reach, count - reach)
            grown = wide.copy()
            np.maximum(wide[:, : n - step], wide[:, step:], out=grown[:, : n - step])
            wide, reach = grown, reach + step
        best[wide <= WIDTHS[selector]] = selector
    return best


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words and the block offsets of ``ids`` (uint64)."""
    ids = np.ascontiguousarray(ids, np.uint64)
    blocks = -(-len(ids) // BLOCK)
    if not blocks:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    values = np.zeros((blocks, BLOCK + 60), np.uint64)
    full = np.zeros(blocks * BLOCK, np.uint64)
    full[: len(ids)] = ids
    values[:, :BLOCK] = full.reshape(blocks, BLOCK)
    used = np.full(blocks, BLOCK, np.int64)
    used[-1] = len(ids) - BLOCK * (blocks - 1)
    need = np.zeros((blocks, BLOCK), np.uint8)
    need.reshape(-1)[: len(ids)] = _bits(ids)
    choice = _selectors(need)
    rows = np.arange(blocks)
    at = np.zeros(blocks, np.int64)
    parts = []  # (block, step within the block, word)
    written = np.zeros(blocks, np.int64)
    while len(rows):
        selector = choice[rows, at]
        words = np.zeros(len(rows), np.uint64)
        escaped = selector == ESCAPE
        for s in np.unique(selector[~escaped]):
            mine = np.flatnonzero(selector == s)
            count, width = int(COUNTS[s]), int(WIDTHS[s])
            word = np.full(len(mine), int(s) << 60, np.uint64)
            for k in range(count):
                word |= values[rows[mine], at[mine] + k] << np.uint64(k * width)
            words[mine] = word
        words[escaped] = np.uint64(ESCAPE << 60)
        parts.append((rows, written[rows], words))
        written[rows] += 1
        if escaped.any():
            big = rows[escaped]
            parts.append((big, written[big], values[big, at[escaped]]))
            written[big] += 1
        at = at + np.where(escaped, 1, COUNTS[np.minimum(selector, 13)])
        left = at < used[rows]
        rows, at = rows[left], at[left]
    offsets = np.concatenate([[0], np.cumsum(written)])
    out = np.zeros(offsets[-1], np.uint64)
    for block, step, word in parts:
        out[offsets[block] + step] = word
    return out, offsets


def unpack(words: np.ndarray, offsets: np.ndarray, n_ids: int) -> np.ndarray:
    """The ids of ``pack``, all blocks a word at a time."""
    blocks = len(offsets) - 1
    out = np.zeros((blocks, BLOCK + 60), np.uint64)
    rows = np.arange(blocks)
    place, at = offsets[:-1].copy(), np.zeros(blocks, np.int64)
    while len(rows):
        word = words[place]
        selector = (word >> np.uint64(60)).astype(np.int64)
        escaped = selector == ESCAPE
        for s in np.unique(selector[~escaped]):
            mine = np.flatnonzero(selector == s)
            width = int(WIDTHS[s])
            mask = np.uint64((1 << width) - 1)
            for k in range(int(COUNTS[s])):
                out[rows[mine], at[mine] + k] = (word[mine] >> np.uint64(k * width)) & mask
        if escaped.any():
            out[rows[escaped], at[escaped]] = words[place[escaped] + 1]
        at = at + np.where(escaped, 1, COUNTS[np.minimum(selector, 13)])
        place = place + 1 + escaped
        left = place < offsets[rows + 1]
        rows, place, at = rows[left], place[left], at[left]
    return out[:, :BLOCK].reshape(-1)[:n_ids]


def dump(ids: np.ndarray, lengths: np.ndarray, start: int) -> bytes:
    words, offsets = pack(ids)
    head = np.array([len(lengths), len(ids), len(words), start], "<i8")
    return b"".join([MAGIC, head.tobytes(), lengths.astype("<i8").tobytes(), offsets.astype("<i8").tobytes(),
                     words.astype("<u8").tobytes()])


def load(data: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """ids, lengths of the rows, start."""
    if data[:8] != MAGIC:
        raise ValueError("not a token file")
    n_rows, n_ids, n_words, start = np.frombuffer(data, "<i8", 4, 8).tolist()
    lengths = np.frombuffer(data, "<i8", n_rows, 40)
    blocks = -(-n_ids // BLOCK)
    offsets = np.frombuffer(data, "<i8", blocks + 1, 40 + 8 * n_rows)
    words = np.frombuffer(data, "<u8", n_words, 40 + 8 * (n_rows + blocks + 1))
    return unpack(words, offsets.astype(np.int64), n_ids), lengths, start
