"""Simple-8b coding of id streams: 64-bit words, a 4-bit selector and 60 payload bits.

A selector says how many values of which width a word holds, so the count per
word varies with the values. Streams are cut into blocks of ``BLOCK`` values;
the chunk header keeps the first word of every block, so all blocks are coded
and decoded side by side with numpy. Values of 2^60 and more do not fit: their
word has the escape selector and an index into the chunk's escape table.

Chunk layout, little-endian: ``<4sIQII`` magic, block size, number of values,
number of blocks, number of escapes; uint32 first word of each block and the
word total; uint64 words; uint64 escapes.
"""

from __future__ import annotations

import struct

import numpy as np

# The selector table of Simple-8b (values per word, bits per value).
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], dtype=np.int64)
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], dtype=np.int64)
# Selector 1 (120 zeros) is the one given up for escapes: one value, its place in the escape table.
ESCAPE = 1
BLOCK = 1024
_PAD = int(COUNTS[0])
_HEAD = struct.Struct("<4sIQII")
_MAGIC = b"S8B1"


_WIDTH16 = np.array([k.bit_length() for k in range(1 << 16)], dtype=np.uint8)


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits of every value."""
    top = int(values.max(initial=0)).bit_length()
    if top <= 16:
        return _WIDTH16[values.astype(np.uint16, copy=False)]
    out = np.zeros(values.shape, dtype=np.uint8)
    for b in range(top):
        out += values >= np.uint64(1 << b)
    return out


def _selectors(w: np.ndarray) -> np.ndarray:
    """For each place the selector that takes the most values, by the widths ``w`` (padded rows).

    Windows grow from 2 values on; a longer window of fewer bits fits only where
    all shorter ones fit, so the first length that fits nowhere ends the search.
    """
    cols = w.shape[1]

    def ahead(a: np.ndarray, k: int) -> np.ndarray:
        out = np.empty_like(a)
        out[:, :cols - k] = a[:, k:]
        out[:, cols - k:] = 0
        return out

    sel = np.full(w.shape, len(COUNTS) - 1, dtype=np.uint8)
    widest = {1: w}  # largest width among the next c values
    for s in range(len(COUNTS) - 2, -1, -1):
        c, half = int(COUNTS[s]), max(widest)
        if 2 * half < c:
            widest[2 * half] = np.maximum(widest[half], ahead(widest[half], half))
            half *= 2
        widest[c] = np.maximum(widest[half], ahead(widest[half], c - half))
        fits = widest[c] <= BITS[s]
        if not fits[:, :BLOCK].any():
            break
        if s != ESCAPE:
            np.copyto(sel, np.uint8(s), where=fits)
    return sel


def encode(values: np.ndarray) -> bytes:
    """One chunk of unsigned values (any integer dtype up to uint64)."""
    v = np.ascontiguousarray(values, dtype=np.uint64)
    n = len(v)
    lanes = -(-n // BLOCK)
    small = int(v.max(initial=0)) < 1 << 16
    grid = np.zeros((lanes, BLOCK + _PAD), dtype=np.uint16 if small else np.uint64)
    full = n // BLOCK
    grid[:full, :BLOCK] = v[:full * BLOCK].reshape(full, BLOCK)
    if full < lanes:
        grid[full, :n - full * BLOCK] = v[full * BLOCK:]
    width = _widths(grid)
    sel = _selectors(width)
    if not small:
        sel[width > 60] = ESCAPE
    step = COUNTS.copy()
    step[ESCAPE] = 1
    ends = np.full(lanes, BLOCK)
    if lanes:
        ends[-1] = n - (lanes - 1) * BLOCK
    pos, live = np.zeros(lanes, dtype=np.int64), np.arange(lanes)
    visited = np.zeros(grid.shape, dtype=bool)
    while len(live):
        visited[live, pos[live]] = True
        pos[live] += step[sel[live, pos[live]]]
        live = live[pos[live] < ends[live]]
    where = np.flatnonzero(visited)
    lane, s = where // visited.shape[1], sel.reshape(-1)[where]
    flat = grid.reshape(-1)
    words = s.astype(np.uint64) << np.uint64(60)
    for k in np.flatnonzero(np.bincount(s, minlength=len(COUNTS))):
        rows = np.flatnonzero(s == k)
        c, b = int(COUNTS[k]), int(BITS[k])
        if k == ESCAPE:
            words[rows] |= np.arange(len(rows), dtype=np.uint64)
        elif b:
            part = flat[where[rows, None] + np.arange(c)].astype(np.uint64)
            words[rows] |= np.bitwise_or.reduce(part << (np.arange(c, dtype=np.uint64) * np.uint64(b)), axis=1)
    escapes = flat[where[s == ESCAPE]]
    first = np.searchsorted(lane, np.arange(lanes + 1)).astype("<u4")
    return b"".join((_HEAD.pack(_MAGIC, BLOCK, n, lanes, len(escapes)), first.tobytes(),
                     words.astype("<u8").tobytes(), escapes.astype("<u8").tobytes()))


def decode(data: bytes) -> np.ndarray:
    """The values of one chunk, as uint64."""
    magic, block, n, lanes, n_esc = _HEAD.unpack_from(data)
    if magic != _MAGIC:
        raise ValueError("not a Simple-8b chunk")
    first = np.frombuffer(data, "<u4", lanes + 1, _HEAD.size).astype(np.int64)
    at = _HEAD.size + first.nbytes // 2
    words = np.frombuffer(data, "<u8", int(first[-1]), at)
    escapes = np.frombuffer(data, "<u8", n_esc, at + words.nbytes)
    s = (words >> np.uint64(60)).astype(np.int64)
    step = COUNTS.copy()
    step[ESCAPE] = 1
    total = np.concatenate(([0], np.cumsum(step[s])))
    lane = np.repeat(np.arange(lanes), np.diff(first))
    start = lane * (block + _PAD) + total[:-1] - total[first[:-1]][lane]
    out = np.zeros(lanes * (block + _PAD), dtype=np.uint64)
    for k in np.flatnonzero(np.bincount(s, minlength=len(COUNTS))):
        rows = np.flatnonzero(s == k)
        c, b = int(COUNTS[k]), int(BITS[k])
        if k == ESCAPE:
            out[start[rows]] = escapes[(words[rows] & np.uint64((1 << 60) - 1)).astype(np.int64)]
        elif b:
            shifts = np.arange(c, dtype=np.uint64) * np.uint64(b)
            out[start[rows, None] + np.arange(c)] = (words[rows, None] >> shifts) & np.uint64((1 << b) - 1)
    return out.reshape(lanes, block + _PAD)[:, :block].reshape(-1)[:n]
