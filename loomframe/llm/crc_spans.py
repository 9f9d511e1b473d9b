"""CRC-32 of many spans of one buffer: contributions by byte and distance from the end, joined by exclusive or."""

from __future__ import annotations

import numpy as np

#: Distances from a span's end that the position table covers; longer spans are folded by blocks of as many bytes.
BLOCK = 64
#: CRC-32's reflected polynomial.
POLY = 0xEDB88320


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """contribution[distance, byte]; start[n], the register of all ones after n zero bytes; ahead[4, byte], a register moved over BLOCK zero bytes."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(POLY), one >> 1).astype(np.uint32)
    step = lambda r: one[r & 0xFF] ^ (r >> np.uint32(8))
    rows = [one]
    for _ in range(BLOCK - 1):
        rows.append(step(rows[-1]))
    start = [np.array([0xFFFFFFFF], np.uint32)]
    for _ in range(BLOCK):
        start.append(step(start[-1]))
    ahead = []
    for k in range(4):
        r = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
        for _ in range(BLOCK):
            r = step(r)
        ahead.append(r)
    return np.concatenate(rows), np.concatenate(start), np.stack(ahead)


CONTRIBUTION, START, AHEAD = _tables()


def _xor(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """What the bytes of spans of up to BLOCK bytes, none empty, add to a register of zero."""
    at = np.cumsum(size) - size
    place = np.arange(int(at[-1] + size[-1]))
    byte = data.take(np.repeat(start - at, size) + place)
    near = np.repeat(at + size - 1, size) - place
    near <<= 8
    near += byte
    return np.bitwise_xor.reduceat(CONTRIBUTION.take(near), at)


def crc32(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 (as zlib's) of data[start : start + size] for each span; data is uint8 of under 2 GB, empty spans give 0."""
    out = np.zeros(len(start), np.uint32)
    short = np.flatnonzero((size > 0) & (size <= BLOCK))
    if len(short):
        out[short] = _xor(data, start[short], size[short]) ^ START[size[short]] ^ np.uint32(0xFFFFFFFF)
    left = np.flatnonzero(size > BLOCK)
    if len(left):
        # the first block takes what is over, so that all others are whole
        head = (size[left] - 1) % BLOCK + 1
        state = _xor(data, start[left], head) ^ START[head]
        at, end = start[left] + head, start[left] + size[left]
        while len(left):
            state = AHEAD[0][state & 0xFF] ^ AHEAD[1][(state >> 8) & 0xFF] ^ AHEAD[2][(state >> 16) & 0xFF] ^ AHEAD[3][state >> 24]
            state ^= _xor(data, at, np.full(len(at), BLOCK))
            at = at + BLOCK
            done = at >= end
            out[left[done]] = state[done] ^ np.uint32(0xFFFFFFFF)
            left, state, at, end = left[~done], state[~done], at[~done], end[~done]
    return out
