"""Words of UTF-8 texts found and hashed with array operations (letters only, lower-cased)."""

from __future__ import annotations

import numpy as np

MULT = np.uint64(0x9E3779B97F4A7C15)
STEP = 0x100000001B3  # odd, so that its powers can be undone
STEP_BACK = pow(STEP, -1, 1 << 64)

_LETTER = np.zeros(256, dtype=np.uint8) + 32
for _c in range(256):
    if 65 <= _c <= 90:
        _LETTER[_c] = _c + 32
    elif 97 <= _c <= 122 or _c >= 128:
        _LETTER[_c] = _c

_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        base = np.full(n, STEP if kind == "up" else STEP_BACK, dtype=np.uint64)
        base[0] = 1
        _powers[kind] = np.multiply.accumulate(base)
    return _powers[kind][:n]


class Words:
    """Words of texts that stand one after another in a buffer.

    ``raw``: lower-cased bytes, 32 where no letter stands, with four in front;
    ``start``, ``end``: bounds of each word; ``per_text``: words of each text.
    """

    def __init__(self, texts: list[bytes]):
        buf = b"    " + b"\n".join(texts) + b"\n"
        raw = _LETTER[np.frombuffer(buf, dtype=np.uint8)]
        # capital letters of the Latin-1 block: second byte after 0xC3
        second = (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97) & (raw[:-1] == 0xC3)
        raw[1:][second] += 32
        letter = raw != 32
        edge = np.flatnonzero(letter[1:] != letter[:-1]) + 1
        self.raw, self.letter = raw, letter
        self.start, self.end = edge[::2], edge[1::2]
        stops = 4 + np.cumsum([len(t) + 1 for t in texts])
        at = np.searchsorted(self.start, stops)
        self.per_text = np.diff(at, prepend=0)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each whole word."""
        total = np.append(np.uint64(0), np.cumsum(self.raw * _power("up", len(self.raw)), dtype=np.uint64))
        value = (total[self.end] - total[self.start]) * _power("down", len(self.raw))[self.start]
        return (value ^ (value >> np.uint64(31))) * MULT

    def heads(self) -> np.ndarray:
        """First eight bytes of each word, most significant first, zeros after a shorter word."""
        padded = np.concatenate([self.raw, np.zeros(8, np.uint8)])
        eight = np.ndarray(len(self.raw), dtype=">u8", buffer=padded, strides=(1,))  # at every byte
        cut = np.uint64(8) * (8 - np.minimum(self.end - self.start, 8)).astype(np.uint64)
        return eight[self.start].astype(np.uint64) >> cut << cut

    def prefixes(self, size: int) -> np.ndarray:
        """Hash of the first ``size`` bytes (at most 8); a shorter word counts as a whole."""
        return head_hashes(self.heads(), size)


def head_hashes(heads: np.ndarray, size: int) -> np.ndarray:
    """Hash of the first ``size`` bytes (1 to 8) of :meth:`Words.heads`."""
    return ((heads >> np.uint64(64 - 8 * size)) + np.uint64(size)) * MULT


def bucket(value: np.ndarray, bits: int) -> np.ndarray:
    return (value >> np.uint64(64 - bits)).astype(np.int64)
