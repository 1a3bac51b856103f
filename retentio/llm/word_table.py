"""Encode texts through a table of their words, looked up with array operations.

For tokenizers that never join a word with the space or line break behind it: a text with single separators between its words is cut into them,
each distinct word is encoded once, and the texts are put together from the
words' ids.  The result is that of encoding whole texts.  A full stop or
another mark of ``MARKS`` that ends a word behind an ASCII letter is a token
group of its own and is cut off, so that it doesn't make a new word.

Words of up to 16 bytes are keys by themselves (two 64-bit numbers, their
length and kind), found in an open-addressing table of numpy arrays; longer
ones go through a dictionary.  The table holds at most ``limit`` words and
starts anew when it is full.
"""

from __future__ import annotations

import numpy as np

FIRST, SPACE, BREAK = 0, 1, 2  # what stands before a word: nothing, a space, a line break
MARKS = b".,!?;:"

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


class WordTable:
    """``encode_words(words, kinds)`` gives the ids of words, one after another, and the number of
    each word's ids; ``encode_whole(text)`` the ids of a text; ``usable(word)`` is false for words
    at whose edges a text can't be cut: texts with one are encoded whole.  ``mark_ids``: the marks
    that are cut off and their ids; all of ``MARKS``, encoded as texts, if not given."""

    def __init__(self, encode_words, encode_whole, usable, dtype, limit: int = 2_000_000, mark_ids=None):
        self.encode_words, self.encode_whole, self.usable, self.dtype = encode_words, encode_whole, usable, dtype
        self.limit = limit
        mark_ids = {m: encode_whole(bytes([m])) for m in MARKS} if mark_ids is None else mark_ids
        self.mark_ids = {m: np.asarray(ids, dtype=dtype) for m, ids in mark_ids.items()}
        self.cut_off = np.zeros(256, dtype=bool)
        self.cut_off[list(self.mark_ids)] = True
        self.clear()

    def clear(self) -> None:
        self.n = 0
        self.long: dict[tuple[bytes, int], int] = {}
        self.slots = np.full(1 << 16, -1, dtype=np.int32)
        self.low, self.high, self.hash = (np.zeros(1024, dtype=np.uint64) for _ in range(3))
        self.meta = np.zeros(1024, dtype=np.int16)
        self.start, self.size = np.zeros(1024, dtype=np.int64), np.zeros(1024, dtype=np.int32)
        self.pool, self.used = np.zeros(1 << 16, dtype=self.dtype), 0
        # the marks come first
        at = self.store(list(self.mark_ids.values()))
        self.meta[at] = -1  # not in the table
        self.mark_at = np.zeros(256, dtype=np.int64)
        self.mark_at[list(self.mark_ids)] = at

    def store(self, parts: list[np.ndarray], sizes: np.ndarray | None = None) -> np.ndarray:
        """Places of new words, whose ids are ``parts`` one after another."""
        flat = np.concatenate(parts) if parts else np.zeros(0, dtype=self.dtype)
        sizes = np.array([len(p) for p in parts], dtype=np.int64) if sizes is None else sizes
        need = self.n + len(sizes)
        if need > len(self.start):
            grow = max(need, 2 * len(self.start))
            for name in ("low", "high", "hash", "meta", "start", "size"):
                setattr(self, name, np.resize(getattr(self, name), grow))
        if self.used + len(flat) > len(self.pool):
            self.pool = np.resize(self.pool, max(self.used + len(flat), 2 * len(self.pool)))
        own = np.maximum(sizes, 0)
        self.pool[self.used:self.used + len(flat)] = flat
        self.start[self.n:need] = self.used + np.cumsum(own) - own
        self.size[self.n:need] = sizes
        self.used += len(flat)
        self.n = need
        return np.arange(need - len(sizes), need)

    def find(self, low: np.ndarray, high: np.ndarray, meta: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Place of each key, or -1."""
        mask = np.uint64(len(self.slots) - 1)
        out = np.full(len(low), -1, dtype=np.int64)
        open_ = np.arange(len(low))
        at = code
        while len(open_):
            place = self.slots[(at & mask).astype(np.int64)]
            filled = place >= 0
            open_, at, place = open_[filled], at[filled], place[filled]
            same = (self.low[place] == low[open_]) & (self.high[place] == high[open_]) & (self.meta[place] == meta[open_])
            out[open_[same]] = place[same]
            open_, at = open_[~same], at[~same] + np.uint64(1)
        return out

    def insert(self, places: np.ndarray) -> None:
        """Enters stored keys, all of them new."""
        if 2 * self.n > len(self.slots):
            size = len(self.slots)
            while 2 * self.n > size:
                size *= 4
            self.slots = np.full(size, -1, dtype=np.int32)
            places = np.flatnonzero(self.meta[:self.n] >= 0)
        mask = np.uint64(len(self.slots) - 1)
        at = self.hash[places]
        while len(places):
            slot = (at & mask).astype(np.int64)
            free = self.slots[slot] < 0
            _, first = np.unique(slot[free], return_index=True)
            winner = np.flatnonzero(free)[first]
            self.slots[slot[winner]] = places[winner]
            rest = np.ones(len(places), dtype=bool)
            rest[winner] = False
            places, at = places[rest], at[rest] + np.uint64(1)

    def add(self, buf: bytes, start: np.ndarray, end: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Encodes and stores distinct words; places in the order given."""
        words = [buf[a:b] for a, b in zip(start.tolist(), end.tolist())]
        bad = np.array([not self.usable(w) for w in words], dtype=bool)
        order = np.lexsort((kind == FIRST, bad))  # first words can't be joined to others
        good = order[:len(words) - int(bad.sum())]
        flat, sizes = self.encode_words([words[k] for k in good], kind[good]) if len(good) else (
            np.zeros(0, self.dtype), np.zeros(0, np.int64))
        places = np.empty(len(words), dtype=np.int64)
        places[order] = self.store([flat], np.append(sizes, np.full(len(words) - len(good), -1)))
        return places

    def places(self, buf: bytes, raw: np.ndarray, start: np.ndarray, end: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Place of each word of a buffer; new ones are added."""
        size = end - start
        eight = np.lib.stride_tricks.as_strided(raw.view(np.uint8)[:8].view(np.uint64), (len(raw) - 7,), (1,))
        low = eight[start] & _KEEP[np.minimum(size, 8)]
        high = np.where(size > 8, eight[start + 8] & _KEEP[np.clip(size - 8, 0, 8)], np.uint64(0))
        meta = (np.minimum(size, 17) | kind << 8).astype(np.int16)
        code = (low * np.uint64(0x9E3779B97F4A7C15)) ^ (high * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (
            meta.astype(np.uint64) * np.uint64(0x165667B19E3779F9))
        code = (code ^ (code >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        code ^= code >> np.uint64(32)
        short = size <= 16
        out = np.full(len(start), -1, dtype=np.int64)
        out[short] = self.find(low[short], high[short], meta[short], code[short])
        for k in np.flatnonzero(~short):
            out[k] = self.long.get((buf[start[k]:end[k]], int(kind[k])), -1)
        missing = np.flatnonzero((out < 0) & short)
        while len(missing):
            _, first, which = np.unique(code[missing], return_index=True, return_inverse=True)
            new = missing[first]
            places = self.add(buf, start[new], end[new], kind[new])
            self.low[places], self.high[places] = low[new], high[new]
            self.meta[places], self.hash[places] = meta[new], code[new]
            self.insert(places)
            same = (low[missing] == low[new][which]) & (high[missing] == high[new][which]) & (
                meta[missing] == meta[new][which])
            out[missing[same]] = places[which[same]]
            missing = missing[~same]  # other words of equal hash, if any
        missing = np.flatnonzero(out < 0)
        if len(missing):
            known: dict[tuple[bytes, int], int] = {}
            for k in missing.tolist():
                known.setdefault((buf[start[k]:end[k]], int(kind[k])), k)
            new = np.array(list(known.values()))
            places = self.add(buf, start[new], end[new], kind[new])
            self.meta[places] = -1  # not in the table
            self.long.update(zip(known, places.tolist()))
            out[missing] = [self.long[(buf[start[k]:end[k]], int(kind[k]))] for k in missing.tolist()]
        return out

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, number of ids of each text)."""
        n = len(texts)
        buf = b"\n" + b"\n".join(texts) + b"\n" + bytes(16)
        raw = np.frombuffer(buf, dtype=np.uint8)
        length = np.array([len(t) for t in texts], dtype=np.int64)
        begin = 1 + np.cumsum(length + 1) - (length + 1)
        gap = (raw == 32) | (raw == 10)
        gap[-16:] = True
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        start, end = edge[::2], edge[1::2]
        bounds = np.append(begin, begin[-1] + length[-1] + 1) if n else np.ones(1, dtype=np.int64)
        first = np.searchsorted(start, bounds)
        count = np.diff(first)
        gaps = np.append(0, np.cumsum(gap))
        inside = gaps[begin + length] - gaps[begin] if n else np.zeros(0, dtype=np.int64)
        clean = (inside == count - 1) & (length > 0)
        keep = np.repeat(clean, count)
        owner = np.repeat(np.arange(n), count)[keep]
        start, end = start[keep], end[keep]
        kind = np.where(raw[start - 1] == 10, BREAK, SPACE)
        kind[start == begin[owner]] = FIRST
        last = raw[end - 1]
        marked = self.cut_off[last] & (end - start > 1) & _LETTER[raw[end - 2]]
        if self.n > self.limit:
            self.clear()
        at = self.places(buf, raw, start, end - marked, kind)
        # the marks behind their words
        items = np.empty(len(at) + int(marked.sum()), dtype=np.int64)
        shift = np.cumsum(marked)
        place = np.arange(len(at)) + shift - marked
        items[place] = at
        items[place[marked] + 1] = self.mark_at[last[marked]]
        sizes = self.size[items].astype(np.int64)
        words = np.bincount(owner, weights=1 + marked, minlength=n).astype(np.int64) if n else count
        heads = np.cumsum(words) - words
        whole = ~clean & (length > 0)
        bad = np.unique(owner[self.size[at] < 0])
        whole[bad] = True
        sizes = np.maximum(sizes, 0)
        ends = np.append(0, np.cumsum(sizes))
        total = int(ends[-1])
        ids = self.pool[np.repeat(self.start[items] - ends[:-1], sizes) + np.arange(total)]
        per_text = ends[heads + words] - ends[heads] if n else np.zeros(0, dtype=np.int64)
        if whole.any():
            pieces = np.split(ids, np.cumsum(per_text)[:-1])
            for k in np.flatnonzero(whole):
                pieces[k] = np.asarray(self.encode_whole(texts[k]), dtype=self.dtype)
                per_text[k] = len(pieces[k])
            ids = np.concatenate(pieces)
        return ids, per_text
