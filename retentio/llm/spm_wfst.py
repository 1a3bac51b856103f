"""SentencePiece encoding and decoding as a weighted finite-state transducer.

The transducer is compiled from a model file.

* Normaliser: the model's character map is compiled into rules that read some
  characters and write others, the leftmost and longest first; runs of spaces
  are joined and the edges trimmed if the model says so; a space becomes the
  mark U+2581 and a text gets one in front.
* Pieces: one state for each piece last written.  From state p an arc reads
  the characters of piece q and writes its id.  In a byte-pair model the arc
  has weight one if q may follow p and infinite weight otherwise; q may
  not follow p if merging by rank would have joined parts of the two across
  their border.  In a unigram model the weight is minus the score.
* Byte fallback: a character outside the vocabulary is read by an arc that
  writes its UTF-8 bytes as byte pieces, from and to any state.

Composing with an input gives a lattice over its positions; its shortest path
in the tropical semiring is the encoding.  In a byte-pair model exactly one
piece can end the encoding of each prefix, so a position needs one state only,
and relaxing the arcs position by position, many words at a time, finds the
path.  No piece spans a space or line break, so the lattice falls into words
and distinct words are solved once (``WordTable``).  Words of unlike lengths are
relaxed together, as a prefix's best path doesn't depend on what follows it.

A long word of a byte-pair model is solved in overlapping windows, all
relaxed together.  An arc reaches back at most the longest piece, so once two
neighbours agree on the last pieces of that many positions in a row, the
later one goes on exactly as the word's own search would; from there on its
states are taken.  Where two never agree (texts of one period), and in runs
of spaces, whose pieces have equal weights, the word is merged by rank with a
heap, ties to the left, as in the library; either way the work grows with the
length, not its square.

Decoding joins the pieces' bytes, turns marks into spaces and drops the first;
it gives the normalised text (the text itself in a model without a map).

Defined cases: null or empty text has no ids; U+2581 in a text reads as a
space; repeated rows each get a row; extra columns are ignored.
"""

from __future__ import annotations

import re
import struct

import numpy as np
from pyspark.sql import DataFrame

from retentio.llm.common import byte_slices, ship_package, text_bytes
from retentio.llm.word_table import BREAK, FIRST, MARKS, SPACE, WordTable

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
FILTER_BITS = 20
LONG = 4096  # characters beyond which a word is solved in windows
STRIDE = 1024
OVERLAP = 256
WINDOWS = 512  # windows solved at once
CELLS = 1_000_000  # lattice positions solved at once
SLICE = 1 << 22  # bytes of text encoded at once


def _fields(raw: bytes):
    """(number, value) of a protocol-buffer message: ints, floats as 4 raw bytes, or bytes."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            b = raw[at]
            at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value
            shift += 7

    while at < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            n = varint() if kind == 2 else {5: 4, 1: 8}[kind]
            yield tag >> 3, raw[at:at + n]
            at += n


def character_map(raw: bytes) -> dict[str, str]:
    """Rules of a precompiled character map: the size of a double-array trie over UTF-8 bytes, its
    units (uint32), and the replacements, each ended by a NUL; a leaf holds its replacement's place."""
    size = struct.unpack_from("<I", raw)[0]
    units = np.frombuffer(raw, dtype="<u4", count=size // 4, offset=4).astype(np.int64)
    texts = raw[4 + size:]
    labels, steps = units & 0x800000FF, np.arange(1, 256)

    def below(at: np.ndarray) -> np.ndarray:
        return at ^ ((units[at] >> 10) << ((units[at] & 0x200) >> 6))

    rules: dict[str, str] = {}
    open_ = [(below(np.zeros(1, dtype=np.int64)), [b""])]
    while open_:  # many states of one depth at once
        base, keys = open_.pop()
        places = base[:, None] ^ steps
        row, step = np.nonzero((places < len(units)) & (labels[places.clip(max=len(units) - 1)] == steps))
        node = places[row, step]
        child = below(node)
        found = [keys[r] + bytes((c + 1,)) for r, c in zip(row.tolist(), step.tolist())]
        ends = np.flatnonzero(units[node] >> 8 & 1)
        for k, at in zip(ends.tolist(), (units[child[ends]] & 0x7FFFFFFF).tolist()):
            rules[found[k].decode()] = texts[at:texts.index(b"\0", at)].decode()
        open_ += [(child[k:k + 4096], found[k:k + 4096]) for k in range(0, len(found), 4096)]
    return rules


class Normaliser:
    """Rewrites a text by rules, leftmost and longest first, and joins spaces if ``squeeze``."""

    def __init__(self, rules: dict[str, str], squeeze: bool):
        if any("  " in new for new in rules.values()):
            raise ValueError("a rule of the character map writes two spaces in a row")
        self.rules, self.squeeze = rules, squeeze
        self.longest = max(map(len, rules), default=0)
        # where a rule may begin: at a character with a rule of its own, or before one that goes on a rule
        heads = "".join(sorted({re.escape(k) for k in rules if len(k) == 1}))
        nexts = "".join(sorted({re.escape(k[1]) for k in rules if len(k) > 1}))
        parts = [f"[{heads}]"] * bool(heads) + [f".(?=[{nexts}])"] * bool(nexts)
        self.begin = re.compile("|".join(parts), re.DOTALL) if parts else None

    def __call__(self, text: str) -> str:
        if self.begin is not None:
            out, done = [], 0
            found = self.begin.search(text)
            while found:
                at = found.start()
                for n in range(self.longest, 0, -1):
                    new = self.rules.get(text[at:at + n])
                    if new is not None and at + n <= len(text):
                        out += [text[done:at], new]
                        done = at = at + n
                        break
                else:
                    at += 1
                found = self.begin.search(text, at)
            text = "".join(out) + text[done:]
        if self.squeeze:
            text = re.sub("  +", " ", text).lstrip(" ").rstrip(" " + MARK)
        return text


class Model:
    """Pieces, scores and kinds of a SentencePiece model file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            raw = f.read()
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        self.byte_pair, self.dummy_prefix, self.squeeze, rules = False, True, True, b""
        for number, value in _fields(raw):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                self.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                spec = dict(_fields(value))
                self.byte_pair = spec.get(3, 1) == 2
                if spec.get(24):
                    raise ValueError("marks behind words are not supported")
            elif number == 3:
                spec = dict(_fields(value))
                self.dummy_prefix, self.squeeze = bool(spec.get(3, 1)), bool(spec.get(4, 1))
                rules = spec.get(2, b"")
                if not spec.get(5, 1):
                    raise ValueError("spaces that stay spaces are not supported")
        if rules and USER in self.kinds:
            raise ValueError("a character map beside user-defined pieces is not supported")
        self.normaliser = Normaliser(character_map(rules) if rules else {}, self.squeeze)


def _hashes(chars: np.ndarray) -> np.ndarray:
    """Prefix hashes along the last axis, with a leading 0."""
    out = np.zeros((*chars.shape[:-1], chars.shape[-1] + 1), dtype=np.uint64)
    for k in range(chars.shape[-1]):
        out[..., k + 1] = out[..., k] * BASE + chars[..., k] + np.uint64(1)
    return out


class Transducer:
    """Compiled arcs and the shortest-path search over many words at once."""

    def __init__(self, model: Model):
        self.model = model
        pieces, kinds = model.pieces, model.kinds
        usable = [i for i, k in enumerate(kinds) if k in (NORMAL, USER) and pieces[i]]
        self.ids = {pieces[i]: i for i in usable}
        if any(MARK in pieces[i].lstrip(MARK) or "\n" in pieces[i] for i in usable):
            raise ValueError("a piece spans a space or a line break: words can't be solved apart")
        self.byte_ids = np.full(256, -1, dtype=np.int64)
        for i, k in enumerate(kinds):
            if k == BYTE:
                self.byte_ids[int(pieces[i][1:-1], 16)] = i
        self.unknown = kinds.index(UNKNOWN)
        self.other = len(pieces)  # state after a character outside the vocabulary
        self.longest = max(len(pieces[i]) for i in usable)
        lengths = np.array([len(pieces[i]) for i in usable])
        self.powers = BASE ** np.arange(self.longest + 1, dtype=np.uint64)
        value = np.zeros(len(usable), dtype=np.uint64)
        for n in range(1, self.longest + 1):
            at = np.flatnonzero(lengths == n)
            if len(at):
                chars = np.array([[ord(c) for c in pieces[usable[i]]] for i in at], dtype=np.uint64)
                value[at] = _hashes(chars)[:, -1]
        order = np.argsort(value)
        self.piece_hash, self.piece_id = value[order], np.array(usable)[order]
        self.filter = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.filter[self._bucket(value)] = True
        if model.byte_pair:
            self._compile_merges(usable)
        else:
            self.weight = np.append(-np.array(model.scores), 10.0 - min(model.scores))

    @staticmethod
    def _bucket(value: np.ndarray) -> np.ndarray:
        return ((value ^ (value >> np.uint64(29))) * BASE) >> np.uint64(64 - FILTER_BITS)

    def _compile_merges(self, usable: list[int]) -> None:
        """Rank of every piece, its last merge, and all pairs whose join is a piece."""
        pieces, scores = self.model.pieces, self.model.scores
        n = len(pieces) + 1
        self.rank = np.full(n, -1, dtype=np.int64)  # single characters: before every merge
        self.left, self.right = np.arange(n), np.arange(n)
        joined = sorted((i for i in usable if len(pieces[i]) > 1), key=lambda i: -scores[i])
        place, last = -1, None
        for i in joined:
            if scores[i] != last:
                place, last = place + 1, scores[i]
            self.rank[i] = place
        keys, ranks = [], []
        for i in joined:
            p = pieces[i]
            for k in range(1, len(p)):
                a, b = self.ids.get(p[:k]), self.ids.get(p[k:])
                if a is not None and b is not None:
                    keys.append(a * n + b)
                    ranks.append(self.rank[i])
        order = np.argsort(keys)
        self.pair_key, self.pair_rank = np.array(keys)[order], np.array(ranks)[order]
        self.span = n
        self.pair_filter = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.pair_filter[self._bucket(self.pair_key.astype(np.uint64))] = True
        for i in joined:
            parts = self.merge(pieces[i], below=i)
            if len(parts) == 2:
                self.left[i], self.right[i] = self.ids[parts[0]], self.ids[parts[1]]

    def merge(self, word: str, below: int | None = None) -> list[str]:
        """Plain merging by rank; ``below``: a piece not to be made (its last merge is wanted)."""
        if below is None and len(word) > 32:
            return self.merge_long(word)
        parts = list(word)
        scores = self.model.scores
        while len(parts) > 1:
            best = None
            for k in range(len(parts) - 1):
                i = self.ids.get(parts[k] + parts[k + 1])
                if i is not None and i != below and (best is None or scores[i] > best[0]):
                    best = (scores[i], k)
            if best is None:
                break
            k = best[1]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def merge_long(self, word: str) -> list[str]:
        """:meth:`merge` with a heap of pairs over a linked list: n log n steps."""
        import heapq
        part: list[str | None] = list(word)
        n = len(part)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        ids, scores = self.ids, self.model.scores

        def pair(a: int):
            b = after[a]
            if b < n:
                i = ids.get(part[a] + part[b])
                if i is not None:
                    return -scores[i], a, len(part[a]), len(part[b])
            return None

        heap = [p for p in map(pair, range(n)) if p]
        heapq.heapify(heap)
        while heap:
            _, a, size_a, size_b = heapq.heappop(heap)
            if part[a] is None or len(part[a]) != size_a:
                continue  # one side has grown or is gone
            b = after[a]
            if b >= n or len(part[b]) != size_b:
                continue
            part[a] += part[b]
            part[b] = None
            after[a] = after[b]
            if after[b] < n:
                before[after[b]] = a
            for at in (before[a], a):
                p = pair(at) if at >= 0 else None
                if p:
                    heapq.heappush(heap, p)
        return [p for p in part if p is not None]

    def long_path(self, word: str) -> np.ndarray | None:
        """Pieces of a long word by windows; None if two neighbours don't come to agree."""
        chars = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        n, reach = len(chars), self.longest
        starts = np.arange(0, max(1, n - OVERLAP), STRIDE)
        size = STRIDE + OVERLAP
        piece, length = np.full(n + 1, -1, dtype=np.int64), np.zeros(n + 1, dtype=np.int64)
        for a in range(0, len(starts), WINDOWS):
            some = starts[a:a + WINDOWS + 1]  # the last one begins the next round too
            span = max(size, n - int(some[-1])) if a + WINDOWS + 1 >= len(starts) else size
            room = np.zeros(int(some[-1]) + span, dtype=np.uint32)
            room[:min(n, len(room))] = chars[:len(room)]
            p, k = self._relax(room[np.arange(span)[:, None] + some[None, :]])
            p, k = p.T, k.T
            same = (p[:-1, STRIDE + 1:size + 1] == p[1:, 1:OVERLAP + 1]) & (
                k[:-1, STRIDE + 1:size + 1] == k[1:, 1:OVERLAP + 1])
            total = np.cumsum(np.pad(same, ((0, 0), (1, 0))), axis=1)
            agreed = total[:, reach:] - total[:, :-reach] == reach
            if len(some) > 1 and not agreed.any(axis=1).all():
                return None
            take = np.append(0, agreed.argmax(axis=1) + reach + 1)  # first position of each window's own
            for r, start in enumerate(some):
                if r == 0 and a:
                    continue  # taken in the round before
                end = min(n, int(start) + span)
                piece[start + max(1, take[r]):end + 1] = p[r, max(1, take[r]):end - start + 1]
                length[start + max(1, take[r]):end + 1] = k[r, max(1, take[r]):end - start + 1]
        path, at = [], n
        while at > 0:
            if piece[at] < 0:
                return None
            path.append(int(piece[at]))
            at -= int(length[at])
        return np.array(path[::-1], dtype=np.int64) if at == 0 else None

    def may_follow(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """True where merging by rank leaves the border between the two pieces standing.

        Undo the later merge of the two sides again and again; at no time may
        the two pieces then at the border join before the merge just undone.
        """
        ok = np.ones(len(first), dtype=bool)
        at = np.flatnonzero((first != self.other) & (second != self.other))
        x, y = first[at].astype(np.int64), second[at].astype(np.int64)
        until = np.full(len(at), np.iinfo(np.int64).max)  # joins at a rank below this come first
        while len(at):
            key = x * self.span + y
            joins = self.pair_filter[self._bucket(key.astype(np.uint64))]
            maybe = np.flatnonzero(joins)
            k = np.searchsorted(self.pair_key, key[maybe]).clip(max=len(self.pair_key) - 1)
            joins[maybe] = (self.pair_key[k] == key[maybe]) & (self.pair_rank[k] < until[maybe])
            ok[at[joins]] = False
            rx, ry = self.rank[x], self.rank[y]
            stay = ~joins & ((rx >= 0) | (ry >= 0))
            at, x, y, rx, ry, until = (v[stay] for v in (at, x, y, rx, ry, until))
            undo_first = rx > ry  # of equal merges the left one comes first
            # an equal rank at the border comes after a merge on its left, before one on its right
            until = np.where(undo_first, rx, ry + 1)
            x = np.where(undo_first, self.right[x], x)
            y = np.where(undo_first, y, self.left[y])
        return ok

    def _relax(self, chars: np.ndarray, lengths: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Best last piece and its length for every prefix of the words, a column each.

        Words shorter than the columns come last; ``lengths``, descending, says where each ends.
        """
        size, n = chars.shape
        prefix = np.zeros((size + 1, n), dtype=np.uint64)
        for k in range(size):
            prefix[k + 1] = prefix[k] * BASE + chars[k] + np.uint64(1)
        active = np.full(size + 1, n) if lengths is None else n - np.searchsorted(lengths[::-1], np.arange(size + 1))
        back_piece = np.full((size + 1, n), -1, dtype=np.int32)
        back_len = np.zeros((size + 1, n), dtype=np.int16)
        cost = np.full((size + 1, n), np.inf)
        cost[0] = 0
        reached = np.zeros((size + 1, n), dtype=bool)
        reached[0] = True
        for end in range(1, size + 1):
            m = int(active[end])
            for length in range(min(self.longest, end), 0, -1):
                start = end - length
                value = prefix[end, :m] - prefix[start, :m] * self.powers[length]
                hit = self.filter[self._bucket(value)] & reached[start, :m]
                if self.model.byte_pair:
                    hit &= ~reached[end, :m]
                maybe = np.flatnonzero(hit)
                if not len(maybe):
                    continue
                k = np.searchsorted(self.piece_hash, value[maybe]).clip(max=len(self.piece_hash) - 1)
                found = self.piece_hash[k] == value[maybe]
                at, piece = maybe[found], self.piece_id[k[found]]
                if self.model.byte_pair:
                    if start and len(at):
                        good = self.may_follow(back_piece[start, at], piece)
                        at, piece = at[good], piece[good]
                    new = cost[start, at] + 1.0
                else:
                    new = cost[start, at] + self.weight[piece]
                    good = new < cost[end, at]
                    at, piece, new = at[good], piece[good], new[good]
                cost[end, at], back_piece[end, at], back_len[end, at], reached[end, at] = new, piece, length, True
            outside = self.outside[chars[end - 1, :m]]
            if self.model.byte_pair:
                lone = np.flatnonzero(~reached[end, :m] & reached[end - 1, :m] & outside)
                cost[end, lone] = cost[end - 1, lone] + 1.0
            else:
                new = cost[end - 1, :m] + self.weight[self.other]
                lone = np.flatnonzero(outside & (new < cost[end, :m]))
                cost[end, lone] = new[lone]
            back_piece[end, lone], back_len[end, lone], reached[end, lone] = self.other, 1, True
        return back_piece, back_len

    @property
    def outside(self) -> np.ndarray:
        """By code point: no piece for the single character."""
        if not hasattr(self, "_outside"):
            table = np.ones(0x110000, dtype=bool)
            table[[ord(p) for p in self.ids if len(p) == 1]] = False
            self._outside = table
        return self._outside

    def ids_of(self, pieces: list[str]) -> list[int]:
        out = []
        for p in pieces:
            i = self.ids.get(p)
            if i is not None:
                out.append(i)
            elif self.byte_ids[0] < 0:
                out.append(self.unknown)
            else:
                out += self.byte_ids[list(p.encode())].tolist()
        return out

    def solve(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Shortest paths of normalised words: ids one after another, ids of each word."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        order = np.argsort(-lengths, kind="stable")
        parts, sizes, special = [], np.zeros(len(words), dtype=np.int64), {}
        done, stop = 0, int((lengths > 0).sum())
        while done < stop and self.model.byte_pair and lengths[order[done]] > LONG:
            word = words[order[done]]
            path = None if MARK * 2 in word else self.long_path(word)
            special[int(order[done])] = self.ids_of(self.merge(word)) if path is None else self._with_bytes(word, path)
            done += 1
        while done < stop:
            size = int(lengths[order[done]])
            some = order[done:min(stop, done + max(1, CELLS // size))]
            done += len(some)
            widths = lengths[some]
            row = np.repeat(np.arange(len(some)), widths)
            chars = np.zeros((size, len(some)), dtype=np.uint32)
            chars[np.arange(len(row)) - np.repeat(np.cumsum(widths) - widths, widths), row] = np.frombuffer(
                "".join([words[i] for i in some]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
            piece, length = self._relax(chars, widths)
            path = np.full((len(some), size), -1, dtype=np.int32)  # by end position
            place = widths.copy()
            live = np.arange(len(some))
            while len(live):
                end = place[live]
                path[live, end - 1] = piece[end, live]
                place[live] = np.where(piece[end, live] < 0, -1, end - length[end, live])
                live = live[place[live] > 0]
            plain = (place == 0) & ~(path == self.other).any(axis=1)
            if self.model.byte_pair:  # runs of marks: equal weights
                marks = chars == ord(MARK)
                plain &= ~(marks[1:] & marks[:-1]).any(axis=0)
            for r in np.flatnonzero(~plain):
                word = words[some[r]]
                if place[r] == 0 and not (self.model.byte_pair and MARK * 2 in word):
                    own = self._with_bytes(word, path[r][path[r] >= 0])
                else:
                    own = self.ids_of(self.merge(word))
                special[int(some[r])] = own
                path[r] = -1
            used = path >= 0
            sizes[some] = used.sum(axis=1)
            parts.append(path[used])
        flat = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
        ordered = sizes[order]
        begin = np.empty(len(words), dtype=np.int64)
        begin[order] = np.cumsum(ordered) - ordered
        extra = len(flat)
        if special:
            for i, own in special.items():
                begin[i], sizes[i] = extra, len(own)
                extra += len(own)
            flat = np.concatenate([flat, *[np.array(own, dtype=np.int64) for own in special.values()]])
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return flat[np.repeat(begin - (ends - sizes), sizes) + np.arange(total)], sizes

    def _with_bytes(self, word: str, path: np.ndarray) -> list[int]:
        got, at = [], 0
        for p in path.tolist():
            if p == self.other:
                got += self.ids_of([word[at]])
                at += 1
            else:
                got.append(p)
                at += len(self.model.pieces[p])
        return got


class Codec:
    """Texts to ids and back for one model file."""

    def __init__(self, path: str, limit: int = 1_000_000):
        self.model = Model(path)
        self.fst = Transducer(self.model)
        ids = np.uint16 if len(self.model.pieces) < 1 << 16 else np.uint32
        self.table = WordTable(self.words, self.whole, self.usable, ids, limit, self.mark_ids())
        pieces = [bytes([int(p[1:-1], 16)]) if k == BYTE else b"" if k == CONTROL else
                  p.replace(MARK, " ").encode() if k != UNKNOWN else " ⁇ ".encode()
                  for p, k in zip(self.model.pieces, self.model.kinds)]
        self.piece_size = np.array([len(p) for p in pieces])
        self.piece_start = np.cumsum(self.piece_size) - self.piece_size
        self.piece_bytes = np.frombuffer(b"".join(pieces), dtype=np.uint8)

    def mark_ids(self) -> dict[int, np.ndarray]:
        """Ids of the marks that no piece joins to an ASCII letter before them."""
        joined = {p[k + 1] for p in self.fst.ids for k in range(len(p) - 1) if p[k].isascii() and p[k].isalpha()}
        return {m: np.array(self.fst.ids_of([chr(m)])) for m in MARKS if chr(m) not in joined}

    @staticmethod
    def usable(word: bytes) -> bool:
        """A word that holds the mark is part of a run of spaces: its text is solved by runs."""
        return MARK.encode() not in word

    def words(self, words: list[bytes], kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        before = {FIRST: MARK if self.model.dummy_prefix else "", SPACE: MARK, BREAK: ""}
        flat, sizes = self.fst.solve([before[k] + w.decode() for w, k in zip(words, kinds.tolist())])
        broken = kinds == BREAK
        if broken.any():  # the line break itself, which is in no piece
            line = self.fst.ids_of(["\n"])
            begin = (np.cumsum(sizes) - sizes)[broken]
            flat = np.insert(flat, np.repeat(begin, len(line)), np.tile(line, len(begin)))
            sizes = sizes + broken * len(line)
        return flat, sizes

    def whole(self, text: str | bytes) -> np.ndarray:
        """Any text: cut before every run of marks, and at line breaks, which are in no piece."""
        if not text:
            return np.zeros(0, dtype=np.int64)
        text = text.decode() if isinstance(text, bytes) else text
        text = (MARK if self.model.dummy_prefix else "") + text.replace(" ", MARK)
        line = self.fst.ids_of(["\n"])
        parts = []
        for k, part in enumerate(text.split("\n")):
            words, at = [], 0
            for i in range(1, len(part)):
                if part[i] == MARK and part[i - 1] != MARK:
                    words.append(part[at:i])
                    at = i
            parts += [line] if k else []
            parts.append(self.fst.solve([*words, part[at:]])[0])
        return np.concatenate(parts).astype(np.int64)

    def encode(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, number of ids of each text); texts as strings or UTF-8."""
        plain = self.normalised(texts)
        ids, sizes = self.table.encode(plain)
        if self.model.dummy_prefix and not self.model.squeeze:  # texts whose characters all vanish keep the mark
            lone = np.array([bool(t) and not p for t, p in zip(texts, plain)], dtype=bool)
            if lone.any():
                mark = self.fst.solve([MARK])[0]
                at = (np.cumsum(sizes) - sizes)[lone]
                ids = np.insert(ids, np.repeat(at, len(mark)), np.tile(mark, len(at)))
                sizes = sizes + lone * len(mark)
        return ids, sizes

    def normalised(self, texts: list) -> list[bytes]:
        """UTF-8 of the texts after the model's rules, their spaces not yet marks."""
        own = self.model.normaliser
        if own.begin is None and not own.squeeze:
            return [t.encode() if isinstance(t, str) else t for t in texts]
        return [own(t if isinstance(t, str) else t.decode()).encode() for t in texts]

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """UTF-8 bytes of texts whose ids stand one after another."""
        ids = ids.astype(np.int64)
        n = self.piece_size[ids]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.piece_bytes[np.repeat(self.piece_start[ids] - (ends - n), n) + np.arange(total)].tobytes()
        stops = np.append(0, ends)[np.cumsum(sizes)].tolist()
        out, at = [], 0
        for stop in stops:
            t = flat[at:stop]
            out.append(t[1:] if self.model.dummy_prefix and t[:1] == b" " else t)
            at = stop
        return out


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One codec a worker process, so that its words outlive a task."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


SCHEMA = "doc_id long, n_pieces int, piece_ids array<int>, round_trip boolean"


def encode_documents(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_pieces, piece_ids, round_trip): ids of each whole text; round_trip says that
    decoding them gives the (normalised) text back."""
    ship_package(docs.sparkSession)

    def run(batches):
        import pyarrow as pa
        own, mark = codec(model), MARK.encode()
        for b in batches:
            texts = text_bytes(b.column(1))
            for i, j in byte_slices(texts, SLICE):
                some = texts[i:j]
                ids, sizes = own.encode(some)
                back = own.decode(ids, sizes)
                same = [t.replace(mark, b" ") == d for t, d in zip(own.normalised(some), back)]
                starts = np.append(0, np.cumsum(sizes)).astype(np.int32)
                yield pa.record_batch([
                    b.column(0).slice(i, j - i), pa.array(sizes.astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(starts), pa.array(ids.astype(np.int32))), pa.array(same)],
                    names=["doc_id", "n_pieces", "piece_ids", "round_trip"])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def decode_documents(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, text) from (doc_id, piece_ids)."""
    ship_package(encoded.sparkSession)

    def run(batches):
        import pyarrow as pa
        own = codec(model)
        for b in batches:
            lists = [np.array(x or [], dtype=np.int64) for x in b.column(1).to_pylist()]
            ids = np.concatenate(lists) if lists else np.zeros(0, dtype=np.int64)
            back = own.decode(ids, np.array([len(x) for x in lists], dtype=np.int64))
            yield pa.record_batch([b.column(0), pa.array([t.decode("utf-8", "replace") for t in back], pa.string())],
                                  names=["doc_id", "text"])

    return encoded.select("doc_id", "piece_ids").mapInArrow(run, "doc_id long, text string")
