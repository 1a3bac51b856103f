"""Secret scans with multipart credential linking.

Base kinds, each leftmost and non-overlapping over the whole text: ``assign``
(a secret-like name, a separator and a value of 8+ characters), ``access``
(``AKIA`` identifiers of 16+ characters) and ``hex`` (32+ lower-case hex
digits).  They are always reported.

Linking.  Weak parts say little alone: identifiers of an account or client,
values that look random, and endpoints.  An interval join pairs identifiers
(strong or weak) with secret values (strong or weak) whose gap is at most
``SCOPE`` code points without a blank line between, and endpoints with such
pairs, with named secrets (``assign``) and with ``access`` identifiers, which
need no pair.  A ``hex`` run may be a checksum beside a download, so it takes an
identifier to link it.  Weak parts are reported only beside a complementary
part: ``ident``, ``value`` and ``endpoint`` spans are added to the base ones.

The join runs inside each text: both sides are sorted by position and
matched by binary search, so its cost follows the parts found.

Defined cases: null text is empty and has no span; a document without spans
has the digest of the empty string; repeated rows each get a row.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame

from retentio.llm.common import ship_package

SCOPE = 256
KINDS = ("assign", "access", "hex", "ident", "value", "endpoint")
MASK = "[SECRET]"

ASSIGN = re.compile(r"""(?ia:(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
IDENT = re.compile(r"""(?ia:(?:client|account|access|user|key)[_-]?id["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.-]{6,}))""")
VALUE = re.compile(r"(?a:(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-]))")
ENDPOINT = re.compile(r"(?a:https?://[^\s\"'<>]+|(?<![\w.-])[a-z0-9-]+(?:\.[a-z0-9-]+)*\.amazonaws\.com)")

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """Spans (start, end, kind) of the base kinds."""
    found: list[Span] = []
    low = text.encode("utf-8", "surrogatepass").lower()
    if any(k in low for k in (b"passw", b"secret", b"token", b"apikey", b"api_key")):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def _random_looking(s: str) -> bool:
    return (any(c.isdigit() for c in s) and any(c.islower() for c in s) and any(c.isupper() for c in s)
            and len(set(s)) >= 10)


class _Intervals:
    """Spans sorted by start, with the largest end so far: neighbours by binary search."""

    def __init__(self, spans):
        self.spans = sorted(spans)
        self.starts = [s[0] for s in self.spans]
        self.reach = list(accumulate((s[1] for s in self.spans), max))

    def between(self, first: int, last: int) -> list[Span]:
        """Spans that begin at ``last`` or before and may end at ``first`` or after."""
        return self.spans[bisect_left(self.reach, first):bisect_right(self.starts, last)]

    def near(self, span: Span, text: str) -> list[Span]:
        """Spans within ``SCOPE`` of ``span`` and no blank line between."""
        out = []
        for o in self.between(span[0] - SCOPE, span[1] + SCOPE):
            a, b = min(span[1], o[1]), max(span[0], o[0])
            if o[:2] != span[:2] and b - a <= SCOPE and "\n\n" not in text[a:b]:
                out.append(o)
        return out

    def meets(self, a: int, b: int) -> bool:
        """Whether a span shares a character with [a, b)."""
        return any(a < y and x < b for x, y, _ in self.between(a + 1, b - 1))


def linked_spans(text: str, base: list[Span]) -> list[Span]:
    """Weak parts that stand with a complementary part."""
    strong_ids = [s for s in base if s[2] == "access"]
    named = [s for s in base if s[2] in ("assign", "access")]
    weak_ids = [(m.start(1), m.end(1), "ident") for m in IDENT.finditer(text)] if "id" in text.lower() else []
    if not named and not weak_ids:
        return []
    taken = _Intervals(base)
    pairs, chosen = pair_parts(text, base, taken, strong_ids, weak_ids) if strong_ids or weak_ids else ([], set())
    if (pairs or named) and ("://" in text or ".amazonaws.com" in text):
        scopes = _Intervals({*pairs, *((a, b, "") for a, b, _ in named)})
        for m in ENDPOINT.finditer(text):
            s = (m.start(), m.end(), "endpoint")
            if not taken.meets(*s[:2]) and scopes.near(s, text):
                chosen.add(s)
    return [s for s in chosen if s[2] in ("ident", "value", "endpoint")]


def pair_parts(text: str, base: list[Span], taken: _Intervals, strong_ids: list[Span],
               weak_ids: list[Span]) -> tuple[list[Span], set[Span]]:
    """Scopes of the pairs of identifier and secret value, and the parts of all pairs."""
    ids = sorted(strong_ids + [s for s in weak_ids if not taken.meets(*s[:2])])
    id_places = {(a, b) for a, b, _ in ids}
    weak = [(m.start(), m.end(), "value") for m in VALUE.finditer(text)
            if _random_looking(m.group()) and (m.start(), m.end()) not in id_places
            and not taken.meets(m.start(), m.end())]
    values = _Intervals(weak + [s for s in base if s[2] in ("assign", "hex")])
    pairs, chosen = [], set()
    for i in ids:
        for v in values.near(i, text):
            if i[2] == "ident" and v[2] == "value" and i[0] < v[1] and v[0] < i[1]:
                continue  # an identifier's own text is no second part
            chosen |= {i, v}
            pairs.append((min(i[0], v[0]), max(i[1], v[1]), ""))
    return pairs, chosen


def scan(text: str | None) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), each by start and then by kind as listed."""
    order = lambda s: (s[0], KINDS.index(s[2]), s[1])
    text = text or ""
    base = sorted(base_spans(text), key=order)
    return base, sorted(base + linked_spans(text, base), key=order)


def spans_text(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def redact(text: str | None) -> str | None:
    """``text`` with every reported span (overlaps merged) replaced by ``MASK``."""
    if not text:
        return text
    out, at = [], 0
    for a, b, _ in scan(text)[1]:
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], MASK]
        at = b
    return text if not out else "".join(out) + text[at:]


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def secret_table(docs: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, their digest, and all spans."""
    ship_package(docs.sparkSession)

    def run(batches):
        import pyarrow as pa
        for b in batches:
            rows = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")}
            for t in b.column(1):
                base, spans = scan(t.as_py())
                for k in KINDS[:3]:
                    rows[f"n_{k}"].append(sum(s[2] == k for s in base))
                rows["base_sha256"].append(hashlib.sha256(spans_text(base).encode()).hexdigest())
                rows["spans"].append(spans_text(spans))
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.record_batch([b.column(0), *[pa.array(v, k) for v, k in zip(rows.values(), kinds)]],
                                  names=["doc_id", *rows])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def redact_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets masked in ``text`` and ``n_chars`` (if present) set anew where it changed."""
    ship_package(docs.sparkSession)
    names = docs.columns

    def run(batches):
        import pyarrow as pa
        at = names.index("text")
        for b in batches:
            old = b.column(at).to_pylist()
            new = [redact(t) for t in old]
            cols = list(b.columns)
            cols[at] = pa.array(new, b.schema.field(at).type)
            if "n_chars" in names:
                k = names.index("n_chars")
                cols[k] = pa.array([c if x == y else len(y) for c, x, y in zip(b.column(k).to_pylist(), old, new)],
                                   b.schema.field(k).type)
            yield pa.record_batch(cols, schema=b.schema)

    return docs.mapInArrow(run, docs.schema)
