"""Fill-in-middle transformation by one repeated-capture match.

A text is cut into units by a single ``fullmatch`` of ``(unit)*`` with the
regex library, which keeps every repetition of the group: ``match.ends(1)``
lists the end of each unit, so its length is the number of units and two of
its entries are the cut offsets.  The unit's alternatives are possessive, so
that long texts don't pile up places to go back to.

Draws.  ``h1`` to ``h4`` are the first four groups of eight hex digits of the
sha256 of ``<seed>:`` and the doc_id, so that every run and every retry cuts
alike.  The prefix ends after the smaller of ``h1 % (n + 1)`` and
``h2 % (n + 1)`` units, the middle after the larger.

Forms: ``psm`` is prefix, suffix, middle; ``spm`` is suffix, prefix, middle,
each part behind its mark; ``plain`` is the text itself, for texts that are
empty, hold a mark, or aren't drawn.  A mark may not begin with its own end
(such as ``aba``): then the first mark found after a part is always the one
that was written, and :func:`restored_text` gives back the exact text.

Defined cases: null text counts as empty; a null doc_id is drawn as ``<seed>:``
alone; repeated rows each give the same row; extra columns are not read; very
long texts are cut whole; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentio.llm.common import ship_package

MARKS = ("<P>", "<S>", "<M>")  # before prefix, suffix and middle
LINES = r"[^\n]*+\n|[^\n]++"  # a line with its break, or the last one without
SEED = 7
RATE = 100  # per cent of the texts that are transformed
SPM_RATE = 50  # per cent of those that put the suffix first
SCHEMA = "doc_id {id}, n long, form string, prefix_chars long, middle_chars long, output string"


def check_marks(marks) -> None:
    for m in marks:
        if not m or any(m.startswith(m[k:]) for k in range(1, len(m))):
            raise ValueError(f"a mark may not be empty or begin with its own end: {m!r}")
    if any(a in b for i, a in enumerate(marks) for j, b in enumerate(marks) if i != j):
        raise ValueError("a mark may not hold another one")


def unit_pattern(unit: str = LINES):
    import regex
    return regex.compile(f"({unit})*+")


def draws(key: str, seed: int = SEED) -> tuple[int, int, int, int]:
    digest = hashlib.sha256(f"{seed}:{key}".encode()).digest()
    return tuple(int.from_bytes(digest[k:k + 4], "big") for k in (0, 4, 8, 12))


def transform_text(text: str, key: str, pattern, marks=MARKS, seed: int = SEED, rate: int = RATE,
                   spm_rate: int = SPM_RATE) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    match = pattern.fullmatch(text)
    if match is None:
        raise ValueError("the units don't cover the text")
    ends = match.ends(1)
    n = len(ends)
    h1, h2, h3, h4 = draws(key, seed)
    if not text or any(m in text for m in marks) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    a = ends[low - 1] if low else 0
    b = ends[high - 1] if high else 0
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    p, s, m = marks
    if h4 % 100 < spm_rate:
        return n, "spm", a, b - a, f"{s}{suffix}{p}{prefix}{m}{middle}"
    return n, "psm", a, b - a, f"{p}{prefix}{s}{suffix}{m}{middle}"


def fill_in_middle(docs: DataFrame, unit: str = LINES, marks=MARKS, seed: int = SEED, rate: int = RATE,
                   spm_rate: int = SPM_RATE) -> DataFrame:
    """One row per document: n units, form, sizes of prefix and middle (null if plain), output text."""
    check_marks(marks)
    ship_package(docs.sparkSession)

    def run(batches):
        import pyarrow as pa
        pattern = unit_pattern(unit)
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        for b in batches:
            keys, texts = b.column(1).to_pylist(), b.column(2).to_pylist()
            rows = [transform_text(t or "", k or "", pattern, marks, seed, rate, spm_rate)
                    for k, t in zip(keys, texts)]
            columns = list(zip(*rows)) if rows else [()] * 5
            yield pa.record_batch([b.column(0)] + [pa.array(c, k) for c, k in zip(columns, kinds)],
                                  names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("doc_id").cast("string").alias("key"), "text").mapInArrow(
        run, SCHEMA.format(id=kind))


def restored_text(output: Column, form: Column, marks=MARKS) -> Column:
    """The exact text, rebuilt from ``output`` and ``form`` alone."""
    p, s, m = marks

    def parts(first: str, second: str):
        body = output.substr(F.lit(len(first) + 1), F.length(output))
        one = F.substring_index(body, second, 1)
        rest = body.substr(F.length(one) + len(second) + 1, F.length(body))
        two = F.substring_index(rest, m, 1)
        return one, two, rest.substr(F.length(two) + len(m) + 1, F.length(rest))

    prefix, suffix, middle = parts(p, s)
    suffix2, prefix2, middle2 = parts(s, p)
    return (F.when(form == "psm", F.concat(prefix, middle, suffix))
            .when(form == "spm", F.concat(prefix2, middle2, suffix2)).otherwise(output))
