"""Secrets in texts: three patterns, and windows of high Shannon entropy in candidate strings.

A candidate is a maximal run of at least ``WINDOW`` characters of one class. A
window slides over it; the sum of ``c log c`` over the window's character counts
is kept by one subtraction and one addition a step. Windows at or above the
class's threshold are joined to spans, less what a pattern found already, unless
the allow-list explains them.
"""

from __future__ import annotations

import re
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from squadweave.llm.common import byte_table, text_slices, word_spans

KINDS = ("assign", "access", "hex", "entropy")

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")

WINDOW = 20
# Character class, and the entropy in bits a character that makes a window suspect: of 4 at most for hexadecimal
# digits, and of log2(20) = 4.32 at most for the others. Words of any language stay below the second.
CLASSES = (
    (re.compile(r"[0-9A-F]{20,}|[0-9a-f]{20,}"), 3.0),
    (re.compile(r"[A-Za-z0-9+/_=-]{20,}"), 3.85),
)
# What looks random and is no secret: unmixed letters or digits, identifiers, paths.
ALLOWED = (
    r"[A-Za-z_=/+-]*",
    r"[0-9_=/+-]*",
    r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
    r"(?:[A-Za-z]{2,}[0-9]{0,4}|[0-9]{1,4})(?:[/_=+-]+(?:[A-Za-z]{2,}[0-9]{0,4}|[0-9]{1,4}))+",
)
# Inside a span, these mark counted-up alphabets and made-up examples; a plain word between slashes only names a place.
MARKS = r"0123456789|abcdefghij|ABCDEFGHIJ|EXAMPLE|example|sample|xxxxx"
_PLACE = re.compile(r"(?:(?:[A-Z]?[a-z]++|[A-Z]++)?+[0-9]{0,4}+(?:[_+-]++|\Z))*+")

_CANDIDATE = byte_table(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")
_KEYWORDS = (b"passw", b"secret", b"token", b"api")
_CLOGC = [0.0] + [c * log2(c) for c in range(1, WINDOW + 1)]


def high_entropy(text: str, threshold: float, window: int = WINDOW) -> list[tuple[int, int]]:
    """Spans of ``text`` covered by windows whose entropy reaches ``threshold``."""
    counts: dict[str, int] = {}
    total, found = 0.0, []
    limit = window * (log2(window) - threshold) + 1e-9
    for at, char in enumerate(text):
        c = counts.get(char, 0)
        counts[char] = c + 1
        total += _CLOGC[c + 1] - _CLOGC[c]
        if at >= window:
            gone = text[at - window]
            c = counts[gone]
            counts[gone] = c - 1
            total += _CLOGC[c - 1] - _CLOGC[c]
        if at >= window - 1 and total <= limit:
            if found and found[-1][1] >= at - window + 1:
                found[-1] = (found[-1][0], at + 1)
            else:
                found.append((at - window + 1, at + 1))
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the three patterns find."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    return sorted(found + [(m.start(), 2, m.end()) for m in HEX.finditer(text)])


def outside(span: tuple[int, int], taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The parts of ``span`` of at least ``WINDOW`` characters that no range in ``taken`` covers."""
    parts, at = [], span[0]
    for start, end in sorted(taken):
        if start < span[1] and end > at:
            parts.append((at, start))
            at = end
    return [(a, b) for a, b in [*parts, (at, span[1])] if b - a >= WINDOW]


def made_up(text: str, marks: re.Pattern) -> bool:
    """Whether a part between slashes or equals signs that is more than a plain word bears a mark."""
    return bool(marks.search(text)) and any(marks.search(x) and not _PLACE.fullmatch(x) for x in re.split("[/=]", text))


def entropy_spans(
    text: str, taken: list[tuple[int, int, int]], allowed: re.Pattern, marks: re.Pattern
) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what suspect windows cover outside the spans in ``taken``; overlapping ones of both classes are one."""
    covered = [(start, end) for start, _, end in taken]
    spans = []
    for candidates, threshold in CLASSES:
        for m in candidates.finditer(text):
            if allowed.fullmatch(m[0]):
                continue
            for a, b in high_entropy(m[0], threshold):
                for start, end in outside((m.start() + a, m.start() + b), covered):
                    if not allowed.fullmatch(text, start, end) and not made_up(text[start:end], marks):
                        spans.append((start, end))
    found: list[tuple[int, int, int]] = []
    for start, end in sorted(spans):
        if found and start < found[-1][2]:
            found[-1] = (found[-1][0], 3, max(end, found[-1][2]))
        else:
            found.append((start, 3, end))
    return found


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def suspects(column: pa.Array) -> np.ndarray:
    """Rows that may hold any span: a candidate run or a keyword. What is left out holds none."""
    flagged = np.zeros(len(column), bool)
    for low, _, raw, offsets in text_slices(column):
        starts, ends, _ = word_spans(raw, offsets, _CANDIDATE)
        places = [starts[ends - starts >= WINDOW]]
        lowered = raw.tobytes().lower()
        for word in _KEYWORDS:
            at = lowered.find(word)
            while at >= 0:
                places.append(np.array([at]))
                at = lowered.find(word, at + 1)
        flagged[low + np.searchsorted(offsets, np.concatenate(places), "right") - 1] = True
    return flagged


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    allowed: tuple[str, ...] = ALLOWED,
    marks: str = MARKS,
) -> DataFrame:
    """One row per document: counts of the three patterns, ``base_spans`` and ``spans``.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and
    then kind, joined by commas. Base spans always stay; an entropy span never
    overlaps another one: of a span that meets a base span, the parts of at least
    ``WINDOW`` characters beside it stay. ``allowed`` suppresses entropy spans
    whose candidate or span it matches whole, ``marks`` those in which it occurs
    other than as a plain word between slashes. Null and empty texts have none; repeated rows
    and null ids pass through; other columns are not read. Every text is
    scanned whole and alone, so nothing is shuffled or shared.
    """
    pattern = "|".join(f"(?:{x})" for x in allowed)

    def run(batches):
        allow = re.compile(pattern if pattern else r"(?!)", re.DOTALL)
        mark = re.compile(marks if marks else r"(?!)")
        for batch in batches:
            texts = batch.column(1)
            counts = np.zeros((3, len(texts)), np.int64)
            base, every = [""] * len(texts), [""] * len(texts)
            for row in np.flatnonzero(suspects(texts)).tolist():
                text = texts[row].as_py() or ""
                found = base_spans(text)
                for _, kind, _ in found:
                    counts[kind, row] += 1
                base[row] = joined(found)
                every[row] = joined(sorted(found + entropy_spans(text, found, allow, mark)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, counts), pa.array(base, pa.string()), pa.array(every, pa.string())],
                [id_col, "n_assign", "n_access", "n_hex", "base_spans", "spans"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(
        run, f"`{id_col}` {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_spans string, spans string"
    )


def masked(docs: DataFrame, found: str = "spans", text_col: str = "text", mask: str = "[secret]") -> DataFrame:
    """``docs``, which hold ``scan``'s spans in ``found``, with every span's text replaced; native expressions only."""
    spans = F.transform(
        F.filter(F.split(F.coalesce(F.col(found), F.lit("")), ","), lambda x: x != ""),
        lambda x: F.struct(
            F.split(x, ":")[1].cast("int").alias("a"), F.split(x, ":")[2].cast("int").alias("b")
        ),
    )
    start = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))
    text = F.coalesce(F.col(text_col), F.lit(""))

    def step(done, span):
        fresh = span["b"] > done["at"]
        before = F.substring(text, done["at"] + 1, F.greatest(span["a"] - done["at"], F.lit(0)))
        return F.struct(
            F.when(fresh, F.concat(done["done"], before, F.lit(mask))).otherwise(done["done"]).alias("done"),
            F.greatest(done["at"], span["b"]).alias("at"),
        )

    rest = F.aggregate(spans, start, step)
    return docs.withColumn(
        text_col,
        F.when(F.col(text_col).isNull(), F.lit(None)).otherwise(
            F.concat(rest["done"], F.substring(text, rest["at"] + 1, F.length(text)))
        ),
    )
