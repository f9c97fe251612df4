"""Secrets in texts: certain ones by form, uncertain ones by the parts of a credential.

A credential has an identifier, a secret and often an endpoint. Base kinds are reported
wherever they stand. Weak candidates (an opaque token, a user name, an endpoint) say
nothing alone; they are reported when parts that complete them lie within reach in the
same scope. A scope is a paragraph: text between empty lines.

Kinds, in the order used for equal starts:

* assign, access, hex: see BASE; assign and hex are secrets, access is an identifier.
* opaque (weak secret): 20 or more letters, digits and +/_- with a capital, a small letter,
  a digit and enough different characters; reported with an identifier in reach.
* user (weak identifier): a named user, login, client or account; with a secret in reach.
* endpoint (weak): a URL; with an identifier and a secret in reach.

Intervals are joined by bisection on their sorted starts, so each candidate looks at its
neighbours only, however many parts a text has.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestay.llm.batches import as_bytes, prepare, slices
from lakestay.llm.words import LOWER

# The base patterns. Matches that fail the length are dropped, not retried.
BASE = {
    "assign": re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.IGNORECASE | re.ASCII,
    ),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}
LEAST = {"assign": 8, "access": 16, "hex": 32}

WEAK = {
    "opaque": re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}"),
    "user": re.compile(
        r"""(?:user(?:_?name)?|login|client_?id|account(?:_?id)?)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]{3,}+)""",
        re.IGNORECASE | re.ASCII,
    ),
    "endpoint": re.compile(r"""https?://[^\s"'<>]{4,}+""", re.ASCII),
}
KINDS = ("assign", "access", "hex", "opaque", "user", "endpoint")
_ENTROPY = 3.0

_NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_EMPTY_LINE = re.compile(r"\n[ \t\r]*\n")
_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdef")] = True
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
SPANS_TYPE = "array<struct<kind:string,start:bigint,end:bigint>>"


class Span(NamedTuple):
    kind: str
    start: int
    end: int


def base_spans(text: str) -> list[Span]:
    """All base matches, by start and then kind."""
    found = []
    for kind, pattern in BASE.items():
        if kind == "hex":  # as a run of any length would be found and dropped if short
            pattern = _LONG_HEX
        for m in pattern.finditer(text):
            if len(m[m.lastindex or 0]) >= LEAST[kind]:
                found.append(Span(kind, m.start(), m.end()))
    return sorted(found, key=_order)


_LONG_HEX = re.compile(r"[0-9a-f]{32,}+")


def _order(span: Span) -> tuple[int, int]:
    return span.start, KINDS.index(span.kind)


class _Near:
    """Intervals of one role, asked for those in reach of another in its scope."""

    def __init__(self, spans: list[Span], breaks: list[int]):
        self.spans = sorted(spans, key=lambda s: s.start)
        self.starts = [s.start for s in self.spans]
        self.breaks = breaks

    def reaches(self, span: Span) -> bool:
        """Whether any interval is in reach, does not overlap, and no empty line is between."""
        at = bisect_left(self.starts, span.start)
        right = bisect_left(self.starts, span.end, at)
        if right < len(self.spans) and self._joined(span.end, self.spans[right].start):
            return True
        # To the left the nearest that ends before the span; equal kinds do not overlap, so
        # only the few intervals of other kinds around it are passed over.
        k = at - 1
        while k >= 0 and self.spans[k].end > span.start:
            k -= 1
        return k >= 0 and self._joined(self.spans[k].end, span.start)

    def _joined(self, a: int, b: int) -> bool:
        return bisect_left(self.breaks, a) == bisect_left(self.breaks, b)


def _opaque(token: str) -> bool:
    if not (re.search("[A-Z]", token) and re.search("[a-z]", token) and re.search("[0-9]", token)):
        return False
    n = len(token)
    return -sum(c / n * math.log2(c / n) for c in Counter(token).values()) >= _ENTROPY


def find_secrets(text: str) -> list[Span]:
    """Base spans and linked weak ones, by start and then kind."""
    base = base_spans(text)
    taken = _Merged(base)
    users = [s for s in _weak(text, "user") if not taken.overlaps(s)]
    identifiers = [s for s in base if s.kind == "access"] + users
    if not identifiers:
        return base
    breaks = [m.start() for m in _EMPTY_LINE.finditer(text)]
    near_id = _Near(identifiers, breaks)
    opaque = [
        s for s in _weak(text, "opaque")
        if not taken.overlaps(s) and _opaque(text[s.start : s.end]) and near_id.reaches(s)
    ]
    secrets = [s for s in base if s.kind != "access"] + opaque
    near_secret = _Near(secrets, breaks)
    ends = [s for s in _weak(text, "endpoint") if near_id.reaches(s) and near_secret.reaches(s)]
    return sorted([*base, *opaque, *(s for s in users if near_secret.reaches(s)), *ends], key=_order)


def _weak(text: str, kind: str) -> list[Span]:
    return [Span(kind, m.start(), m.end()) for m in WEAK[kind].finditer(text)]


class _Merged:
    """The union of intervals."""

    def __init__(self, spans: list[Span]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for s in sorted(spans, key=lambda s: s.start):
            if self.ends and s.start <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], s.end)
            else:
                self.starts.append(s.start)
                self.ends.append(s.end)

    def overlaps(self, span: Span) -> bool:
        at = bisect_left(self.starts, span.end) - 1
        return at >= 0 and self.ends[at] > span.start


def scan(texts: pa.Array) -> list[list[Span]]:
    """The spans of each text. Most texts hold no sign of a secret and are not decoded."""
    data, offsets = as_bytes(texts)
    rows = len(offsets) - 1
    low, raw = LOWER[data].tobytes(), data.tobytes()
    others = np.flatnonzero(~np.concatenate([[False], _HEX[data], [False]]))
    runs = np.flatnonzero(np.diff(others) > LEAST["hex"])
    # A run may cross rows; all it touches are looked at.
    hexed: set[int] = set()
    for a, b in zip(others[runs].tolist(), (others[runs + 1] - 2).tolist()):
        hexed.update(range(np.searchsorted(offsets, a, side="right") - 1, np.searchsorted(offsets, b, side="right")))
    out: list[list[Span]] = []
    for r, (a, b) in enumerate(zip(offsets.tolist(), offsets[1:].tolist())):
        if r in hexed or raw.find(b"AKIA", a, b) >= 0 or any(low.find(n, a, b) >= 0 for n in _NAMES):
            out.append(find_secrets(raw[a:b].decode()))
        elif any(low.find(n, a, b) >= 0 for n in (b"user", b"login", b"client", b"account")):
            out.append(find_secrets(raw[a:b].decode()))
        else:
            out.append([])
    return out


def secrets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and spans (kind, start, end in code points, end exclusive) of every row.

    Rows without secrets, with null or empty text have an empty list; null ids and repeated
    rows are kept. Other columns are neither read nor kept. No shuffle.
    """
    prepare(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("spans", _SPANS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            spans = [[s._asdict() for s in own] for own in scan(part.column("text"))]
            columns = [part.column("doc_id"), pa.array(spans, _SPANS)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    own = docs.select(docs[id_column].cast("bigint").alias("doc_id"), docs[text_column].alias("text"))
    return own.mapInArrow(run, f"doc_id bigint, spans {SPANS_TYPE}")


def redact_text(text: str, spans: list[Span], mark: str) -> str:
    """The text with each stretch covered by spans replaced by the mark."""
    merged = _Merged(spans)
    parts, at = [], 0
    for start, end in zip(merged.starts, merged.ends):
        parts += [text[at:start], mark]
        at = end
    return "".join([*parts, text[at:]])


def redact(
    docs: DataFrame, mark: str = "[REDACTED]", text_column: str = "text", length_column: str | None = "n_chars"
) -> DataFrame:
    """All rows and columns, secrets replaced; length_column, if there, follows the new text.

    Texts without secrets, and their lengths, stay as they are.
    """
    prepare(docs.sparkSession)
    counted = length_column if length_column in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_column):
            texts = part.column(text_column)
            found = {r: own for r, own in enumerate(scan(texts)) if own}
            if found:
                new = texts.to_pylist()
                for r, own in found.items():
                    new[r] = redact_text(new[r], own, mark)
                part = _replaced(part, text_column, pa.array(new, texts.type))
                if counted:
                    changed = pa.array([r in found for r in range(part.num_rows)])
                    old = part.column(counted)
                    lengths = pc.utf8_length(part.column(text_column)).cast(old.type)
                    part = _replaced(part, counted, pc.if_else(changed, lengths, old))
            yield part

    return docs.mapInArrow(run, docs.schema)


def _replaced(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    return batch.set_column(batch.schema.get_field_index(name), name, column)


def spans_text(spans: Column) -> Column:
    """kind:start:end of spans in their order, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts and digests of secrets(): one row for each row found."""
    spans = F.col("spans")

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s.kind == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter(spans, lambda s: s.kind.isin(*BASE))
    return found.select(
        "doc_id", *[count(kind) for kind in BASE], F.sha2(spans_text(base).cast("binary"), 256).alias("base_sha256"),
        spans_text(spans).alias("spans"),
    )
