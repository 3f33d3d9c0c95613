"""Secrets in texts: fixed patterns, and strings of high entropy.

Method
------
Three patterns find assignments, access keys and long hexadecimal strings. Besides them, candidate strings
(long stretches of one character class: hexadecimal, base 36, base 64) are scanned with a sliding window whose
Shannon entropy follows from incremental counts: a step takes one character in and one out and changes the
sum of count times log count by two table entries. A stretch of windows above the class's threshold is a
span, unless the allow-list knows it: identifiers, dates, paths, dictionary-like words, repeats.
"""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import TEXT_ROWS, map_arrow

KINDS = ("assign", "access", "hex", "entropy")
_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_LONG = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
_ASCII_LOWER = {i: i + 32 for i in range(65, 91)}

WINDOW = 20
#: Entropy in bits a character that a window of WINDOW characters needs, by class: near what random strings reach.
CLASSES = (
    ("hex", re.compile(r"[0-9a-fA-F]+"), 3.0),
    ("base36", re.compile(r"[0-9a-z]+|[0-9A-Z]+"), 3.5),
    ("base64", re.compile(r"[A-Za-z0-9+/_=-]+"), 3.8),
)
_ALLOWED = (
    re.compile(r"[0-9-]+"),  # numbers, dates, telephone numbers
    re.compile(r"[A-Za-z]+(?:[-_/][A-Za-z]+)*=*"),  # words and paths of words
    re.compile(r"(?:[A-Za-z]+[-_/])*[A-Za-z]+[0-9]{1,4}"),  # a name with a number
    re.compile(r"[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}", re.IGNORECASE),  # identifiers by the public UUID format
    re.compile(r"(.{1,8})\1{2,}.{0,8}"),  # repeats
)
_CLOG = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]


def entropy_spans(text: str, threshold: float, window: int = WINDOW) -> list[tuple[int, int]]:
    """Merged stretches (start, end) of the windows whose entropy reaches ``threshold`` bits a character."""
    n = len(text)
    if n < window:
        return []
    clog = _CLOG if window == WINDOW else [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    counts: dict[str, int] = {}
    held = 0.0
    found: list[list[int]] = []
    ceiling = window * (math.log2(window) - threshold) + 1e-9
    for i, c in enumerate(text):
        k = counts.get(c, 0)
        counts[c] = k + 1
        held += clog[k + 1] - clog[k]
        if i >= window:
            old = text[i - window]
            k = counts[old]
            counts[old] = k - 1
            held += clog[k - 1] - clog[k]
        if i >= window - 1 and held <= ceiling:
            start = i - window + 1
            if found and start <= found[-1][1]:
                found[-1][1] = i + 1
            else:
                found.append([start, i + 1])
    return [(a, b) for a, b in found]


def _allowed(value: str) -> bool:
    return any(p.fullmatch(value) for p in _ALLOWED) or not (any(c.isdigit() for c in value) and any(c.isalpha() for c in value))


def secret_spans(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Spans (start, end, kind) of the patterns, and those that entropy adds beside them, in code points."""
    base: list[tuple[int, int, str]] = []
    lowered = text.translate(_ASCII_LOWER)
    if any(k in lowered for k in _KEYWORDS):
        base += [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        base += [(*m.span(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    long = [m.span() for m in _LONG.finditer(text)]
    if long:
        base += [(*m.span(), "hex") for m in _HEX.finditer(text)]
    added: list[tuple[int, int, str]] = []
    taken = bytearray(len(text) if long else 0)
    for s, e, _ in base if long else ():
        taken[s:e] = b"\1" * (e - s)
    for a, b in long:
        if _allowed(text[a:b]):
            continue
        for _, shape, threshold in CLASSES:
            for m in shape.finditer(text, a, b):
                if m.end() - m.start() < WINDOW or _allowed(m[0]):
                    continue
                for x, y in entropy_spans(m[0], threshold):
                    x, y = x + m.start(), y + m.start()
                    if taken.find(1, x, y) < 0:
                        added.append((x, y, "entropy"))
                        taken[x:y] = b"\1" * (y - x)
    return base, added


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]))))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256``, ``spans``.

    ``spans`` lists all spans as kind:start:end (code points, end exclusive), by start, then kind. Null and empty
    texts have none (empty strings, the hash of the empty string). A null id is kept; repeated rows are
    scanned each; further columns are ignored; an empty table gives no rows.
    """

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts: dict[str, list[int]] = {k: [] for k in KINDS[:3]}
        digests, spans = [], []
        for text in batch.column(1).to_pylist():
            base, added = secret_spans(text or "")
            for k, out in counts.items():
                out.append(sum(x[2] == k for x in base))
            digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
            spans.append(_joined(base + added))
        columns = [batch.column(0), *(pa.array(x, pa.int64()) for x in counts.values()), pa.array(digests, pa.string()), pa.array(spans, pa.string())]
        return pa.record_batch(columns, names=["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    schema = f"id {docs.schema[id_col].dataType.simpleString()}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), of, schema, TEXT_ROWS).withColumnRenamed("id", id_col)


def redact(text: str, mark: str = "[SECRET]") -> str:
    """The text with each stretch of overlapping spans replaced; of an assignment only the value goes."""
    base, added = secret_spans(text)
    cuts = []
    for s, e, kind in base + added:
        cuts.append((_ASSIGN.match(text, s).start(2) if kind == "assign" else s, e))
    out, at = [], 0
    for s, e in sorted(cuts):
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with secrets replaced in its texts, and the stored length brought up to date where a text changed."""

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = batch.schema.get_field_index(text_col)
        old = batch.column(at).to_pylist()
        new = [t and redact(t) for t in old]
        batch = batch.set_column(at, text_col, pa.array(new, batch.schema.field(at).type))
        if length_col is not None and length_col in batch.schema.names:
            k = batch.schema.get_field_index(length_col)
            lengths = [n if a == b else len(b) for n, a, b in zip(batch.column(k).to_pylist(), old, new, strict=True)]
            batch = batch.set_column(k, length_col, pa.array(lengths, batch.schema.field(k).type))
        return batch

    return map_arrow(docs, of, docs.schema, TEXT_ROWS)
