"""Personal data replaced by format-preserving pseudonyms from a keyed Feistel permutation.

Method
------
Numbers and dates in texts are validated (check digits, ranges, calendars) and permuted within their
format: the value is a number below the size of its format, permuted by an eight-round Feistel network whose
round function is a keyed hash, walking on until the result lies in the format again. Separators stay, check
digits are made anew. The permutation depends on the key and the kind alone, so equal values get equal
pseudonyms in all documents, different values different ones.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import TEXT_ROWS, map_arrow

ROUNDS = 8


def permute(value: int, size: int, key: bytes, kind: str, accept: Callable[[int], bool] | None = None) -> int:
    """A keyed permutation of range(size); with ``accept``, of the accepted values among them."""
    if size < 2:
        return value
    half = (max(2, (size - 1).bit_length()) + 1) // 2
    mask = (1 << half) - 1
    tweak = f"{kind}:{size}:".encode()
    while True:
        left, right = value >> half, value & mask
        for r in range(ROUNDS):
            digest = hashlib.blake2b(tweak + bytes([r]) + right.to_bytes((half + 7) // 8, "big"), key=key, digest_size=max(8, (half + 7) // 8)).digest()
            left, right = right, left ^ (int.from_bytes(digest, "big") & mask)
        value = left << half | right
        if value < size and (accept is None or accept(value)):
            return value


def luhn_digit(digits: str) -> str:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _refill(shape: str, fresh: str) -> str:
    """``fresh`` digits in the places of the digits of ``shape``."""
    it = iter(fresh)
    return "".join(next(it) if c.isdigit() else c for c in shape)


def _card(m: re.Match, key: bytes) -> str | None:
    digits = re.sub(r"\D", "", m[0])
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
        return None
    size = 10 ** (len(digits) - 1)
    body = str(permute(int(digits[:-1]), size, key, "card", lambda v: (v < size // 10) == (digits[0] == "0"))).zfill(len(digits) - 1)
    return _refill(m[0], body + luhn_digit(body))


def _iban(m: re.Match, key: bytes) -> str | None:
    plain = m[0].replace(" ", "")
    if not 15 <= len(plain) <= 34 or int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 != 1:
        return None
    size, value = 1, 0
    for c in plain[4:]:
        radix = 10 if c.isdigit() else 26
        size, value = size * radix, value * radix + (int(c) if c.isdigit() else ord(c) - 65)
    value, out = permute(value, size, key, "iban" + plain[:2]), []
    for c in reversed(plain[4:]):
        radix = 10 if c.isdigit() else 26
        value, rest = divmod(value, radix)
        out.append(str(rest) if c.isdigit() else chr(65 + rest))
    body = "".join(reversed(out))
    check = 98 - int("".join(str(int(c, 36)) for c in body + plain[:2] + "00")) % 97
    fresh = iter(f"{plain[:2]}{check:02d}{body}")
    return "".join(c if c == " " else next(fresh) for c in m[0])


def _phone(m: re.Match, key: bytes) -> str | None:
    country = m["na"] or m["nine"] or m["any"] or m["cc"] or ""
    local = m[0][len(country) :]
    digits = re.sub(r"\D", "", local)
    if not 7 <= len(digits) <= (14 if country else 12):
        return None
    size = 10 ** len(digits)
    fresh = str(permute(int(digits), size, key, "phone", lambda v: (str(v).zfill(len(digits))[0] in "01") == (digits[0] in "01"))).zfill(len(digits))
    return country + _refill(local, fresh)


def _address(m: re.Match, key: bytes) -> str | None:
    parts = [int(x) for x in m[0].split(".")]
    if any(p > 255 for p in parts) or parts[0] == 0:
        return None
    value = permute(parts[0] << 24 | parts[1] << 16 | parts[2] << 8 | parts[3], 1 << 32, key, "ip", lambda v: v >> 24 != 0)
    return ".".join(str(value >> s & 255) for s in (24, 16, 8, 0))


def _social(m: re.Match, key: bytes) -> str | None:
    def valid(v: int) -> bool:
        area, pair, serial = v // 1_000_000, v // 10_000 % 100, v % 10_000
        return area not in (0, 666) and area < 900 and pair > 0 and serial > 0

    value = int(m[0].replace("-", ""))
    if not valid(value):
        return None
    return _refill(m[0], str(permute(value, 10**9, key, "social", valid)).zfill(9))


_FIRST, _LAST = dt.date(1900, 1, 1), dt.date(2099, 12, 31)


def _date(m: re.Match, key: bytes) -> str | None:
    a, b, c = (int(x) for x in (m[1], m[3], m[4]))
    year_first = len(m[1]) == 4
    try:
        day = dt.date(a, b, c) if year_first else dt.date(c, b, a)
    except ValueError:
        try:
            day = dt.date(c, a, b)
        except ValueError:
            return None
        order = "mdy"
    else:
        order = "ymd" if year_first else "dmy"
    if not _FIRST <= day <= _LAST:
        return None

    def fits(v: int) -> bool:  # days after the 12th stay so: one pseudonym in every order, and month first never reads as day first
        return ((_FIRST + dt.timedelta(v)).day > 12) == (day.day > 12)

    fresh = _FIRST + dt.timedelta(permute((day - _FIRST).days, (_LAST - _FIRST).days + 1, key, "date", fits))
    fields = {"y": f"{fresh.year:04d}", "m": f"{fresh.month:02d}", "d": f"{fresh.day:02d}"}
    return m[2].join(fields[x] for x in order)


def _email(m: re.Match, key: bytes) -> str | None:
    local, domain = m[0].split("@", 1)
    size, value = 1, 0
    radices = [10 if c.isdigit() else 26 if c.isalpha() else 1 for c in local]
    for c, radix in zip(local, radices, strict=True):
        size, value = size * radix, value * radix + (int(c) if radix == 10 else ord(c.lower()) - 97 if radix == 26 else 0)
    value, out = permute(value, size, key, "email" + "".join(map(str, radices)) + domain.lower()), []
    for c, radix in zip(reversed(local), reversed(radices), strict=True):
        value, rest = divmod(value, radix)
        out.append(str(rest) if radix == 10 else chr((65 if c.isupper() else 97) + rest) if radix == 26 else c)
    return "".join(reversed(out)) + "@" + domain


#: Characters of an IBAN by country (ISO 13616).
_IBAN_LENGTH = {
    **dict.fromkeys(("NO",), 15), **dict.fromkeys(("BE",), 16), **dict.fromkeys(("DK", "FI", "FO", "GL", "NL"), 18), **dict.fromkeys(("MK", "SI"), 19),
    **dict.fromkeys(("AT", "BA", "EE", "KZ", "LT", "LU", "XK"), 20), **dict.fromkeys(("CH", "HR", "LI", "LV"), 21), **dict.fromkeys(("BG", "BH", "CR", "DE", "GB", "GE", "IE", "ME", "RS", "VA"), 22),
    **dict.fromkeys(("AE", "GI", "IL", "IQ", "TL"), 23), **dict.fromkeys(("AD", "CZ", "ES", "MD", "PK", "RO", "SA", "SE", "SK", "TN", "VG"), 24), **dict.fromkeys(("PT", "ST"), 25), **dict.fromkeys(("IS", "TR"), 26),
    **dict.fromkeys(("FR", "GR", "IT", "MC", "MR", "SM"), 27), **dict.fromkeys(("AL", "AZ", "BY", "CY", "DO", "GT", "HU", "LB", "PL", "SV"), 28), **dict.fromkeys(("BR", "PS", "QA", "UA"), 29), **dict.fromkeys(("JO", "KW", "MU"), 30), "MT": 31, "LC": 32,
}
_ALL = re.compile(r".+", re.DOTALL)
_IBAN_RUN = re.compile(r"[A-Z0-9](?: ?[A-Z0-9]){14,33}", re.ASCII)


def _iban_stretches(text: str, m: re.Match) -> Iterator[tuple[int, int]]:
    """From the country code on, up to each group's end: first the country's length, then others, longest first."""
    run = _IBAN_RUN.match(text, m.start())
    if not run:
        return
    ends, n = [], 0
    for k in range(run.start(), run.end()):
        n += text[k] != " "
        if n >= 15 and text[k] != " " and not (text[k + 1 : k + 2].isascii() and (text[k + 1 : k + 2].isalnum() or text[k + 1 : k + 2] == "_")):
            ends.append((n != _IBAN_LENGTH.get(m[0][:2]), -n, k + 1))
    yield from ((m.start(), end) for _, _, end in sorted(ends))


def _card_stretches(text: str, m: re.Match) -> Iterator[tuple[int, int]]:
    """The whole run of digits, then stretches of its groups: of 16 digits first, then longer ones, from left to right.

    A part of a run is tried if its groups have three digits or more and one kind of separator, as on cards; tables of small numbers would
    hold valid check digits everywhere.
    """
    yield m.span()
    groups = [g.span() for g in re.finditer(r"[0-9]+", m[0])]
    found = []
    for i, (start, _) in enumerate(groups):
        n = 0
        for s, e in groups[i:]:
            n += e - s
            if n > 19 or e - s < 3 or len(set(re.sub("[0-9]", "", m[0][start:e]))) > 1:
                break
            if n >= 13:
                found.append((n != 16, -n, m.start() + start, m.start() + e))
    yield from ((s, e) for _, _, s, e in sorted(found))


_STRETCHES = {"iban": _iban_stretches, "card": _card_stretches}

#: Country calling codes, so that a number splits alike with and without separators.
_CALLING = r"\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9]\d{2})"
#: With a plus: North American, nine digits (fr, es), any other grouping. Without: the area in brackets or split off, or pairs.
_PHONE = (
    r"(?<![\d+])(?:"
    r"(?P<na>\+1[ .-]?)\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
    r"|(?P<nine>\+3[34][ .-]?)(?:\(0\)[ .-]?)?[1-9](?:[ .-]?\d){8}(?!\d)"
    rf"|(?P<any>{_CALLING}[ .-]?)(?:\(\d{{1,5}}\) ?)?\d+(?:[ .-]\d{{2,}}){{0,5}}(?!\d)"
    r"|(?P<cc>\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\) ?|\d{2,4}[ .-])\d{3,4}(?:[.-]\d{3,4}(?![.-]?\d)| \d{3,4}(?![ .-]?\d))"
    r"|0[1-9](?:[ .-]\d{2}){4}(?![ .-]?\d))"
)

#: Kind, pattern, what makes the pseudonym (None: not valid, left as it is). Earlier kinds go first.
DETECTORS: tuple[tuple[str, re.Pattern, Callable[[re.Match, bytes], str | None]], ...] = (
    ("email", re.compile(r"\b[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}\b", re.ASCII), _email),
    ("iban", re.compile(r"\b[A-Z]{2}[0-9]{2}(?= ?[A-Z0-9])", re.ASCII), _iban),
    ("ip", re.compile(r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d.]*\d)", re.ASCII), _address),
    ("date", re.compile(r"(?<![\d/.-])(\d{4}|\d{2})([-/.])(\d{2})\2(\d{4}|\d{2})(?![\d/-]|\.\d)", re.ASCII), _date),
    ("social", re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", re.ASCII), _social),
    ("card", re.compile(r"(?<![\d-])\d(?:[ -]?\d){12,}", re.ASCII), _card),
    ("phone", re.compile(_PHONE, re.ASCII), _phone),
)
KINDS = tuple(k for k, _, _ in DETECTORS)


def _matches(kind: str, pattern: re.Pattern, text: str) -> Iterator[re.Match]:
    """Matches of the pattern, or the stretches that each of them may hold instead."""
    for m in pattern.finditer(text):
        if kind == "phone" and m["any"]:  # longer than a number can be: without its last groups
            ends = [m.end(), *(m.start() + g.start() for g in reversed(list(re.finditer("[ .-]", m[0]))))]
            yield next((pattern.fullmatch(text, m.start(), end) for end in ends if sum(c.isdigit() for c in text[m.start() : end]) <= 15), None) or m
        elif kind in _STRETCHES:
            for start, end in _STRETCHES[kind](text, m):
                yield _ALL.fullmatch(text, start, end)
        else:
            yield m


def _goes_on(text: str, m: re.Match) -> bool:
    """Whether a number without plus or bracket is the rest of digits before it."""
    at = m.start()
    if text[at] in "+(" or at < 2 or text[at - 1] not in " .-" or not text[at - 2].isdigit():
        return False
    return text[at - 1] != " " or " " in m[0]


def pseudonymise(text: str, key: bytes) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with pseudonyms in place, and the spans (start, end, kind) in it, in code points."""
    if not any(c in text for c in "0123456789@"):
        return text, []
    taken: list[tuple[int, int, str, str]] = []
    covered = bytearray(len(text))
    for kind, pattern, make in DETECTORS:
        if kind == "email" and "@" not in text:
            continue
        open_text = text
        if kind in ("card", "phone"):  # runs of digits end where another kind begins
            parts, at = [], 0
            for s, e, _, _ in sorted(taken):
                parts += [text[at:s], "\0" * (e - s)]
                at = e
            open_text = "".join([*parts, text[at:]])
        for m in _matches(kind, pattern, open_text):
            if covered.find(1, m.start(), m.end()) >= 0:
                continue
            if kind == "phone" and _goes_on(open_text, m):
                continue
            fresh = make(m, key)
            if fresh is not None:
                taken.append((*m.span(), kind, fresh))
                covered[m.start() : m.end()] = b"\1" * (m.end() - m.start())
    out, at, spans = [], 0, []
    for s, e, kind, fresh in sorted(taken):
        out += [text[at:s], fresh]
        spans.append((s, e, kind))
        at = e
    return "".join([*out, text[at:]]), spans


def replace_personal_data(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``text`` with pseudonyms, ``n_<kind>`` for each kind, ``spans`` (kind:start:end, comma-joined).

    Pseudonyms have the length of what they replace but for IPv4 addresses; spans are of the given text. A null text
    stays null; empty texts stay empty; a null id is kept as a row; repeated rows are handled each and alike; further
    columns are ignored; an empty table gives no rows.
    """
    secret = hashlib.blake2b(key.encode(), digest_size=32).digest()

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, spans = [], []
        counts: dict[str, list[int]] = {k: [] for k in KINDS}
        for text in batch.column(1).to_pylist():
            new, found = (None, []) if text is None else pseudonymise(text, secret)
            texts.append(new)
            for k, out in counts.items():
                out.append(sum(kind == k for _, _, kind in found))
            spans.append(",".join(f"{k}:{s}:{e}" for s, e, k in found))
        columns = [batch.column(0), pa.array(texts, pa.string()), *(pa.array(x, pa.int64()) for x in counts.values()), pa.array(spans, pa.string())]
        return pa.record_batch(columns, names=["id", "text", *(f"n_{k}" for k in KINDS), "spans"])

    schema = f"id {docs.schema[id_col].dataType.simpleString()}, text string, " + ", ".join(f"n_{k} long" for k in KINDS) + ", spans string"
    out = map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), of, schema, TEXT_ROWS)
    return out.withColumnsRenamed({"id": id_col, "text": text_col})

