"""Personal data: anchors by Aho-Corasick, spans by deterministic local parsers.

One automaton pass over a text in small letters (A-Z only, so places hold) yields the
anchors: at-signs, digits, plus signs, URL schemes and identifier cues in any case.  Each
anchor is handed to a parser that expands left and right from it, validates what it finds
and reads no further than the run of characters it may take.

Base kinds ``email ip card phone`` equal leftmost non-overlapping matches of their
patterns; the parsers use that each pattern's match is fixed by a maximal run around
its anchor, so a text of n characters costs O(n) also where a backtracking search
would be quadratic.  Added kinds: ``address`` (postal: house number, capitalised
words, street suffix), ``url_login`` (user or password inside a URL), ``iban``
(mod-97 checked) and ``account`` (digits after an account, passport or tax cue).

Edge cases: a null or empty text has no spans; repeated rows each get their own row.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import small_batches

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "address", "url_login", "iban", "account")

SCHEMES = ("http://", "https://", "ftp://", "ssh://")
ACCOUNT_CUES = ("account number", "account no", "account:", "acct", "passport", "ssn", "tax id", "routing number")
STREET_CUES = (" Street", " Avenue", " Road", " Boulevard", " Lane", " Drive", " Rue ", "straße", " Calle ")

_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])*")
_PHONE_TAIL = re.compile(r"[ ().0-9-]+")
_USERINFO = re.compile(r"[A-Za-z0-9._~%!$&'*+,;=-]++:[^\s/@:]++@[A-Za-z0-9.-]+")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_ACCOUNT = re.compile(r"\.?(?i: is| number| no\.?)?[ :#=]{1,3}([A-Z]{0,2}[0-9][0-9-]{4,}[0-9])")
_STREET_BEFORE = re.compile(r"(?<![0-9A-Za-z.])([0-9]{1,5}[A-Za-z]?(?: [A-Z][A-Za-z'-]{0,30}){0,4})\Z")
_STREET_AFTER = re.compile(r"(?:,? [0-9]{1,5}[A-Za-z]?)?(?:, [A-Z][A-Za-z'-]{1,30}(?: [A-Z][A-Za-z'-]{1,30})?)?(?: [0-9]{5}(?:-[0-9]{4})?)?")
#: A local part longer than this is read from the run's own start, not by the tail search.
_NEAR = 96

#: An IBAN starts at most so far after its cue, and is no longer than that.
_IBAN_REACH = 64

def folded(text: str) -> str:
    """A-Z in small letters and all else, so also the length, as it is: ``lower`` of bytes is."""
    return text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


_WORDS: dict[str, str] = {"@": "email", "+": "phone", "iban": "iban",
                          **{str(d): "number" for d in range(10)},
                          **{s: "scheme" for s in SCHEMES}, **{folded(s): "street" for s in STREET_CUES},
                          **{c: "account" for c in ACCOUNT_CUES}}


def automaton() -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for word, role in _WORDS.items():
        out.add_word(word, (role, len(word)))
    out.make_automaton()
    return out


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += (d * 2 - 9 if d > 4 else d * 2) if k % 2 else d
    return total % 10 == 0


def _local_start(text: str, at: int, floor: int) -> int:
    """Where the run of local-part characters that ends before ``at`` begins."""
    low = max(floor, at - _NEAR)
    while True:
        m = _LOCAL_END.search(text, low, at) if low < at else None
        if m is None:
            return at
        if m.start() > low or low == floor:
            return m.start()
        low = max(floor, at - 2 * (at - low))


def _iban_ok(value: str) -> bool:
    s = value.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def find_spans(text: str | None, auto: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end), by kind as listed, then by start."""
    if not text:
        return []
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    email_end = run_end = chain_end = phone_end = 0
    for last, (role, size) in auto.iter(folded(text)):
        start, end = last - size + 1, last + 1
        if role == "number":
            if start >= run_end:  # the first digit of a run of digits and dots
                m = _DOTTED.match(text, start)
                run_end = m.end()
                if text.count(".", start, run_end) >= 3:
                    _octets(text, start, run_end, found["ip"])
            if start >= chain_end:
                m = _CHAIN.match(text, start)
                chain_end = m.end()
                if chain_end - start >= 16:
                    digits = m[0].replace(" ", "").replace("-", "")
                    if 16 <= len(digits) <= 19 and luhn(digits):
                        found["card"].append((start, chain_end))
        elif role == "email":
            left = _local_start(text, start, email_end)
            if left < start and (m := _DOMAIN.match(text, end)):
                found["email"].append((left, m.end()))
                email_end = m.end()
        elif role == "phone":
            if start >= phone_end and text[end : end + 1] in tuple("0123456789") and (m := _PHONE_TAIL.match(text, end + 1)):
                tail = m[0].rstrip(" ().-")
                if len(tail) >= 2:
                    phone_end = end + 1 + len(tail)
                    if 8 <= 1 + sum(c.isdigit() for c in tail) <= 15:
                        found["phone"].append((start, phone_end))
        elif role == "scheme":
            if m := _USERINFO.match(text, end):
                found["url_login"].append((start, m.end()))
        elif role == "iban":
            m = _IBAN.search(text, end, end + 2 * _IBAN_REACH)
            if m and m.start() < end + _IBAN_REACH and _iban_ok(m[0]):
                found["iban"].append((m.start(), m.end()))
        elif role == "account":
            if m := _ACCOUNT.match(text, end):
                found["account"].append((m.start(1), m.end(1)))
        elif text[start:end] in STREET_CUES:
            _street(text, start, end, found["address"])
    return [(kind, a, b) for kind in KINDS for a, b in _disjoint(found[kind])]


def _octets(text: str, start: int, end: int, out: list[tuple[int, int]]) -> None:
    """Four dotted numbers at a time, from the left; each match stands or falls by itself."""
    parts = [(m.start(), m.end()) for m in re.compile("[0-9]+").finditer(text, start, end)]
    for k in range(0, len(parts) - 3, 4):
        four = parts[k : k + 4]
        if all(b - a <= 3 and int(text[a:b]) <= 255 or int(text[a:b].lstrip("0")[:4] or 0) <= 255 and len(text[a:b].lstrip("0")) <= 3 for a, b in four):
            out.append((four[0][0], four[3][1]))


def _street(text: str, start: int, end: int, out: list[tuple[int, int]]) -> None:
    after = text[end : end + 1]
    cue = text[start:end]
    if cue in (" Rue ", " Calle "):
        m = re.compile(r"(?:[A-Z][A-Za-z'-]{0,30})(?: [A-Z][A-Za-z'-]{0,30}){0,3},? [0-9]{1,5}").match(text, end, end + 160)
        if m:
            out.append((start + 1, m.end()))
        return
    if after.isalpha():
        return
    if cue == "straße":
        left = re.compile(r"[A-ZÄÖÜ][a-zäöüß]{0,30}\Z").search(text, max(0, start - 40), start)
        right = re.compile(r" [0-9]{1,5}[a-z]?(?![0-9])").match(text, end)
        if left and right:
            out.append((left.start(), right.end()))
        return
    left = _STREET_BEFORE.search(text, max(0, start - 160), start)
    if left and " " in left[1]:
        right = _STREET_AFTER.match(text, end)
        out.append((left.start(), right.end() if right else end))


def _disjoint(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if not out or a >= out[-1][1]:
            out.append((a, b))
    return out


def joined(spans: Iterable[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ``spans`` array<struct<kind, start, end>>,
    the digest ``base_sha256`` and counts ``n_<kind>`` of the base kinds.  A narrow scan of
    two columns without shuffle."""
    small_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    fields = [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = automaton()
        for batch in batches:
            found = [find_spans(t, auto) for t in batch.column(1).to_pylist()]
            base = [[s for s in f if s[0] in BASE] for f in found]
            counts = [pa.array([sum(s[0] == k for s in f) for f in base], pa.int64()) for k in BASE]
            spans = pa.array([[dict(zip(("kind", "start", "end"), s)) for s in f] for f in found], pa.list_(pa.struct(fields)))
            sha = pa.array([hashlib.sha256(joined(f).encode()).hexdigest() for f in base])
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, sha, spans],
                                             [id_col, *(f"n_{k}" for k in BASE), "base_sha256", "spans"])

    schema = (f"`{id_col}` {id_type}, " + ", ".join(f"n_{k} bigint" for k in BASE)
              + ", base_sha256 string, spans array<struct<kind: string, start: int, end: int>>")
    return docs.select(id_col, text_col).mapInArrow(scan, schema)
