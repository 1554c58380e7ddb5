"""Personal data by anchor expansion.

One Aho-Corasick automaton runs over a text and reports anchors: at-signs,
schemes, plus signs, digits and identifier cues (words for accounts and
streets). A small parser at each anchor expands to the left and to the right
and validates what it found. Nothing else of the text is looked at twice.

Base kinds (leftmost, non-overlapping within their kind, failing ones dropped):
``email``, ``ip`` (parts up to 255), ``card`` (16 to 19 digits passing Luhn) and
``phone`` (8 to 15 digits). The method adds spans the base kinds miss:

* ``account``: the value after an account or secret cue (IBANs are checked);
* ``address``: house number and street around a street word;
* ``email_ext``: a mailbox whose local part has letters beyond ASCII;
* ``url_auth``: user and password inside a URL.

Positions are code points, the end is exclusive. Null and empty texts have no
spans; repeated rows give repeated rows; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.textops import map_batches, texts_of

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("account", "address", "email_ext", "url_auth")

#: words before an account number or a secret
ACCOUNT_CUES = ("account", "acct", "iban", "konto", "compte", "cuenta", "passport", "password", "secret", "token",
                "api_key", "apikey", "ssn")
#: street words, before or after the house number
STREET_CUES = ("street", "road", "avenue", "lane", "boulevard", "straße", "strasse", "calle", "rue")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_VALUE = re.compile(r"(?:\s{1,2}(?:number|no\.?|nr\.?))?\s{0,2}[:=#]?\s{0,2}[\"']?"
                    r"([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?|[A-Za-z0-9](?:-*+[A-Za-z0-9])*+)(?![A-Za-z0-9])")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}")
_NUMBER = re.compile(r"(?<![\w.])[0-9]{1,5}[A-Za-z]?,?\Z")
_NAME = re.compile(r"[^\W\d_][\w.'-]*+\Z")
_NUMBER_RIGHT = re.compile(r"(?:\s[^\W\d_][\w.'-]*+){0,3}?,?\s[0-9]{1,5}[A-Za-z]?(?![\w.])")
_USERINFO = re.compile(r"[^\s/?#@:]++:[^\s/?#@]++@[^\s/?#]+")
#: characters of the shortest value after an account cue, and names between house number and street word
LEAST_VALUE, STREET_NAMES = 8, 3
_DIGITS = frozenset("0123456789")

Span = tuple[str, int, int]


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for digit in "0123456789":
        found.add_word(digit, ("digit", 1))
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    found.add_word("://", ("scheme", 3))
    for kind, cues in (("account", ACCOUNT_CUES), ("street", STREET_CUES)):
        for cue in cues:
            for form in {cue, cue.upper(), cue.capitalize()}:
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _valid_ip(text: str) -> bool:
    return all(len(p) <= 3 and int(p or "0") <= 255 for p in (q.lstrip("0") for q in text.split(".")))


def _valid_account(value: str) -> bool:
    """Identifiers have ``LEAST_VALUE`` characters and four digits at least, and no
    greatest length; what looks like an IBAN must pass its check digits instead."""
    bare = value.replace(" ", "").replace("-", "")
    if _IBAN.fullmatch(bare):
        return int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97 == 1
    return " " not in value and len(value) >= LEAST_VALUE and sum(c in _DIGITS for c in bare) >= 4


def _number_left(text: str, end: int) -> int | None:
    """Where the house number begins that stands before ``end``, with up to
    ``STREET_NAMES`` names of any length between, each followed by one blank."""
    for _ in range(STREET_NAMES + 1):
        if not end or not text[end - 1].isspace():
            return None
        lo = stop = end - 1
        while lo and not text[lo - 1].isspace():
            lo -= 1
        if m := _NUMBER.search(text, max(lo, stop - 7), stop):
            return m.start()
        if not _NAME.match(text, lo, stop):
            return None
        end = lo
    return None


class Finder:
    """All spans of a text, in one pass over its anchors."""

    def __init__(self):
        self.anchors = _automaton()

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """(base spans, added spans), each by kind as listed, then start."""
        found: dict[str, list[tuple[int, int]]] = {k: [] for k in (*BASE_KINDS, *ADDED_KINDS)}
        end_email = end_ip = end_card = end_phone = 0
        last_digit = -2
        for at, (kind, size) in self.anchors.iter(text):
            if kind == "digit":
                run_start, last_digit = at != last_digit + 1, at
                if not run_start:
                    continue
                if at >= end_ip and (m := _IP.match(text, at)):
                    end_ip = m.end()
                    if _valid_ip(m.group()):
                        found["ip"].append(m.span())
                if at >= end_card and (m := _CARD.match(text, at)):
                    end_card = m.end()
                    digits = m.group().replace(" ", "").replace("-", "")
                    if 16 <= len(digits) <= 19 and luhn(digits):
                        found["card"].append(m.span())
            elif kind == "at":
                lo = at
                while lo > end_email and text[lo - 1] in _LOCAL:
                    lo -= 1
                if not (m := _DOMAIN.match(text, at + 1)):
                    continue
                wide = lo
                while wide > end_email and (text[wide - 1] in _LOCAL or (text[wide - 1] > "\x7f" and text[wide - 1].isalnum())):
                    wide -= 1
                if lo < at:
                    found["email"].append((lo, m.end()))
                if wide < lo:
                    found["email_ext"].append((wide, m.end()))
                if lo < at:
                    end_email = m.end()
            elif kind == "plus":
                if at >= end_phone and (m := _PHONE.match(text, at)):
                    end_phone = m.end()
                    if 8 <= sum(c in _DIGITS for c in m.group()) <= 15:
                        found["phone"].append(m.span())
            elif kind == "account":
                if not text[at - size:at - size + 1].isalnum() or at < size:
                    m = _VALUE.match(text, at + 1)
                    if m and _valid_account(m.group(1)):
                        found["account"].append(m.span(1))
            elif kind == "street":
                lo = at - size + 1
                left = _number_left(text, lo)
                right = None if left is not None else _NUMBER_RIGHT.match(text, at + 1)
                if left is not None and not text[at + 1:at + 2].isalnum():
                    found["address"].append((left, at + 1))
                elif right:
                    while lo and (text[lo - 1].isalpha() or text[lo - 1] == "-"):
                        lo -= 1
                    found["address"].append((lo, right.end()))
            else:
                m = _USERINFO.match(text, at + 1)
                if m:
                    found["url_auth"].append((at + 1, m.group().rindex("@") + at + 1))
        for kind in ADDED_KINDS:
            found[kind] = sorted(set(found[kind]))
        flat = lambda kinds: [(k, *s) for k in kinds for s in found[k]]
        return flat(BASE_KINDS), flat(ADDED_KINDS)


_FINDER: list[Finder] = []


def finder() -> Finder:
    if not _FINDER:
        _FINDER.append(Finder())
    return _FINDER[0]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find(docs: DataFrame) -> DataFrame:
    """Spans of every whole text: counts and digest of the base kinds, then all
    spans as ``kind:start:end``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = finder().spans
        for b in batches:
            n = {k: [] for k in BASE_KINDS}
            digest, every = [], []
            for text in texts_of(b):
                base, added = spans(text)
                for k in BASE_KINDS:
                    n[k].append(sum(s[0] == k for s in base))
                digest.append(hashlib.sha256(joined(base).encode()).hexdigest())
                every.append(joined(base + added))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(n[k], pa.int64()) for k in BASE_KINDS), pa.array(digest, pa.string()),
                 pa.array(every, pa.string())],
                ["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans"])

    return map_batches(docs.select("doc_id", "text"), run,
                       "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span (overlapping ones as one, named after the first)
    replaced by ``[KIND]``."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of every text replaced and n_chars counted anew.

    All rows and columns stay; a null text stays null (n_chars as given)."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = finder().spans
        for b in batches:
            out = []
            for text in b.column("text").to_pylist():
                if text is not None:
                    base, added = spans(text)
                    text = redacted(text, base + added)
                out.append(text)
            at = b.schema.get_field_index("text")
            yield b.set_column(at, b.schema.field(at), pa.array(out, b.schema.field(at).type))

    out = map_batches(docs, run, schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))
    return out.select(*docs.columns)
