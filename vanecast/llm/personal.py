"""Personal data by anchor expansion: an Aho-Corasick automaton finds anchors, local parsers do the rest.

Anchors are at-signs, schemes, a plus before a digit, digits, and cue words of identifiers
in three spellings.  One pass over a text reports them in order; at each anchor a parser
walks to the left and to the right as far as the characters of its kind reach, checks what
it has found (parts, digits, check sums) and moves the kind's own border behind it.  So a
kind's spans are the leftmost ones that do not overlap, and no character is walked twice by
a kind, however long its text.  Positions are code points.
"""

from __future__ import annotations

import re
from functools import cache
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Kinds with a contract come first; spans are listed in this order.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "mailbox", "url", "iban", "ssn", "account", "passport", "key", "credential")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
CHAIN = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)++")
DIALLED = re.compile(r"[\x20().0-9-]++")

# what may stand for the at-sign and for the dots after it
AT = ("[at]", "(at)", "{at}", "＠")
SPELLED = re.compile(r"\x20?([A-Za-z0-9-]++(?:(?:\x20?[\[({]dot[\])}]\x20?|\.)[A-Za-z0-9-]++)++)", re.IGNORECASE)
AUTHORITY = re.compile(r"[^\s/?#<>\"']++")
DIALLED_URI = re.compile(r"\+?[0-9](?:[().\x20-]?[0-9])++")

# between a cue and its identifier
GAP = re.compile(r"(?:[\x20\t]?(?:number|nummer|num|no|nr|id|code|is|ist|est|es))?[\x20\t]?[.:#=]?[\x20\t]?[\"']?", re.IGNORECASE)
ASSIGN = re.compile(r"[\"']?[\x20\t]*+[=:][\x20\t]*+[\"']?")
IBAN = re.compile(r"[A-Za-z]{2}[0-9]{2}(?:\x20?[A-Za-z0-9]){11,30}+")
SSN = re.compile(r"([0-9]{3})([\x20-]?)([0-9]{2})\2([0-9]{4})(?![0-9])")
ACCOUNT = re.compile(r"[0-9](?:[\x20/-]?[0-9])++")
PASSPORT = re.compile(r"(?:[A-Z]{1,2}[0-9]{6,8}|[0-9]{9})(?![A-Za-z0-9])")
ACCESS_KEY = re.compile(r"[A-Z0-9]{16}(?![A-Za-z0-9])")
SECRET = re.compile(r"[^\s\"',;]{8,}+")

# cue word: kind of the identifier that follows
CUES = {
    "iban": "iban",
    "ssn": "ssn", "social security": "ssn", "social security number": "ssn",
    "account": "account", "acct": "account", "konto": "account", "kontonummer": "account", "compte": "account", "cuenta": "account",
    "passport": "passport", "reisepass": "passport", "passeport": "passport", "pasaporte": "passport",
    "token": "credential", "password": "credential", "passwd": "credential", "secret": "credential", "api_key": "credential",
    "apikey": "credential", "passwort": "credential", "api-key": "credential", "pwd": "credential",
}
ACCESS_KEYS = ("AKIA", "ASIA")


class Span(NamedTuple):
    kind: str
    start: int
    end: int


@cache
def anchors() -> ahocorasick.Automaton:
    """The automaton of all anchors; a value is the parser's name and the anchor's length."""
    found = ahocorasick.Automaton()
    words = {"@": "email", "://": "url", **{a: "mailbox" for a in AT}, **{k: "key" for k in ACCESS_KEYS}}
    words |= {f"+{d}": "phone" for d in range(10)} | {str(d): "digits" for d in range(10)}
    words |= {s: "dialled" for s in ("tel:", "sms:", "TEL:", "SMS:", "Tel:")}
    for cue, kind in CUES.items():
        words |= {cue: kind, cue.upper(): kind, cue.capitalize(): kind, cue.title(): kind}
    for word, parser in words.items():
        found.add_word(word, (parser, len(word)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number is right."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) << (i & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def iban_valid(code: str) -> bool:
    """ISO 13616: first four characters last, letters as 10 .. 35, remainder 1 by 97."""
    moved = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def ssn_valid(area: str, group: str, serial: str) -> bool:
    return area not in ("000", "666") and area[0] != "9" and group != "00" and serial != "0000"


def _walk_left(text: str, at: int, floor: int, allowed: frozenset) -> int:
    while at > floor and text[at - 1] in allowed:
        at -= 1
    return at


def _alone(text: str, at: int) -> bool:
    """No letter or digit right before a place."""
    return at == 0 or not text[at - 1].isalnum()


class Parsers:
    """Expansion and checks at the anchors of one text; ``border`` is where each kind may start again."""

    def __init__(self, text: str):
        self.text = text
        self.border = dict.fromkeys(KINDS, 0)
        self.found: list[Span] = []

    def keep(self, kind: str, start: int, end: int) -> None:
        if start >= self.border[kind]:
            self.found.append(Span(kind, start, end))
            self.border[kind] = end

    def email(self, start: int, end: int) -> None:
        left = _walk_left(self.text, start, self.border["email"], LOCAL)
        domain = DOMAIN.match(self.text, end) if left < start else None
        if domain:
            self.keep("email", left, domain.end())

    def digits(self, start: int, end: int) -> None:
        """A digit that belongs to no earlier chain of digits or of dotted numbers starts one."""
        if start >= self.border["card"]:
            chain = CHAIN.match(self.text, start)
            self.border["card"] = chain.end() if chain else end
            if chain:
                digits = chain.group().replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and luhn(digits):
                    self.found.append(Span("card", start, chain.end()))
        if start >= self.border["ip"]:
            dotted = DOTTED.match(self.text, start)
            if not dotted:
                # the rest of this number starts no other chain
                while end < len(self.text) and "0" <= self.text[end] <= "9":
                    end += 1
                self.border["ip"] = end
                return
            self.border["ip"] = dotted.end()
            parts, at = dotted.group().split("."), start
            for k in range(0, len(parts) - 3, 4):
                four = parts[k : k + 4]
                size = sum(map(len, four)) + 3
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                    self.found.append(Span("ip", at, at + size))
                at += size + 1

    def phone(self, start: int, end: int) -> None:
        run = DIALLED.match(self.text, end)
        dialled = run.group().rstrip(" ().-") if run else ""
        if len(dialled) >= 2 and 9 <= 1 + sum("0" <= c <= "9" for c in dialled) <= 15:
            self.found.append(Span("phone", start, end + len(dialled)))

    def mailbox(self, start: int, end: int) -> None:
        at = start - 1 if start and self.text[start - 1] == " " else start
        left = _walk_left(self.text, at, self.border["mailbox"], LOCAL)
        domain = SPELLED.match(self.text, end) if left < at else None
        if domain:
            self.keep("mailbox", left, domain.end())

    def url(self, start: int, end: int) -> None:
        """An address that names its user: scheme, user, host."""
        left = _walk_left(self.text, start, self.border["url"], SCHEME)
        while left < start and not self.text[left].isalpha():
            left += 1
        authority = AUTHORITY.match(self.text, end)
        if left == start or not authority:
            return
        user, sign, host = authority.group().rpartition("@")
        if sign and user and host and host[0].isalnum():
            self.keep("url", left, end + len(authority.group().rstrip(".,;:!)]}")))

    def dialled(self, start: int, end: int) -> None:
        number = DIALLED_URI.match(self.text, end)
        if number and _alone(self.text, start) and 7 <= sum(c.isdigit() for c in number.group()) <= 15:
            self.keep("url", start, number.end())

    def key(self, start: int, end: int) -> None:
        rest = ACCESS_KEY.match(self.text, end)
        if rest and _alone(self.text, start):
            self.keep("key", start, rest.end())

    def _after(self, start: int, end: int, pattern: re.Pattern) -> re.Match | None:
        return pattern.match(self.text, GAP.match(self.text, end).end()) if _alone(self.text, start) else None

    def iban(self, start: int, end: int) -> None:
        code = self._after(start, end, IBAN)
        if not code:
            return
        stop = code.end()
        while stop - code.start() >= 15:  # a word after the number may look like its next group
            if stop == len(self.text) or not self.text[stop].isalnum():
                if iban_valid(code.string[code.start() : stop].replace(" ", "")):
                    return self.keep("iban", code.start(), stop)
            stop -= 1

    def ssn(self, start: int, end: int) -> None:
        number = self._after(start, end, SSN)
        if number and ssn_valid(number[1], number[3], number[4]):
            self.keep("ssn", number.start(), number.end())

    def account(self, start: int, end: int) -> None:
        number = self._after(start, end, ACCOUNT)
        if number and 7 <= sum(c.isdigit() for c in number.group()) <= 18:
            self.keep("account", number.start(), number.end())

    def passport(self, start: int, end: int) -> None:
        number = self._after(start, end, PASSPORT)
        if number:
            self.keep("passport", number.start(), number.end())

    def credential(self, start: int, end: int) -> None:
        sign = ASSIGN.match(self.text, end)
        value = SECRET.match(self.text, sign.end()) if sign else None
        if value and any(c.isdigit() for c in value.group()):
            self.keep("credential", value.start(), value.end())


RANK = {kind: i for i, kind in enumerate(KINDS)}


def find_spans(text: str) -> list[Span]:
    """All spans of a text, by kind as listed, then start."""
    parsers = Parsers(text)
    for last, (parser, size) in anchors().iter(text):
        getattr(parsers, parser)(last + 1 - size, last + 1)
    return sorted(parsers.found, key=lambda s: (RANK[s.kind], s.start))


def mask(text: str, spans: list[Span]) -> str:
    """The text with each span, or group of overlapping spans, replaced by the kind of its first."""
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s.start, -s.end)):
        if s.start >= at:
            out += [text[at : s.start], f"[{s.kind.upper()}]"]
        at = max(at, s.end)
    return "".join([*out, text[at:]])


def find_personal(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``spans`` (kind, start, end) and the text with the spans ``masked``.

    Spans are listed by kind in the order of ``KINDS``, then by start, in code points with an
    exclusive end.  Spans of one kind never overlap, those of different kinds may.  Missing and
    empty texts have no spans and an empty masked text.  Repeated rows stay repeated and
    missing ids missing; other columns are not read.
    """
    schema = "id long, spans array<struct<kind: string, start: long, end: long>>, masked string"
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scan(stream):
        for batch in stream:
            spans, masked = [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                found = find_spans(text)
                spans.append([s._asdict() for s in found])
                masked.append(mask(text, found) if found else text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind), pa.array(masked, pa.string())], names=["id", "spans", "masked"])

    plain = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    return plain.mapInArrow(scan, schema).withColumnRenamed("id", id_column)
