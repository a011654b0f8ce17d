"""Find personal data, also where it is disguised, at its place in the source text.

Plain identifiers are found in the text as it is.  Then a chain of transducers rewrites the
text: look-alike characters to plain ones, "(at)" to its sign, spelled digits to digits, bare
"at" and "dot" to their signs.  Each keeps, for every character it writes, the source characters it stands for, so
what is found in the rewritten text is mapped back.  Spans found this way are added.
"""

from __future__ import annotations

import hashlib
import html
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lanewatch.llm.common import text_of

KINDS = ("email", "ip", "card", "phone")

Span = tuple[str, int, int]

# --- plain identifiers -----------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match begins where a run of digits does: inside a run it would fail in the same way.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches, from the at signs outwards, in one pass however long the text."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield "email", start, end
        at = text.find("@", max(at + 1, end))


def plain_spans(text: str) -> list[Span]:
    """Identifiers of the four kinds, leftmost and without overlap within a kind."""
    found = list(_emails(text)) if "@" in text else []
    for match in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part[-4:]) <= 255
               for part in match[0].split(".")):
            found.append(("ip", *match.span()))
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 14:
            digits = _NOT_DIGIT.sub("", match[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *match.span()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", match[0])) <= 15:
                found.append(("phone", *match.span()))
    return sorted(found, key=_order)


def _order(span: Span) -> tuple[int, int, int]:
    return span[1], KINDS.index(span[0]), span[2]


# --- transducers -----------------------------------------------------------------------

# Letters of other scripts that look like Latin ones, and signs.
LOOK_ALIKES = dict(zip(
    "аеорсухіјѕԁһӏАВЕКМНОРСТУХІЈЅαοινρτκΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
    "aeopcyxijsdhlABEKMHOPCTYXIJSaoivptkABEZHIKMNOPTYX"))
SIGNS = dict(zip("\ufe6b\u2024\u3002\u2010\u2011\u2012\u2013\u2014\u2015\u2212\ufe62", "@..------+"))
INVISIBLE = "\u200b\u200c\u200d\u2060\ufeff\u00ad"
BLANKS = "\u00a0\u2003\u2007\u2009\u202f"

# The digits' names in the four languages of the corpus.
DIGIT_NAMES = {
    "0": "zero oh null zéro cero", "1": "one eins un uno", "2": "two zwei zwo deux dos",
    "3": "three drei trois tres", "4": "four vier quatre cuatro", "5": "five fünf cinq cinco",
    "6": "six sechs seis", "7": "seven sieben sept siete", "8": "eight acht huit ocho",
    "9": "nine neun neuf nueve",
}
_DIGIT_OF = {name: digit for digit, names in DIGIT_NAMES.items() for name in names.split()}


@dataclass
class Mapped:
    """A text, and for each of its characters the source characters it stands for."""

    text: str
    starts: list[int]
    ends: list[int]

    @classmethod
    def of(cls, text: str) -> Mapped:
        return cls(text, list(range(len(text))), list(range(1, len(text) + 1)))

    def source(self, start: int, end: int) -> tuple[int, int]:
        return self.starts[start], self.ends[end - 1]

    def rewritten(self, changes: list[tuple[int, int, str]]) -> Mapped:
        """With each range replaced; a new character stands for the whole range."""
        text, starts, ends, at = [], [], [], 0
        for low, high, new in changes:
            text += [self.text[at:low], new]
            starts += self.starts[at:low] + [self.starts[low]] * len(new)
            ends += self.ends[at:low] + [self.ends[high - 1]] * len(new)
            at = high
        text.append(self.text[at:])
        return Mapped("".join(text), starts + self.starts[at:], ends + self.ends[at:])


def _plain_character(c: str) -> str:
    if c in INVISIBLE:
        return ""
    if c in BLANKS:
        return " "
    if 0xFF01 <= ord(c) <= 0xFF5E:
        return chr(ord(c) - 0xFEE0)
    digit = unicodedata.decimal(c, None)
    if digit is not None:
        return str(digit)
    return LOOK_ALIKES.get(c) or SIGNS.get(c, c)


# Whatever _plain_character may change: wide forms, listed signs, other scripts' digits.
_STRANGE = re.compile(
    "[" + re.escape("".join([*LOOK_ALIKES, *SIGNS, INVISIBLE, BLANKS])) + r"\uff01-\uff5e]|(?![0-9])\d")


def look_alikes(mapped: Mapped) -> Mapped:
    """Look-alikes to plain characters, but letters only within words that hold plain ones.

    A word all in another script stays: it is a word of that script.
    """
    changes = []
    for match in re.finditer(r"\S+", mapped.text):
        word = match[0]
        if not _STRANGE.search(word):
            continue
        foreign = not re.search(r"[A-Za-z0-9@\uff01-\uff5e\u200b-\u200d]", word)
        for k, c in enumerate(word):
            new = _plain_character(c)
            if new != c and not (foreign and c in LOOK_ALIKES):
                changes.append((match.start() + k, match.start() + k + 1, new))
    for match in re.finditer("[" + re.escape(BLANKS) + "]", mapped.text):
        changes.append((match.start(), match.end(), " "))
    return mapped.rewritten(sorted(dict.fromkeys(changes)))


# Character references of the two signs.
_REFERENCE = re.compile(r"&#0*+(?:64|46);|&#x0*+(?:40|2e);|&(?:commat|period);", re.I)


def character_references(mapped: Mapped) -> Mapped:
    """Character references of "@" and "." to these."""
    changes = [(m.start(), m.end(), html.unescape(m[0].lower())) for m in _REFERENCE.finditer(mapped.text)]
    return mapped.rewritten(changes) if changes else mapped


_BRACKETED = re.compile(
    r"(?<!\s)\s*+[(\[{<]\s*+(at|dot|punkt|point|punto|arroba)\s*+[)\]}>]\s*+", re.I)


def bracketed_signs(mapped: Mapped) -> Mapped:
    """Bracketed "at" and "dot", with the blanks around them, to their signs."""
    changes = [(m.start(), m.end(), "@" if m[1].lower() in ("at", "arroba") else ".")
               for m in _BRACKETED.finditer(mapped.text)]
    return mapped.rewritten(changes) if changes else mapped


_NAME = "(?:" + "|".join(sorted(_DIGIT_OF, key=len, reverse=True)) + ")"
_DIGIT = rf"(?:{_NAME}|(?<![0-9])[0-9](?![0-9]))"
_SPELLED = re.compile(rf"\b(?:(plus)\s{{1,4}})?{_DIGIT}(?:[\s,.-]{{1,3}}{_DIGIT}){{3,}}\b", re.I)
_EACH = re.compile(rf"\b{_NAME}\b", re.I)
_EACH_DIGIT = re.compile(rf"\b{_DIGIT}\b", re.I)
_NUMBER = re.compile(rf"(?<![0-9])[0-9]++|\b{_NAME}\b(?:[\s,-]{{1,3}}{_NAME}\b)*+", re.I)
_DOT = re.compile(r"(?<!\s)\s++dot\s++", re.I)


_PLUS = re.compile(r"\bplus\s{1,4}\Z", re.I)


def dotted_numbers(mapped: Mapped) -> Mapped:
    """Four or more numbers, in digits or by digit names, with dots between them, to digits and dots.

    The dots are bare words or signs.  Digit names with signs only may as well be a spelled
    phone or card number, so there it must be four numbers that fit an address.
    """
    text, changes = mapped.text, []

    def end(chain: list[re.Match]) -> None:
        numbers = [m[0] if m[0].isdecimal() else "".join(
            _DIGIT_OF[n[0].lower()] for n in _EACH.finditer(m[0])) for m in chain]
        gaps = [(a.end(), b.start(), ".") for a, b in zip(chain, chain[1:])]
        if all(text[low:high] == "." for low, high, _ in gaps) and (
                len(chain) != 4 or _PLUS.search(text[max(0, chain[0].start() - 8):chain[0].start()])
                or any(len(n.lstrip("0")) > 3 or int(n[-4:]) > 255 for n in numbers)):
            return
        if len(chain) >= 4:
            changes.extend(sorted([*gaps, *((*m.span(), n) for m, n in zip(chain, numbers))]))

    chain: list[re.Match] = []
    for match in _NUMBER.finditer(text):
        between = chain and text[chain[-1].end():match.start()]
        if chain and between != "." and not _DOT.fullmatch(between):
            end(chain)
            chain = []
        chain.append(match)
    end(chain)
    return mapped.rewritten(changes) if changes else mapped


def _spelled_runs(text: str) -> Iterator[re.Match]:
    for match in _SPELLED.finditer(text):
        if sum(1 for _ in islice(_EACH.finditer(match[0]), 2)) == 2:
            yield match


def spelled_digits(mapped: Mapped) -> Mapped:
    """Four or more single digits in a row, two of them by name, to digits; a "plus" before them to its sign."""
    changes = []
    for match in _spelled_runs(mapped.text):
        at = match.start()
        if match[1]:
            changes.append((at, match.end(1), "+"))
            at = match.end(1)
        for name in _EACH_DIGIT.finditer(mapped.text, at, match.end()):
            if name.start() > at:
                changes.append((at, name.start(), ""))
            changes.append((*name.span(), _DIGIT_OF.get(name[0].lower(), name[0])))
            at = name.end()
    return mapped.rewritten(changes) if changes else mapped


# Each language's name of the sign "@", and the names of the dot that go with it.
_DOTS_OF = {"@": "dot", "at": "dot|punkt", "arroba": "punto|dot", "arobase": "point|dot"}
_AT = re.compile(r"@|(?<!\s)\s++(?:at|arroba|arobase)\s++", re.I)
_BARE_DOT = {at: re.compile(rf"(?<!\s)\s++(?:{dots})\s++", re.I) for at, dots in _DOTS_OF.items()}
_SPELLED_DOMAIN = {at: re.compile(
    rf"[A-Za-z0-9-]++(?:(?:\s++(?:{dots})\s++|\.)[A-Za-z0-9-]++)++", re.I)
    for at, dots in _DOTS_OF.items()}
_TOP_LEVEL = re.compile(r"\.[A-Za-z]{2,}\Z")


def at_and_dot(mapped: Mapped) -> Mapped:
    """Bare "at" and "dot" (or their names in other languages) to their signs where an address needs them.

    A bare "at" counts between a name and a domain: one with a bare "dot", or one with plain dots
    whose last part is letters.  A bare "dot" counts in a domain behind an "at" of either form.
    """
    text, changes, end = mapped.text, [], 0
    for match in _AT.finditer(text):
        if match.start() <= end or text[match.start() - 1] not in _LOCAL:
            continue
        sign = match[0].strip().lower()
        domain = _SPELLED_DOMAIN[sign].match(text, match.end())
        if not domain:
            continue
        dots = [(*m.span(), ".") for m in _BARE_DOT[sign].finditer(text, *domain.span())]
        bare = match[0] != "@"
        if dots or bare and _TOP_LEVEL.search(domain[0]):
            changes += [(*match.span(), "@")] * bare + dots
            end = domain.end()
    return mapped.rewritten(changes) if changes else mapped


_DISGUISE = re.compile(
    r"\bdot\b|\barroba\b|\barobase\b|\bat\s++[A-Za-z0-9-]++\s++punkt\b"
    r"|&#0*+(?:64|46);|&#x0*+(?:40|2e);|&(?:commat|period);|[(\[{<]\s*+(?:at|dot|punkt|point|punto|arroba)\s*+[)\]}>]"
    r"|\bat\s++[A-Za-z0-9-]++\.[A-Za-z0-9]"
    rf"|[0-9]\.{_NAME}\b|\b{_NAME}\.[0-9]", re.I)


def disguised_spans(text: str, plain: list[Span]) -> list[Span]:
    """What only the rewritten text shows: spans not inside a plain one of their kind."""
    strange = not text.isascii() and _STRANGE.search(text)
    if not (strange or _DISGUISE.search(text) or next(_spelled_runs(text), None)):
        return []
    mapped = Mapped.of(text)
    if strange:
        mapped = look_alikes(mapped)
    mapped = bracketed_signs(character_references(mapped))
    mapped = at_and_dot(spelled_digits(dotted_numbers(mapped)))
    # Plain spans of a kind do not overlap: only the last one that begins no later can hold another.
    starts = {kind: [s for k, s, _ in plain if k == kind] for kind in KINDS}
    ends = {kind: [e for k, _, e in plain if k == kind] for kind in KINDS}
    added = []
    for kind, low, high in plain_spans(mapped.text):
        start, end = mapped.source(low, high)
        last = bisect_right(starts[kind], start) - 1
        if last < 0 or ends[kind][last] < end:
            added.append((kind, start, end))
    return added


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in sorted(spans, key=_order))


REPORT = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long,"
          " base_sha256 string, spans string, n_added long")


def _finder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in REPORT.split(",")]
    for batch in batches:
        rows = []
        for doc, text in zip(batch.column("_id").to_pylist(), batch.column("_text")):
            text = text.as_py()
            plain = plain_spans(text)
            added = disguised_spans(text, plain)
            counts = [sum(s[0] == kind for s in plain) for kind in KINDS]
            digest = hashlib.sha256(joined(plain).encode()).hexdigest()
            rows.append((doc, *counts, digest, joined(plain + added), len(added)))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names).cast(
                pa.schema([(n, pa.string() if n in ("base_sha256", "spans") else pa.int64())
                           for n in names]))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: counts and places of personal data in its whole text.

    ``n_*`` and ``base_sha256`` (of ``kind:start:end`` joined by commas) tell of plain
    identifiers, ``spans`` of these and the ``n_added`` disguised ones.  Offsets count code
    points of the source, ends exclusive.  Null texts count as empty; rows that repeat an id are
    reported each.  Only the two named columns are read.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), text_of(text_col).alias("_text"))
    return texts.mapInArrow(_finder, REPORT)
