"""Personal data in texts, also where it is disguised, with spans of the original text."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import text_or_empty

KINDS = ("email", "ip", "card", "phone")

# The base patterns, written so that no character is tried twice: a match that starts inside a run
# could as well start where the run starts, and a run never gives characters back.
EMAIL_RIGHT = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
EMAIL_LEFT = re.compile(r"[A-Za-z0-9._%+-]")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")

Span = tuple[str, int, int]

# Letters of other scripts that look like Latin ones, and the Latin ones.
LOOKALIKES = str.maketrans(
    "аАВсСеЕНіІјЈКМоОрРѕЅТхХуУԁɡαΑΒΕΖΗιΙΚΜνΝοΟρΡΤΥΧ",
    "aABcCeEHiIjJKMoOpPsSTxXyYdgaABEZHiIKMvNoOpPTYX",
)
# Characters without width, and marks that stand for other marks.
NO_WIDTH = "​‌‍⁠﻿­"
MARKS = str.maketrans("․。‐‑‒–﹒﹣﹫", "..----.-@")
# Digits in words.
SPELLED = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4",
    "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
}

_DIGIT_WORD = "(?:" + "|".join(SPELLED) + ")"
SPELLED_RUN = re.compile(
    rf"\b(?:plus[\s-]+)?{_DIGIT_WORD}(?:(?:[\s,-]+|\s+(?:dot|point)\s+|\.){_DIGIT_WORD}){{3,}}\b", re.I
)
_SEPARATOR = r"(?:[\s,-]+|\s+(?:dot|point)\s+|\.)"
_AFTER_FIGURE = r"(?:(?<=[0-9][\s,.-])|(?<=[0-9],\s)|(?<=[0-9]\sdot\s)|(?<=[0-9]\spoint\s))"
_BEFORE_FIGURE = rf"(?={_SEPARATOR}\+?[0-9])"
# Digit words beside figures: one between two of them or after a plus, else two and more, as a single
# one beside a number is common in prose.
MIXED_RUN = re.compile(
    rf"{_AFTER_FIGURE}\b{_DIGIT_WORD}(?:{_SEPARATOR}{_DIGIT_WORD})*\b{_BEFORE_FIGURE}"
    rf"|{_AFTER_FIGURE}\b{_DIGIT_WORD}(?:{_SEPARATOR}{_DIGIT_WORD})+\b"
    rf"|(?:\bplus[\s-]+|(?<=\+))\b{_DIGIT_WORD}(?:{_SEPARATOR}{_DIGIT_WORD})*\b{_BEFORE_FIGURE}"
    rf"|\b{_DIGIT_WORD}(?:{_SEPARATOR}{_DIGIT_WORD})+\b{_BEFORE_FIGURE}",
    re.I,
)
SPELLED_PART = re.compile(rf"{_DIGIT_WORD}|plus|dot|point|\.", re.I)
# Blanks are taken from the start of their run only, so that no run is walked from each of its places.
_BLANKS = r"(?:(?<!\s)\s++)?"
BRACKET_AT = re.compile(rf"{_BLANKS}(?:\[\s*+at\s*+\]|\(\s*+at\s*+\)|\{{\s*+at\s*+\}}|<\s*+at\s*+>)\s*+", re.I)
BRACKET_DOT = re.compile(
    rf"{_BLANKS}(?:\[\s*+(?:dot|\.)\s*+\]|\(\s*+(?:dot|\.)\s*+\)|\{{\s*+(?:dot|\.)\s*+\}}|<\s*+dot\s*+>)\s*+", re.I
)
# A dot in disguise. After a spelled "at" an address has at least one, before or behind it, as
# "meet at example.com" is prose; the others may be plain.
_DOT = rf"(?:\s+dot\s+|{BRACKET_DOT.pattern})"
_LABEL = "[A-Za-z0-9-]++"
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
BRACKETS = {"]": "[", ")": "(", "}": "{", ">": "<"}
AT = re.compile(r"(?<!\s)\s++at(?=\s)|@", re.I)
DISGUISED_DOMAIN = re.compile(rf"\s*+{_LABEL}(?:\.{_LABEL})*+{_DOT}{_LABEL}(?:(?:{_DOT}|\.){_LABEL})*+", re.I)
PLAIN_DOMAIN = re.compile(rf"\s*+{_LABEL}(?:\.{_LABEL})++", re.I)
ANY_DOMAIN = re.compile(rf"\s*+{_LABEL}(?:(?:{_DOT}|\.){_LABEL})++", re.I)
SPACED_MARK = re.compile(rf"(?<!\s)\s++at\s+|(?<!\s)\s++dot\s+|{BRACKET_DOT.pattern}|{_BLANKS}@\s*+", re.I)
SPACED_NUMBER = re.compile(r"(?<=[0-9])\s+dot\s+(?=[0-9])", re.I)
_SINGLE = re.escape("".join(map(chr, (*LOOKALIKES, *MARKS))) + NO_WIDTH)
DISGUISED = re.compile(
    rf"[{_SINGLE}]|[^\x00-\x7f -¬®-˿]|­|[\[({{<]\s*(?:at|dot|\.)\s*[\])}}>]|\b(?:dot|{_DIGIT_WORD})\b|\s@|@\s", re.I
)


def luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    end = 0
    for match in EMAIL_RIGHT.finditer(text):
        start = match.start()
        while start > end and EMAIL_LEFT.match(text, start - 1):
            start -= 1
        if start < match.start():
            yield start, match.end()
            end = match.end()


def find(text: str) -> list[Span]:
    """Spans of the base patterns, kind by kind, in order of their start."""
    spans: list[Span] = []
    if "@" in text:
        spans += (("email", *span) for span in emails(text))
    if not DIGIT.search(text):
        return spans
    for match in IP.finditer(text):
        if all(len(part.lstrip("0")) < 4 and int(part) <= 255 for part in match[0].split(".")):
            spans.append(("ip", *match.span()))
    for match in CARD.finditer(text):
        digits = match[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *match.span()))
    for match in PHONE.finditer(text):
        if 9 <= len(DIGIT.findall(match[0])) <= 15:
            spans.append(("phone", *match.span()))
    return spans


class Plain:
    """A normalised text and, for each of its characters, the stretch of the original it stands for."""

    def __init__(self, text: str):
        self.text = text
        self.starts: list[int] | range = range(len(text))
        self.ends: list[int] | range = range(1, len(text) + 1)

    def letters(self) -> None:
        """Lookalikes, wide forms, foreign digits and characters without width, one by one."""
        kept = [i for i, c in enumerate(self.text) if c not in NO_WIDTH]
        self.starts = [self.starts[i] for i in kept]
        self.ends = [self.ends[i] for i in kept]
        self.text = "".join(map(_letter, (self.text[i] for i in kept)))

    def rewrite(self, find: Callable[[str], Iterator[tuple[int, int]]], replace: Callable[[str], str]) -> None:
        """Replace what is found; every new character stands for the whole stretch."""
        texts: list[str] = []
        starts: list[int] = []
        ends: list[int] = []
        done = 0
        for a, b in find(self.text):
            new = replace(self.text[a:b])
            texts += (self.text[done:a], new)
            starts += self.starts[done:a]
            ends += self.ends[done:a]
            starts += [self.starts[a]] * len(new)
            ends += [self.ends[b - 1]] * len(new)
            done = b
        if done:
            self.text = "".join(texts) + self.text[done:]
            self.starts = starts + list(self.starts[done:])
            self.ends = ends + list(self.ends[done:])

    def span(self, start: int, end: int) -> tuple[int, int]:
        return self.starts[start], self.ends[end - 1]


def _letter(c: str) -> str:
    if c < "\x80":
        return c
    if "！" <= c <= "～":
        return chr(ord(c) - 0xFEE0)
    digit = unicodedata.decimal(c, None)
    return str(digit) if digit is not None else c.translate(LOOKALIKES).translate(MARKS)


def _digits(run: str) -> str:
    parts = (part.lower() for part in SPELLED_PART.findall(run))
    return "".join({"plus": "+", "dot": ".", "point": "."}.get(p) or SPELLED.get(p, p) for p in parts)


def _address(found: str) -> str:
    return SPACED_MARK.sub(lambda m: "@" if "a" in m[0].lower() or "@" in m[0] else ".", found)


def _before_blanks(text: str, end: int, floor: int) -> int:
    while end > floor and text[end - 1].isspace():
        end -= 1
    return end


def _before_local(text: str, end: int, floor: int) -> int:
    while end > floor and text[end - 1] in LOCAL:
        end -= 1
    return end


def _before_dot(text: str, end: int, floor: int) -> int | None:
    """Where a disguised dot that ends at ``end`` starts, its blanks included; ``None`` if there is none."""
    inner = _before_blanks(text, end, floor)
    if inner < end and text[inner - 3 : inner].lower() == "dot" and inner - 3 > floor:
        start = _before_blanks(text, inner - 3, floor)
        return start if start < inner - 3 else None
    closing = text[inner - 1] if inner > floor else ""
    if closing not in BRACKETS:
        return None
    inner = _before_blanks(text, inner - 1, floor)
    if text[max(inner - 3, floor) : inner].lower() == "dot":
        inner -= 3
    elif inner > floor and text[inner - 1] == "." and closing != ">":
        inner -= 1
    else:
        return None
    inner = _before_blanks(text, inner, floor)
    if inner > floor and text[inner - 1] == BRACKETS[closing]:
        return _before_blanks(text, inner - 1, floor)
    return None


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Addresses with a disguised at or dot, or with blanks at the sign, from left to right.

    Each is sought from its "at": the domain is read behind it, then the parts of the name before it are
    walked back over. No place is looked at from more than two of them.
    """
    done = 0
    for at in AT.finditer(text):
        if at.start() < done:
            continue
        spelled = at[0] != "@"
        domain = (DISGUISED_DOMAIN if spelled else ANY_DOMAIN).match(text, at.end())
        plain = PLAIN_DOMAIN.match(text, at.end()) if spelled and not domain else None
        if not domain and not plain:
            continue
        end = at.start() if spelled else _before_blanks(text, at.start(), done)
        start, dots = _before_local(text, end, done), 0
        if start == end:
            continue
        while (dot := _before_dot(text, start, done)) is not None:
            further = _before_local(text, dot, done)
            if further == dot:
                break
            start, dots = further, dots + 1
        if domain or dots:
            done = (domain or plain).end()
            yield start, done


def _spans(pattern: re.Pattern) -> Callable[[str], Iterator[tuple[int, int]]]:
    return lambda text: (match.span() for match in pattern.finditer(text))


def normalise(text: str) -> Plain:
    """The chain of transducers: letters, spelled digits, disguised addresses, other bracketed dots."""
    plain = Plain(text)
    plain.letters()
    plain.rewrite(_spans(SPELLED_RUN), _digits)
    plain.rewrite(_spans(MIXED_RUN), _digits)
    plain.rewrite(_spans(BRACKET_AT), lambda _: "@")
    plain.rewrite(addresses, _address)
    plain.rewrite(_spans(BRACKET_DOT), lambda _: ".")
    plain.rewrite(_spans(SPACED_NUMBER), lambda _: ".")
    return plain


def find_all(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and those together with what only the normalised text shows."""
    base = find(text)
    if not DISGUISED.search(text):
        return base, base
    plain = normalise(text)
    more = set(base)
    for kind, start, end in find(plain.text):
        a, b = plain.span(start, end)
        if not any(k == kind and x <= a and b <= y for k, x, y in base):
            more.add((kind, a, b))
    return base, sorted(more, key=lambda s: (KINDS.index(s[0]), s[1:]))


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def _redacted(text: str, spans: list[Span]) -> str:
    parts, done = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= done:
            parts += (text[done:start], f"[{kind.upper()}]")
        done = max(done, end)
    return "".join(parts) + text[done:]


FOUND = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_spans bigint"


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()]
    names = [part.split()[0] for part in FOUND.split(", ")]
    for batch in batches:
        rows = []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            base, spans = find_all(text.as_py())
            counts = [sum(kind == k for kind, _, _ in base) for k in KINDS]
            digest = hashlib.sha256(_joined(base).encode()).hexdigest()
            rows.append((doc, *counts, digest, _joined(spans), len(spans)))
        columns = zip(*rows, strict=True) if rows else [()] * len(names)
        yield pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)


def detect(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of the base spans by kind, their digest, and all spans of every document.

    Identifiers are looked for twice: in the text as it is (the base), and in the text after the
    transducers, whose spans are mapped back to the original characters and added unless they
    lie within a base span of their kind. Offsets are code points, ends exclusive.

    A NULL text is an empty one and has no spans; rows that occur twice are reported twice; an empty
    table gives no rows.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return texts.mapInArrow(_rows, FOUND)


def redact(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with every span replaced by its kind in brackets; NULL texts stay NULL.

    Where spans overlap, the one that starts first names the gap.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts = []
            for value in batch.column(at):
                text = value.as_py()
                spans = find_all(text)[1] if text else []
                texts.append(_redacted(text, spans) if spans else text)
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.record_batch(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
