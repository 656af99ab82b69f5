"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds the anchors: at-signs, plus signs,
digits, schemes and identifier cues. From each anchor a small deterministic
parser expands to the boundaries of an email, an address or a number and
validates it. Parsers work from left to right, so the spans of a kind are the
leftmost ones that do not overlap; a span that fails its validation is dropped
and the search goes on behind it.

Beside the base kinds the anchors give `iban` (an account number with a valid
checksum), `account` (digits after a cue such as "account no") and `login` (the
name and password in front of the host of a URL).

Offsets are code points. Null and empty texts have no spans. Repeated rows are
searched one by one; whole texts are searched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from settle.llm.common import texts_of

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "account", "login")
CUES = ("account no", "account number", "account:", "acct", "passport no", "passport:", "ssn", "social security", "tax id")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGITS = frozenset("0123456789")
SEPARATORS = frozenset(" -")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
QUAD = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
DIALLED = re.compile(r"\+[0-9][\x20().0-9-]+")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
AFTER_CUE = re.compile(r"[\x20:#.]{0,4}([0-9](?:[\x20-]*[0-9])*)")  # a number to its end, of any length
LOGIN = re.compile(r"([^\s/@:]+):([^\s/@]+)@")

Span = tuple[str, int, int]


@cache
def anchors() -> ahocorasick.Automaton:
    """Anchor texts and the parser that each belongs to."""
    automaton = ahocorasick.Automaton()
    for digit in DIGITS:
        automaton.add_word(digit, ("digit", 1))
    automaton.add_word("@", ("at", 1))
    automaton.add_word("+", ("plus", 1))
    automaton.add_word("://", ("scheme", 3))
    for cue in CUES:
        for word in {cue, cue.capitalize(), cue.upper(), cue.title()}:
            automaton.add_word(word, ("cue", len(word)))
    automaton.make_automaton()
    return automaton


def emails(text: str, at_signs: list[int]) -> Iterator[Span]:
    free = 0  # everything before is taken by an email
    for at in at_signs:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < at and at >= free and (domain := DOMAIN.match(text, at + 1)):
            free = domain.end()
            yield "email", start, free


def addresses(text: str, digits: list[int]) -> Iterator[Span]:
    free = 0
    for at in digits:
        # Only the first digit of a run can start an address; inside a run the same parts would fail.
        if at < free or (at > free and text[at - 1] in DIGITS):
            continue
        if quad := QUAD.match(text, at):
            free = quad.end()
            if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in quad.groups()):
                yield "ip", at, free


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def cards(text: str, digits: list[int]) -> Iterator[Span]:
    i = 0
    while i < len(digits):
        # Consecutive anchors belong together while one separator at most lies between.
        first = i
        while i + 1 < len(digits) and (
            digits[i + 1] == digits[i] + 1 or (digits[i + 1] == digits[i] + 2 and text[digits[i] + 1] in SEPARATORS)
        ):
            i += 1
        count = i - first + 1
        if 13 <= count <= 19 and luhn("".join(text[d] for d in digits[first : i + 1])):
            yield "card", digits[first], digits[i] + 1
        i += 1


def phones(text: str, plus_signs: list[int]) -> Iterator[Span]:
    free = 0
    for at in plus_signs:
        if at < free or not (dialled := DIALLED.match(text, at)):
            continue
        end = dialled.end()
        while text[end - 1] not in DIGITS:
            end -= 1
        if end - at < 4:  # a sign, a digit, something between and a last digit
            continue
        free = end
        if 9 <= sum(c in DIGITS for c in text[at:end]) <= 15:
            yield "phone", at, end


def valid_iban(text: str) -> bool:
    plain = text.replace(" ", "")
    moved = plain[4:] + plain[:4]
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def ibans(text: str, digits: list[int]) -> Iterator[Span]:
    free = 0
    for i, at in enumerate(digits):
        if at - 2 < free or i + 1 >= len(digits) or digits[i + 1] != at + 1:
            continue
        if (at == 2 or not text[at - 3].isalnum()) and (found := IBAN.match(text, at - 2)):
            # The number may be followed by words in capitals: the longest valid one counts.
            for end in range(found.end(), found.start() + 14, -1):
                if text[end - 1] != " " and not text[end : end + 1].isalnum() and valid_iban(text[found.start() : end]):
                    free = end
                    yield "iban", found.start(), end
                    break


def accounts(text: str, cue_ends: list[int]) -> Iterator[Span]:
    for end in cue_ends:
        if (found := AFTER_CUE.match(text, end)) and sum(c in DIGITS for c in found[1]) >= 6:
            yield "account", found.start(1), found.end(1)


def logins(text: str, scheme_ends: list[int]) -> Iterator[Span]:
    for end in scheme_ends:
        if found := LOGIN.match(text, end):
            yield "login", found.start(), found.end() - 1


def spans(text: str) -> list[Span]:
    """All spans by kind, then start."""
    places: dict[str, list[int]] = {"at": [], "plus": [], "digit": [], "scheme": [], "cue": []}
    for last, (kind, size) in anchors().iter(text):
        places[kind].append(last + 1 if kind in ("scheme", "cue") else last + 1 - size)
    digits = places["digit"]
    return [
        *emails(text, places["at"]),
        *addresses(text, digits if "." in text else []),
        *cards(text, digits),
        *phones(text, places["plus"]),
        *ibans(text, digits),
        *sorted(set(accounts(text, places["cue"]))),
        *logins(text, places["scheme"]),
    ]


def find(documents: DataFrame, columns: list[str]) -> DataFrame:
    """`columns` of every document and `spans`, an array of (kind, start, end) by kind as listed, then start."""
    kind = StructType().add("kind", StringType()).add("start", LongType()).add("end", LongType())
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [
                [{"kind": k, "start": a, "end": b} for k, a, b in spans(text)]
                for text in texts_of(batch.column(len(columns)))
            ]
            arrays = [*batch.columns[: len(columns)], pa.array(made, arrow)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, "spans"])

    schema = documents.select(*columns).schema.add("spans", ArrayType(kind))
    sent = documents.select(*columns, F.col("text")).toDF(*columns, "_text")
    return sent.mapInArrow(run, schema)
