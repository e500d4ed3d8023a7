"""Format-preserving pseudonyms for personal data by a keyed Feistel permutation.

Numbers and dates that hold by their own rules (card and account check sums, calendar dates,
octets, areas) are permuted within their format: the symbols that may vary are one number in mixed
radix, a Feistel network of modular sums permutes it, and check digits are computed again. The
same value has the same pseudonym in every document, in every layout of its kind, and values that
don't hold by the rules stay. The key is a parameter; whoever has it can invert the permutation.

Defined cases: a null or empty text stays as it is, as an empty text, with no replacement; equal
rows get equal results; an empty table gives an empty one; only the id and the text are looked at.
"""

from __future__ import annotations

import datetime
import re
import secrets
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from hashlib import blake2b
from math import prod

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lodegate.llm.context import prepare, texts

# Names the setting that holds the key of a session.
KEY_SETTING = "lodegate.pseudonyms.key"
ROUNDS = 10
_FIRST, _LAST = datetime.date(1900, 1, 1), datetime.date(2099, 12, 31)
_MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")

_PATTERNS = {
    "email": r"(?<![\w.%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "account": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": r"(?<![\w-])(?:\d{13,19}|\d{4}([ -])\d{4}\g<sep>\d{4}\g<sep>\d{4}|\d{4}[ -]\d{6}[ -]\d{5})(?![\d-]*\d)",
    "phone": r"(?<![\w+])\+\d{1,3}[ .-]?\(\d{2,5}\)[ .-]?\d{3}[ .-]?\d{4}(?!\d)|(?<![\w+])\+\d{1,3}(?:[ -]?\d{2,5}){2,4}(?!\.?\d)"
    r"|(?<![\w(])\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\w-])\d{3}-\d{3}-\d{4}(?![\d-]*\d)",
    "social": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]*\d)",
    "address": r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)",
    "date": r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}-\d{1,2}-\d{4}"
    rf"|\d{{1,2}} (?:{'|'.join(_MONTHS)}) \d{{4}}|(?:{'|'.join(_MONTHS)}) \d{{1,2}}, \d{{4}})(?!\d|[/-]\d|\.\d)",
    "secret": r"(?i:token|secret|password|passwd|api[_-]?key)[\"']? ?[=:] ?[\"']?[A-Za-z0-9_+/=-]{16,}",
}
_PATTERNS["card"] = _PATTERNS["card"].replace(r"([ -])", r"(?P<sep>[ -])").replace(r"\g<sep>", r"(?P=sep)")
_COMPILED = {kind: re.compile(pattern) for kind, pattern in _PATTERNS.items()}
# What a text must hold for a kind to be looked for.
_WORTH = {
    "email": re.compile("@"), "account": re.compile(r"[A-Z]{2}\d\d"), "secret": re.compile(r"(?i:token|secret|passw|api.?key)"),
    "card": re.compile(r"\d{4}[ -]?\d{4}|\d{13}"), "phone": re.compile(r"[+(]\d|\d-\d"), "social": re.compile(r"\d-\d\d-\d"),
    "address": re.compile(r"\d\.\d"), "date": re.compile(rf"\d[-/.]\d|\d (?:{'|'.join(_MONTHS)})|(?:{'|'.join(_MONTHS)}) \d"),
}
_DIGIT_OR_AT = re.compile(r"[0-9@]")
KINDS = tuple(_PATTERNS)


def permute(values: Sequence[int], radices: Sequence[int], tweak: str, key: bytes) -> list[int]:
    """A keyed permutation of the numbers whose digits, most significant first, have these radices.

    The digits are two halves; each round adds a keyed hash of one half to the other, modulo that
    half's range, so every round can be undone.
    """
    cut = (len(radices) + 1) // 2
    sizes = [prod(radices[:cut]), prod(radices[cut:])]
    halves = [0, 0]
    for value, radix, k in zip(values, radices, range(len(radices))):
        halves[k >= cut] = halves[k >= cut] * radix + value
    for turn in range(ROUNDS):
        side = turn % 2
        seed = f"{tweak}|{','.join(map(str, radices))}|{turn}|{halves[1 - side]}".encode()
        wide = b"".join(blake2b(seed + bytes([k]), key=key).digest() for k in range(1 + sizes[side].bit_length() // 448))
        halves[side] = (halves[side] + int.from_bytes(wide, "big")) % sizes[side]
    out = []
    for half, part in ((halves[1], radices[cut:]), (halves[0], radices[:cut])):
        for radix in reversed(part):
            half, digit = divmod(half, radix)
            out.append(digit)
    return out[::-1]


def _within(value: int, size: int, tweak: str, key: bytes) -> int:
    """A permutation of 0 to size - 1: the next range of two digits, walked until inside."""
    side = int(size**0.5) + 1
    while True:
        high, low = permute(divmod(value, side), (side, side), tweak, key)
        value = high * side + low
        if value < size:
            return value


def _digits(text: str, digits: Sequence[int]) -> str:
    """The text with its ASCII digits replaced in turn."""
    rest = iter(digits)
    return re.sub(r"[0-9]", lambda _: str(next(rest)), text)


def _luhn(digits: Sequence[int]) -> int:
    """The check digit that belongs behind these."""
    doubled = [d * 2 - 9 * (d > 4) if k % 2 == 0 else d for k, d in enumerate(reversed(digits))]
    return -sum(doubled) % 10


def _card(text: str, key: bytes) -> str:
    digits = [int(c) for c in text if c.isdigit()]
    if _luhn(digits[:-1]) != digits[-1]:
        return text
    new = permute(digits[:-1], [10] * (len(digits) - 1), "card", key)
    return _digits(text, [*new, _luhn(new)])


def _account(text: str, key: bytes) -> str:
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34 or _check97(plain[4:], plain[:2]) != plain[2:4]:
        return text
    body = _symbols(plain[4:], "account", key)
    rest = iter(plain[:2] + _check97(body, plain[:2]) + body)
    return "".join(" " if c == " " else next(rest) for c in text)


def _check97(body: str, country: str) -> str:
    number = int("".join(str(int(c, 36)) for c in f"{body}{country}00"))
    return f"{98 - number % 97:02d}"


def _symbols(text: str, tweak: str, key: bytes) -> str:
    """Lower-case and capital letters and digits permuted, each position within its kind."""
    kinds = [(26, "a") if "a" <= c <= "z" else (26, "A") if "A" <= c <= "Z" else (10, "0") if "0" <= c <= "9" else None for c in text]
    places = [k for k, kind in enumerate(kinds) if kind]
    radices = [kinds[k][0] for k in places]
    values = [ord(text[k]) - ord(kinds[k][1]) for k in places]
    if len(places) == 1:
        new = [_within(values[0], radices[0], tweak, key)]
    elif places:
        new = permute(values, radices, tweak, key)
    else:
        return text
    out = list(text)
    for k, value in zip(places, new):
        out[k] = chr(ord(kinds[k][1]) + value)
    return "".join(out)


def _email(text: str, key: bytes) -> str:
    local, _, domain = text.rpartition("@")
    return f"{_symbols(local, 'email', key)}@{domain}"


def _phone(text: str, key: bytes) -> str:
    head = re.match(r"\+\d{1,3}", text)
    # A country code without a mark behind it can't be told from the number: one digit stays.
    lead = "" if head is None else head[0] if not text[head.end() :][:1].isdigit() else text[:2]
    digits = [int(c) for c in text[len(lead) :] if c.isdigit()]
    if not 7 <= len(digits) <= 14:
        return text
    return lead + _digits(text[len(lead) :], permute(digits, [10] * len(digits), "phone", key))


def _social(text: str, key: bytes) -> str:
    area, group, serial = map(int, text.split("-"))
    if not (0 < area < 900 and area != 666 and group and serial):
        return text
    new = permute((area - 1 - (area > 666), group - 1, serial - 1), (898, 99, 9999), "social", key)
    return f"{new[0] + 1 + (new[0] >= 665):03d}-{new[1] + 1:02d}-{new[2] + 1:04d}"


def _address(text: str, key: bytes) -> str:
    octets = [int(part) for part in text.split(".")]
    if max(octets) > 255 or any(len(part) > 1 and part[0] == "0" for part in text.split(".")):
        return text
    return ".".join(map(str, permute(octets, [256] * 4, "address", key)))


def _read_date(text: str) -> tuple[datetime.date, Callable[[datetime.date], str]] | None:
    numbers = [int(n) for n in re.findall(r"\d+", text)]
    name = re.search(r"[A-Z][a-z]+", text)
    try:
        if name:
            month = _MONTHS.index(name[0]) + 1
            day, year = numbers
            if text[0].isdigit():
                return datetime.date(year, month, day), lambda d: f"{d.day} {_MONTHS[d.month - 1]} {d.year}"
            return datetime.date(year, month, day), lambda d: f"{_MONTHS[d.month - 1]} {d.day}, {d.year}"
        mark = re.search(r"\D", text)[0]
        if len(re.match(r"\d+", text)[0]) == 4:
            return datetime.date(*numbers), lambda d: f"{d.year}{mark}{d.month:02d}{mark}{d.day:02d}"
        wide = all(len(part) == 2 for part in text.split(mark)[:2])
        show = (lambda n: f"{n:02d}") if wide else str
        first, second, year = numbers
        # With slashes the month may stand first; where both readings hold, the day does.
        if second > 12 and mark == "/":
            return datetime.date(year, first, second), lambda d: f"{show(d.month)}/{show(d.day)}/{d.year}"
        return datetime.date(year, second, first), lambda d: f"{show(d.day)}{mark}{show(d.month)}{mark}{d.year}"
    except ValueError:
        return None


def _date(text: str, key: bytes) -> str:
    read = _read_date(text)
    if read is None or not _FIRST <= read[0] <= _LAST:
        return text
    day, show = read
    new = _within((day - _FIRST).days, (_LAST - _FIRST).days + 1, "date", key)
    return show(_FIRST + datetime.timedelta(days=new))


def _secret(text: str, key: bytes) -> str:
    at = re.search(r"[=:] ?[\"']?", text).end()
    return text[:at] + _symbols_hex(text[at:], key)


def _symbols_hex(text: str, key: bytes) -> str:
    """A secret in hexadecimal digits stays one; others are permuted like other symbols."""
    for alphabet in ("0123456789abcdef", "0123456789ABCDEF"):
        if all(c in alphabet for c in text):
            new = permute([alphabet.index(c) for c in text], [16] * len(text), "hex", key)
            return "".join(alphabet[value] for value in new)
    return _symbols(text, "secret", key)


_RULES = {
    "email": _email, "account": _account, "card": _card, "phone": _phone,
    "social": _social, "address": _address, "date": _date, "secret": _secret,
}


@lru_cache(maxsize=100_000)
def pseudonym(kind: str, value: str, key: bytes) -> str:
    return _RULES[kind](value, key)


def mask(text: str, key: bytes) -> tuple[str, list[str]]:
    """The text with pseudonyms, and the kind of each value replaced.

    Of matches that overlap the one that begins first counts, then the kind named first.
    """
    found = []
    if _DIGIT_OR_AT.search(text) or _WORTH["secret"].search(text):
        for rank, kind in enumerate(KINDS):
            if _WORTH[kind].search(text):
                found += [(m.start(), rank, m.end(), kind) for m in _COMPILED[kind].finditer(text)]
    out, kinds, at = [], [], 0
    for start, _, end, kind in sorted(found):
        if start < at:
            continue
        value = text[start:end]
        new = pseudonym(kind, value, key)
        if new == value:
            continue
        out += [text[at:start], new]
        kinds.append(kind)
        at = end
    return "".join([*out, text[at:]]), kinds


_drawn: dict[str, bytes] = {}


def session_key(spark: SparkSession) -> bytes:
    """The key that the session is given as ``lodegate.pseudonyms.key``.

    Without one, a key is drawn at random once per application and kept by its driver alone: values
    stay linked across all texts of the application, and nobody can invert them later.
    """
    given = spark.conf.get(KEY_SETTING, None)
    if given:
        return blake2b(given.encode()).digest()
    return _drawn.setdefault(spark.sparkContext.applicationId, secrets.token_bytes(32))


def _mask(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [mask(text, key) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([text for text, _ in done], pa.string()), pa.array([kinds for _, kinds in done], pa.list_(pa.string()))],
                ["doc_id", "text", "kinds"],
            )

    return run


def pseudonymise(docs: DataFrame, key_column: str = "doc_id", text: str = "text", *, key: bytes) -> DataFrame:
    """doc_id, the text with pseudonyms, and the kinds of the values replaced in it, in order."""
    prepare(docs.sparkSession)
    return texts(docs, key_column, text).mapInArrow(_mask(key), "doc_id long, text string, kinds array<string>")


def masked(text: Column, key: bytes) -> Column:
    """The text column with pseudonyms; null stays null."""

    @F.pandas_udf("string")
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda value: None if value is None else mask(value, key)[0])

    return run(text)
