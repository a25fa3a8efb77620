"""Format-preserving pseudonyms for personal numbers, dates and addresses in text.

A found value is validated, turned into a number below the size of its format,
permuted by a keyed Feistel network, and written back in the same format:
card numbers keep length, separators and first digit and get a new check digit,
dates stay dates of the same 200 years in the same notation, IP addresses stay
IP addresses. The permutation depends on key and format only, so equal values
get equal pseudonyms in all documents, and different ones stay different.

The work is one pass over the texts in Arrow batches, without a shuffle.

Defined results: a null text stays null, an empty one empty; repeated rows get
equal results; other columns pass through unchanged, a column that has the name
of the counter is replaced; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from datetime import date

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
LOWER, UPPER, DIGITS, HEX = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "0123456789abcdef"


def permute(x: int, size: int, key: bytes, tweak: str) -> int:
    """Keyed permutation of range(size): a balanced Feistel network, walked until it is back in range."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    width, low = (half + 7) // 8, (1 << half) - 1
    salt = f"{tweak}|{size}|".encode()
    while True:
        left, right = x >> half, x & low
        for i in range(ROUNDS):
            mixed = hashlib.blake2b(salt + bytes([i]) + right.to_bytes(width), key=key, digest_size=max(8, width)).digest()
            left, right = right, left ^ (int.from_bytes(mixed) & low)
        x = left << half | right
        if x < size:
            return x


def _by_alphabets(value: str, alphabets: list[str], key: bytes, tweak: str) -> str:
    """Permute the characters that have an alphabet (others have an empty one) as one mixed-radix number."""
    number, size = 0, 1
    for c, letters in zip(value, alphabets):
        if letters:
            number, size = number * len(letters) + letters.index(c), size * len(letters)
    if size < 2:
        return value
    number, out = permute(number, size, key, tweak), []
    for c, letters in zip(reversed(value), reversed(alphabets)):
        if letters:
            number, place = divmod(number, len(letters))
            c = letters[place]
        out.append(c)
    return "".join(reversed(out))


def _classes(value: str) -> list[str]:
    return [next((a for a in (DIGITS, LOWER, UPPER) if c in a), "") for c in value]


def _refilled(pattern: str, digits: str) -> str:
    """``digits`` in the digit places of ``pattern``."""
    left = iter(digits)
    return "".join(next(left) if c.isdigit() else c for c in pattern)


def luhn_digit(body: str) -> str:
    """The digit that makes ``body`` a valid card number."""
    doubled = [int(c) * (2 - i % 2) for i, c in enumerate(reversed(body))]
    return str(-sum(d // 10 + d % 10 for d in doubled) % 10)


def _card(value: str, key: bytes) -> str | None:
    digits = re.sub(r"\D", "", value)
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
        return None
    size = 10 ** (len(digits) - 2)
    body = digits[0] + str(permute(int(digits[1:-1]), size, key, f"card{len(digits)}{digits[0]}")).zfill(len(digits) - 2)
    return _refilled(value, body + luhn_digit(body))


def _ip(value: str, key: bytes) -> str | None:
    parts = value.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    return ".".join(str(b) for b in permute(int.from_bytes(bytes(map(int, parts))), 1 << 32, key, "ip").to_bytes(4))


def _moved(day: date, key: bytes) -> date:
    block = (day.year - 1900) // 200
    first = date(max(1, 1900 + 200 * block), 1, 1).toordinal()
    after = date(2100 + 200 * block, 1, 1).toordinal() if 2100 + 200 * block <= 9999 else date.max.toordinal() + 1
    return date.fromordinal(first + permute(day.toordinal() - first, after - first, key, f"date{block}"))


def _date(value: str, key: bytes) -> str | None:
    a, mark, b, _, c = re.split(r"([-./])", value)
    year_first = len(a) == 4
    orders = ((a, b, c),) if year_first else ((c, b, a), (c, a, b))  # day first, where both are valid
    for i, (y, m, d) in enumerate(orders):
        try:
            moved = _moved(date(int(y), int(m), int(d)), key)
        except ValueError:
            continue
        two = len(b) == 2 and len(c if year_first else a) == 2
        y, m, d = f"{moved.year:04}", *((f"{n:02}" if two else str(n)) for n in (moved.month, moved.day))
        return mark.join((y, m, d) if year_first else (d, m, y) if i == 0 else (m, d, y))
    return None


def _ssn(value: str, key: bytes) -> str | None:
    area, group, serial = map(int, value.split("-"))
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    areas = [n for n in range(1, 900) if n != 666]
    x = permute((areas.index(area) * 99 + group - 1) * 9999 + serial - 1, len(areas) * 99 * 9999, key, "ssn")
    x, serial = divmod(x, 9999)
    area, group = divmod(x, 99)
    return f"{areas[area]:03}-{group + 1:02}-{serial + 1:04}"


# Calling codes of two digits; 1 and 7 have one, all others three.
TWO_DIGIT_CODES = frozenset(
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())


def _phone(value: str, key: bytes) -> str | None:
    """The national digits change; the calling code and the 0 before an area stay, so all notations of a number stay linked."""
    at = 0
    if value[0] == "+":
        at = 2 if value[1] in "17" else 3 if value[1:3] in TWO_DIGIT_CODES else 1 + len(re.match(r"\d{1,3}", value[1:]).group())
    elif head := re.match(r"1(?:[ .-]|(?=\())", value):
        at = head.end()
    at += re.match(r"[^1-9]*", value[at:]).end()
    digits = re.sub(r"\D", "", value[at:])
    if not digits or len(digits) > 15 or len(re.sub(r"\D", "", value)) < 7:
        return None
    least = 10 ** (len(digits) - 1)  # the first digit stays above 0, as zeros before it belong to the notation
    return value[:at] + _refilled(value[at:], str(least + permute(int(digits) - least, 9 * least, key, f"phone{len(digits)}")))


def _iban_check(country: str, body: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in body + country + '00')) % 97:02}"


def _iban(value: str, key: bytes) -> str | None:
    country, body = value[:2], value[4:].replace(" ", "")
    if len(body) < 11 or _iban_check(country, body) != value[2:4]:
        return None
    body = _by_alphabets(body, _classes(body), key, f"iban{country}")
    left = iter(country + _iban_check(country, body) + body)
    return "".join(c if c == " " else next(left) for c in value)


def _email(value: str, key: bytes) -> str | None:
    local, domain = value.split("@")
    return _by_alphabets(local, _classes(local), key, "email" + domain.lower()) + "@" + domain


def _secret(value: str, key: bytes) -> str | None:
    head = re.match(r"AKIA|.*?[=:]\s*[\"']?", value).end()
    body = value[head:]
    hexadecimal = re.fullmatch(r"[0-9a-f]+", body)
    return value[:head] + _by_alphabets(body, [HEX] * len(body) if hexadecimal else _classes(body), key, "secret")


# Kinds in order of precedence: name, pattern, validator that gives the pseudonym or None.
KINDS: tuple[tuple[str, str, Callable[[str, bytes], str | None]], ...] = (
    ("email", r"(?<![\w.%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24}\b", _email),
    ("secret", r"\bAKIA[0-9A-Z]{16}\b|\b(?:password|passwd|token|secret|api_key)\s?[=:]\s?[\"']?[0-9A-Za-z]{8,64}\b", _secret),
    ("iban", r"\b[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)\b", _iban),
    ("ip", r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\w|\.\d)", _ip),
    ("date", r"(?<![\w./-])(?:\d{4}-\d{1,2}-\d{1,2}|\d{4}/\d{1,2}/\d{1,2}|\d{4}\.\d{1,2}\.\d{1,2}|\d{1,2}-\d{1,2}-\d{4}"
             r"|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?:(?=[Tt]\d\d)|(?![\w/-]|\.\d))", _date),
    ("ssn", r"(?<![\w-])\d{3}-\d\d-\d{4}(?![\w-])", _ssn),
    ("card", r"(?<![\w-])(?:\d{13,19}|\d{4}(?:(?: \d{4}){2}|(?:-\d{4}){2})[ -]\d{1,7}|\d{4}(?: \d{6} |-\d{6}-)\d{4,5})(?![\w-])",
     _card),
    ("phone", r"(?<![\w+.-])(?:\+\d{1,3}[ .-]?|1[ .-]?(?=\()|1[ .-])?(?:\(\d{2,4}\)[ .-]?|\d{3}[.-])\d{3,4}[ .-]\d{3,4}(?![\w-])"
              r"|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?![\w-])"
              r"|(?<![\w+.-])(?:(?:1[ .-])?[2-9]\d\d [2-9]\d\d[ .-]\d{4}|0\d{2,4} \d{3,4} \d{3,4})(?![\w-])", _phone),
)
FOUND = re.compile("|".join(f"(?P<{name}>{pattern})" for name, pattern, _ in KINDS))
MAY_HOLD = re.compile(r"[0-9@=:]")


def _ends(text: str, start: int, end: int, name: str) -> list[int]:
    """Where a value may end: a grouped IBAN may be followed by words that look like more of its groups."""
    return [end] + [i for i in range(end - 1, start, -1) if text[i] == " "] if name == "iban" else [end]


def _pseudonym(text: str, match: re.Match, key: bytes, names: frozenset[str] | None) -> tuple[str, int] | None:
    """Of the matched kind or, where its validation fails, of a later kind that fits the same place; and where the value ends."""
    later, (start, end) = False, match.span()
    for name, pattern, pseudonym in KINDS:
        matched = name == match.lastgroup
        later = later or matched
        if later and (names is None or name in names) and (matched or re.compile(pattern).fullmatch(text, start, end)):
            for at in _ends(text, start, end, name):
                if (new := pseudonym(text[start:at], key)) is not None:
                    return new, at
    return None


def replaced(text: str, key: bytes, names: frozenset[str] | None = None) -> tuple[str, int]:
    """The text with pseudonyms, and how many values it held. After an invalid match the search goes on inside it."""
    if not MAY_HOLD.search(text):
        return text, 0
    parts, done, at = [], 0, 0
    while match := FOUND.search(text, at):
        at = match.start() + 1
        if (found := _pseudonym(text, match, key, names)) is not None:
            new, end = found
            parts += [text[done:match.start()], new]
            done = at = end
    return "".join(parts) + text[done:], len(parts) // 2


def pseudonymised(docs: DataFrame, key: bytes, text: str = "text", counter: str = "n_values",
                  kinds: tuple[str, ...] | None = None) -> DataFrame:
    """The same rows with pseudonyms in ``text`` and the number of replaced values in ``counter``."""
    names = frozenset(kinds) if kinds else None

    @F.pandas_udf("text string, n long")
    def swapped(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = [(None, 0) if t is None else replaced(t, key, names) for t in batch]
            yield pd.DataFrame(done, columns=["text", "n"])

    made = docs.withColumn("__swapped", swapped(F.col(text)))
    others = [c for c in docs.columns if c not in (text, counter)]
    columns = [F.col("__swapped.text").alias(text) if c == text else F.col(c) for c in docs.columns if c in (*others, text)]
    return made.select(*columns, F.col("__swapped.n").alias(counter))
