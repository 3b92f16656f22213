"""Format-preserving pseudonyms for personal numbers, dates and addresses.

A value found in a text and validated is replaced by a keyed permutation of its own format: a
Feistel network over the free digits (or letters) under HMAC-SHA-256, with a step between two passes
so that no value stays as it was. Punctuation, length, check digits and ranges stay valid, and equal values have equal pseudonyms in every document, so links
across documents survive. With the key the permutation can be undone.
"""

from __future__ import annotations

import bisect
import calendar
import datetime
import hashlib
import hmac
import re
import secrets
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import map_rows

ROUNDS = 8
#: The session setting that holds the key, as text.
KEY_SETTING = "sparkreel.pii.key"
_OWN_KEYS: dict[str, bytes] = {}


def session_key(spark: SparkSession) -> bytes:
    """The key of ``KEY_SETTING``; where none is set, a random one that lasts as long as the application."""
    given = spark.conf.get(KEY_SETTING, None)
    return given.encode() if given else _OWN_KEYS.setdefault(spark.sparkContext.applicationId, secrets.token_bytes(32))


def feistel(value: int, size: int, key: bytes, tweak: bytes, back: bool = False) -> int:
    """A keyed permutation of range(size), by a generalised Feistel network and cycle walking."""
    if size < 2:
        return value
    a = int(size**0.5) or 1
    while a * a < size:
        a += 1
    b = -(-size // a)

    def noise(i: int, x: int, m: int) -> int:
        return int.from_bytes(hmac.digest(key, b"%s|%d|%d|%d" % (tweak, size, i, x), hashlib.sha256)[:16], "big") % m

    while True:
        left, right = divmod(value, b)
        for i in range(ROUNDS)[:: -1 if back else 1]:
            sign = -1 if back else 1
            if i % 2:
                left = (left + sign * noise(i, right, a)) % a
            else:
                right = (right + sign * noise(i, left, b)) % b
        value = left * b + right
        if value < size:
            return value


def permute(value: int, size: int, key: bytes, tweak: bytes, back: bool = False) -> int:
    """A keyed permutation of range(size) that moves every value: a step between two Feistel passes."""
    if size < 2:
        return value
    step = 1 + int.from_bytes(hmac.digest(key, b"step|%s|%d" % (tweak, size), hashlib.sha256)[:16], "big") % (size - 1)
    moved = (feistel(value, size, key, tweak) + (-step if back else step)) % size
    return feistel(moved, size, key, tweak, True)


def luhn_digit(digits: str) -> str:
    """The check digit that follows ``digits``."""
    total = sum(d if i % 2 else (2 * d if d < 5 else 2 * d - 9) for i, d in enumerate(map(int, reversed(digits))))
    return str(-total % 10)


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def _refill(text: str, digits: str) -> str:
    """``text`` with its digits replaced in turn."""
    new = iter(digits)
    return "".join(next(new) if c.isdigit() else c for c in text)


def _permuted(digits: str, key: bytes, tweak: str, back: bool) -> str:
    return str(permute(int(digits), 10 ** len(digits), key, tweak.encode(), back)).zfill(len(digits)) if digits else ""


def _card(text: str, key: bytes, back: bool) -> str | None:
    """13 to 19 digits that pass the Luhn check; issuer digits (six) stay."""
    d = _digits(text)
    if not 13 <= len(d) <= 19 or luhn_digit(d[:-1]) != d[-1] or len(set(d)) == 1:
        return None
    body = d[:6] + _permuted(d[6:-1], key, f"card{d[:6]}", back)
    return _refill(text, body + luhn_digit(body))


def _iban(text: str, key: bytes, back: bool) -> str | None:
    """Country and remainder 1 modulo 97; letters of the account part stay."""
    bare = text.replace(" ", "")
    number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if not 15 <= len(bare) <= 34 or number(bare[4:] + bare[:4]) % 97 != 1:
        return None
    account = _refill(bare[4:], _permuted(_digits(bare[4:]), key, "iban" + bare[:2], back))
    new = iter(bare[:2] + f"{98 - number(account + bare[:2] + '00') % 97:02d}" + account)
    return "".join(c if c == " " else next(new) for c in text)


def _ssn(text: str, key: bytes, back: bool) -> str | None:
    """Area 001-899 but 666, group 01-99, serial 0001-9999."""
    area, group, serial = (int(x) for x in text.split("-"))
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    areas = [a for a in range(1, 900) if a != 666]
    n = permute((areas.index(area) * 99 + group - 1) * 9999 + serial - 1, len(areas) * 99 * 9999, key, b"ssn", back)
    return f"{areas[n // 9999 // 99]:03d}-{n // 9999 % 99 + 1:02d}-{n % 9999 + 1:04d}"


def _phone(text: str, key: bytes, back: bool) -> str | None:
    """7 to 15 digits; the country code after + or a leading 1 stays, and so does the first digit of what follows."""
    lead = re.match(r"\+\d{1,3}(?=\D)|\+\d|1[ .-](?=\(|\d{3}[.-])", text)
    start = lead.end() if lead else 0
    d = _digits(text[start:])
    if not 7 <= len(_digits(text)) <= 15 or len(d) < 6:
        return None
    return text[:start] + _refill(text[start:], d[0] + _permuted(d[1:], key, "phone" + (text[:start] if text[0] == "+" else ""), back))


def _ip(text: str, key: bytes, back: bool) -> str | None:
    """Four octets without leading zeros; the first stays, the others keep their number of digits."""
    parts, value, size = text.split("."), 0, 1
    ranges = [{1: (0, 10), 2: (10, 90), 3: (100, 156)}[len(p)] for p in parts]
    if any(not low <= int(p) < low + n for p, (low, n) in zip(parts, ranges)):
        return None
    for p, (low, n) in zip(parts[1:], ranges[1:]):
        value, size = value * n + int(p) - low, size * n
    value, new = permute(value, size, key, f"ip{parts[0]}{[len(p) for p in parts]}".encode(), back), []
    for low, n in reversed(ranges[1:]):
        value, r = divmod(value, n)
        new.append(str(low + r))
    return ".".join([parts[0], *reversed(new)])


def _letters(text: str, key: bytes, tweak: str, back: bool) -> str:
    """ASCII letters and digits, each within its kind; the rest stays."""
    size = value = 0
    bases = [26 if c.isalpha() else 10 for c in text if c.isascii() and c.isalnum()]
    size, value = 1, 0
    for c in text:
        if c.isascii() and c.isalnum():
            base = 26 if c.isalpha() else 10
            value, size = value * base + (ord(c.lower()) - 97 if base == 26 else int(c)), size * base
    value, new = permute(value, size, key, (tweak + "".join("a" if b == 26 else "0" for b in bases)).encode(), back), []
    for base in reversed(bases):
        value, r = divmod(value, base)
        new.append(chr(97 + r) if base == 26 else str(r))
    fill = iter(reversed(new))
    return "".join((next(fill).upper() if c.isupper() else next(fill)) if c.isascii() and c.isalnum() else c for c in text)


def _email(text: str, key: bytes, back: bool) -> str | None:
    """The local part; the domain stays."""
    local, _, domain = text.rpartition("@")
    return f"{_letters(local, key, 'email' + domain.lower(), back)}@{domain}"


_FIRST, _LAST = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()


def _date(order: str) -> Callable[[str, bytes, bool], str | None]:
    """A calendar date from 1900 to 2099, to another one in the same notation."""

    def moved(text: str, key: bytes, back: bool) -> str | None:
        parts = dict(zip(order, (int(x) for x in re.findall(r"\d+", text))))
        y, m, d = parts["y"], parts["m"], parts["d"]
        if not 1900 <= y <= 2099 or not 1 <= m <= 12 or not 1 <= d <= calendar.monthrange(y, m)[1]:
            return None
        n = permute(datetime.date(y, m, d).toordinal() - _FIRST, _LAST - _FIRST + 1, key, b"date", back)
        day = datetime.date.fromordinal(n + _FIRST)
        return _refill(text, "".join(f"{day.year:04d}" if c == "y" else f"{day.month if c == 'm' else day.day:02d}" for c in order))

    return moved


#: Dates that can't be read month first: those after the 12th.
_LATE = [n for n in range(_FIRST, _LAST + 1) if datetime.date.fromordinal(n).day > 12]


def _day_first(text: str, key: bytes, back: bool) -> str | None:
    """A date after the 12th, day first, to another such one, so that the new date isn't read month first."""
    d, m, y = (int(x) for x in re.findall(r"\d+", text))
    if not 1900 <= y <= 2099 or not 1 <= m <= 12 or not 12 < d <= calendar.monthrange(y, m)[1]:
        return None
    n = permute(bisect.bisect_left(_LATE, datetime.date(y, m, d).toordinal()), len(_LATE), key, b"late date", back)
    day = datetime.date.fromordinal(_LATE[n])
    return _refill(text, f"{day.day:02d}{day.month:02d}{day.year:04d}")


#: What may not follow a date: a letter or digit, but for a time, or more of a number.
_DATE_END = r"(?!(?![Tt]\d)\w|[-/.]\d)"
#: Kind, pattern and permutation, tried in this order at each place. A pattern must keep what
#: surrounds a value out of it: no digit, letter or part of a longer number may touch it.
KINDS: list[tuple[str, str, Callable[[str, bytes, bool], str | None]]] = [
    ("email", r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24}(?![A-Za-z0-9])", _email),
    ("iban", r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", _iban),
    ("ymd", r"\d{4}([-/.])\d{2}\1\d{2}" + _DATE_END, _date("ymd")),
    ("dmy", r"\d{2}\.\d{2}\.\d{4}" + _DATE_END, _date("dmy")),
    ("mdy", r"\d{2}([-/])\d{2}\1\d{4}" + _DATE_END, _date("mdy")),
    ("day_first", r"\d{2}([-/])\d{2}\1\d{4}" + _DATE_END, _day_first),
    ("ip", r"\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)", _ip),
    ("ssn", r"\d{3}-\d{2}-\d{4}(?![\w-])", _ssn),
    ("card", r"\d(?:[ -]?\d){12,18}(?![\w]|-\d)", _card),
    ("phone", r"\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?![\w])", _phone),
    ("local_phone", r"(?:1[ .-])?(?:\(\d{3}\) ?|\d{3}[-.])\d{3}[-.]\d{4}(?![\w-])", _phone),
]
_STARTS = re.compile(r"(?<![A-Za-z0-9_])(?<!\d[.-])(?=[A-Za-z0-9+(])")
_COMPILED = [(name, re.compile(pattern), fn) for name, pattern, fn in KINDS]
#: A digit or an @ is part of every kind.
_HINT = re.compile(r"[0-9@]")
#: Every value lies in a run of these, which holds a hint and starts after something else.
_RUN = re.compile(r"[A-Za-z0-9._%+@()/-]+(?: [A-Za-z0-9._%+@()/-]*[0-9][A-Za-z0-9._%+@()/-]*)*")


def _replace_run(run: str, key: bytes, back: bool) -> tuple[str, int]:
    out, at, count = [], 0, 0
    while at < len(run):
        start = _STARTS.search(run, at)
        if not start:
            break
        i = start.start()
        for _, pattern, replace in _COMPILED:
            if (m := pattern.match(run, i)) and (new := replace(m.group(), key, back)) is not None:
                out += [run[at:i], new]
                at, count = m.end(), count + 1
                break
        else:
            out.append(run[at : i + 1])
            at = i + 1
    out.append(run[at:])
    return "".join(out), count


def pseudonymise(text: str | None, key: bytes, back: bool = False) -> tuple[str | None, int]:
    """The text with validated values replaced, and how many were; ``back`` undoes it."""
    if not text or not _HINT.search(text):
        return text, 0
    out, at, count = [], 0, 0
    for hint in _HINT.finditer(text):
        i = hint.start()
        if i < at:
            continue
        start = i
        while start > at and (text[start - 1] in _RUN_CHARS or (text[start - 1] == " " and _number_before(text, start - 1, at))):
            start -= 1
        m = _RUN.match(text, start)
        new, n = _replace_run(m.group(), key, back)
        if m.end() <= i:  # cannot be, as the hint is a run character
            continue
        out += [text[at:start], new]
        at, count = m.end(), count + n
    out.append(text[at:])
    return "".join(out), count


_RUN_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+@()/-")


def _number_before(text: str, space: int, floor: int) -> bool:
    """Whether the word that ends at ``space`` is part of a number (a digit, bracket or IBAN letter ends it)."""
    return space > floor and (text[space - 1].isdigit() or text[space - 1] == ")")


def pseudonymise_documents(docs: DataFrame, key: bytes, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with ``text_col`` pseudonymised under ``key``; with ``count_col``, a column of how many values were replaced.

    All rows and other columns stay as they are (a null text stays null, an empty one empty, repeated
    rows repeat). Each row is on its own: nothing is shuffled, and a batch is all that a task holds.
    Rows without a digit or @ pass through Python unread. ``count_col`` must not be a column of ``docs``.
    """
    if count_col and count_col.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"{count_col} is a column already")
    place = docs.columns.index(text_col)
    fields = [StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema.fields)] + ([StructField("count", LongType())] if count_col else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [pseudonymise(t.as_py(), key) for t in batch.column(place)]
            columns = list(batch.columns)
            columns[place] = pa.array([d[0] for d in done], pa.string())
            names = list(batch.schema.names)
            if count_col:
                columns.append(pa.array([d[1] for d in done], pa.int64()))
                names.append("count")
            yield pa.RecordBatch.from_arrays(columns, names)

    # Columns go by number inside: a name may hold what neither a schema text nor a column's name can.
    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return map_rows(numbered, StructType(fields), run).toDF(*docs.columns, *([count_col] if count_col else []))
