"""Format-preserving pseudonyms of personal data by keyed Feistel permutation (operator 10).

Found and validated: e-mail addresses, IPv4 addresses, payment cards (Luhn),
IBANs (mod 97), social security numbers (area, group, serial), phone numbers,
calendar dates and secrets (values of password, token, key or secret
assignments in any case, up to the closing quote or white space, and access key ids). Each is replaced by its image under a keyed
permutation of the values of its own format: cards stay Luhn-valid, IBANs keep
their checksum, dates stay dates, layout and punctuation stay. As the
permutation depends on key, kind and size alone, equal values have equal
pseudonyms in all documents, and different ones differ; with the key it can be
undone (`reveal`): what decides how a value is read (which fields of a date have
one digit or can only be a day, whether a secret is hexadecimal) is kept by the
permutation, so a pseudonym is read as its value was. There is no default key.

Cases: null text stays null; texts are searched whole; equal rows give equal
results; what only looks like a kind but fails its validation is left alone;
where two kinds overlap the first in the order above wins; other columns are
kept, save for n_pii, pii_kinds and pii_spans.
"""

from __future__ import annotations

import array
import datetime
import functools
import hashlib
import re
import struct
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

ROUNDS = 10
#: characters beyond which a value is permuted digit by digit, not as one number
LONG = 256
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"

#: every match of _FIND holds one of these
_FIRST = re.compile("[0-9@=:]|AKIA|ASIA")
_FIND = re.compile(
    r"""(?P<email>(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}(?![A-Za-z0-9-]))
|(?P<secret>(?<![A-Za-z])(?i:password|passwd|pwd|token|secret|api[_-]?key|access[_-]?key)["']?[ ]{0,3}[=:][ ]{0,3}["']?(?P<value>(?<=")(?:\\.|[^"\\\r\n]){6,}(?=")|(?<=')(?:\\.|[^'\\\r\n]){6,}(?=')|(?=[^\s"']{6})[^\s"']*[^\W_]))
|(?P<access>(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9]))
|(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))
|(?P<date>(?<![0-9A-Za-z./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}(?P<sep>[./])[0-9]{1,2}(?P=sep)[0-9]{4})(?![0-9A-Za-z/-]|\.[0-9]))
|(?P<ip>(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9]))
|(?P<ssn>(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-]))
|(?P<card>(?<![0-9A-Za-z.+-])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z]))
|(?P<phone>(?<![0-9A-Za-z.])(?:[0-9]{10,12}(?!\.[0-9])|(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,5}\)[ .-]?)?|\([0-9]{2,5}\)[ .-]?)[0-9]{2,14}(?:[ .-][0-9]{2,8}){0,4}|[0-9]{2,5}(?:[ -][0-9]{2,5}|\.[0-9]{2,4}){1,4})(?![0-9A-Za-z]))""",
    re.VERBOSE,
)


@functools.lru_cache(maxsize=10_000)
def alphabet(c: str) -> str:
    """The characters that may stand for c: digits, letters of its case, or, beyond ASCII, those of its kind among the 256 code points around it; none where c stays."""
    if c.isascii():
        return next((a for a in (LOWER, UPPER, DIGITS) if c in a), "")
    of = lambda x: (x.isalpha(), x.islower(), x.isupper(), x.isspace())
    first = ord(c) & ~255
    return "".join(x for x in map(chr, range(max(first, 128), first + 256)) if x.isalnum() and of(x) == of(c)) if c.isalnum() else ""


class Feistel:
    """Keyed permutations of [0, n), of digit and letter strings."""

    def __init__(self, key: bytes, forward: bool = True):
        self.key, self.forward = hashlib.blake2b(key, digest_size=32).digest(), forward
        self.memo: dict = {}

    def _round(self, tweak: bytes, i: int, x: int, m: int) -> int:
        return int.from_bytes(self._bytes(b"%d|%x|" % (i, x) + tweak, -(-m.bit_length() // 8) + 16), "big") % m

    def _bytes(self, of: bytes, n: int) -> bytes:
        """n keyed bytes; for a number below m, 16 more than m has, so that the rest is even and reaches all of its digits."""
        if n <= 64:
            return hashlib.blake2b(of, key=self.key, digest_size=n).digest()
        return hashlib.shake_256(self.key + of).digest(n)

    def number(self, x: int, n: int, kind: str) -> int:
        """Image of x in [0, n): alternating Feistel rounds on two parts of nearly equal size, walked on until the image is below n."""
        if n < 2:
            return x
        got = self.memo.get((kind, n, x))
        if got is not None:
            return got
        a = int(n**0.5) if n < 1 << 52 else 1 << (n.bit_length() // 2)
        b = -(-n // a)
        tweak, y = f"{kind}|{n:x}".encode(), x
        while True:
            left, right = divmod(y, b)
            for i in range(ROUNDS) if self.forward else reversed(range(ROUNDS)):
                sign = 1 if self.forward else -1
                if i % 2:
                    right = (right + sign * self._round(tweak, i, left, b)) % b
                else:
                    left = (left + sign * self._round(tweak, i, right, a)) % a
            y = left * b + right
            if y < n:
                break
        if len(self.memo) > 100_000:
            self.memo.clear()
        self.memo[kind, n, x] = y
        return y

    def digits(self, x: list[int], bases: list[int], kind: str) -> list[int]:
        """Image of a long row of digits of the given bases, in time linear in its length: Feistel rounds on its halves, digit by digit."""
        half, sign = len(x) // 2, 1 if self.forward else -1
        parts, of = [x[:half], x[half:]], [bases[:half], bases[half:]]
        tweak = kind.encode() + hashlib.blake2b(repr(bases).encode()).digest()
        for i in range(ROUNDS) if self.forward else reversed(range(ROUNDS)):
            a, b = i % 2, 1 - i % 2
            h = self._bytes(b"digits%d" % i + tweak + array.array("H", parts[b]).tobytes(), 8 * len(parts[a]))
            parts[a] = [(v + sign * w) % k for v, k, w in zip(parts[a], of[a], struct.unpack(f">{len(parts[a])}Q", h), strict=True)]
        return parts[0] + parts[1]

    def text(self, s: str, kind: str) -> str:
        """Letters and digits of s permuted as one number over their own classes; all other characters stay."""
        if len(s) > LONG:
            of = [alphabet(c) for c in s]
            new = iter(self.digits([a.index(c) for c, a in zip(s, of, strict=True) if a], [len(a) for a in of if a], kind))
            return "".join(a[next(new)] if a else c for c, a in zip(s, of, strict=True))
        size, value = 1, 0
        for c in s:
            if base := alphabet(c):
                value, size = value * len(base) + base.index(c), size * len(base)
        y, out = self.number(value, size, kind), []
        for c in reversed(s):
            if base := alphabet(c):
                y, d = divmod(y, len(base))
                out.append(base[d])
            else:
                out.append(c)
        return "".join(reversed(out))

    def hexadecimal(self, s: str, kind: str) -> str:
        digits = "0123456789abcdef"
        if len(s) > LONG:
            return "".join(digits[v] for v in self.digits([int(c, 16) for c in s], [16] * len(s), kind))
        y = self.number(int(s, 16), 16 ** len(s), kind)
        return "".join(digits[(y >> (4 * i)) & 15] for i in reversed(range(len(s))))


def luhn(digits: str) -> int:
    """The check digit of the digits before it."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 - i % 2)
        total += v - 9 * (v > 9)
    return -total % 10


def _digits(s: str) -> str:
    return "".join(c for c in s if c in DIGITS)


def _put(layout: str, digits: str) -> str:
    it = iter(digits)
    return "".join(next(it) if c in DIGITS else c for c in layout)


def _email(m: str, f: Feistel) -> str:
    local, domain = m.rsplit("@", 1)
    host, top = domain.rsplit(".", 1)
    return f"{f.text(local, 'email')}@{f.text(host, 'host')}.{top}"


def _ip(m: str, f: Feistel) -> str | None:
    parts = m.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    x = 0
    for p in parts:
        x = x << 8 | int(p)
    y = f.number(x, 1 << 32, "ip")
    return ".".join(str(y >> s & 255) for s in (24, 16, 8, 0))


def _card(m: str, f: Feistel) -> str | None:
    d = _digits(m)
    if luhn(d[:-1]) != int(d[-1]) or len(set(d)) == 1:
        return None
    new = d
    while new is d or len(set(new)) == 1:  # one digit repeated is no card
        body = str(f.number(int(new[:-1]), 10 ** (len(d) - 1), "card")).zfill(len(d) - 1)
        new = body + str(luhn(body))
    return _put(m, new)


def _iban_number(s: str) -> int:
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4]))


def _iban(m: str, f: Feistel) -> str | None:
    s = m.replace(" ", "")
    if not 15 <= len(s) <= 34 or _iban_number(s) % 97 != 1 or not 2 <= int(s[2:4]) <= 98:
        return None
    body = f.text(s[4:], "iban")
    new = iter(s[:2] + f"{98 - _iban_number(s[:2] + '00' + body) % 97:02d}" + body)
    return "".join(c if c == " " else next(new) for c in m)


def _ssn(m: str, f: Feistel) -> str | None:
    def valid(x: int) -> bool:
        area, group, serial = x // 1_000_000, x // 10_000 % 100, x % 10_000
        return 0 < area < 900 and area != 666 and group > 0 and serial > 0

    x = int(_digits(m))
    if not valid(x):
        return None
    y = f.number(x, 10**9, "ssn")
    while not valid(y):  # a permutation of the valid ones
        y = f.number(y, 10**9, "ssn")
    return _put(m, str(y).zfill(9))


def _phone(m: str, f: Feistel) -> str | None:
    d = _digits(m)
    if not 10 <= len(d) <= 15 and not (m[0] == "+" and 8 <= len(d) <= 15):
        return None
    keep = max(0, len(d) - 10) if len(d) > 10 else 1 if m[0] == "+" else 0
    n = len(d) - keep
    return _put(m, d[:keep] + str(f.number(int(d[keep:]), 10**n, "phone")).zfill(n))


_FIRST_YEAR, _LAST_YEAR = 1800, 2199


@functools.cache
def _calendar() -> tuple[dict[tuple, list[int]], dict[int, tuple[tuple, int]]]:
    """The days of all years by class, and each day's class and rank: months and days of one digit, days of two that may be a month, and days that may not."""
    by: dict[tuple, list[int]] = {}
    rank: dict[int, tuple[tuple, int]] = {}
    for n in range(datetime.date(_FIRST_YEAR, 1, 1).toordinal(), datetime.date(_LAST_YEAR + 1, 1, 1).toordinal()):
        day = datetime.date.fromordinal(n)
        kind = (day.month > 9, (day.day > 9) + (day.day > 12))
        of = by.setdefault(kind, [])
        rank[n] = (kind, len(of))
        of.append(n)
    return by, rank


def _date(m: str, f: Feistel) -> str | None:
    """Days are permuted within their class, whatever the layout: fields keep their number of digits, and a day that shows which field is the month still does."""
    sep = next(c for c in m if c not in DIGITS)
    p = m.split(sep)
    y, mo, d = (p[0], p[1], p[2]) if sep == "-" else (p[2], p[1], p[0])
    swapped = sep == "/" and int(mo) > 12 >= int(d)  # month first
    if swapped:
        mo, d = d, mo
    try:
        day = datetime.date(int(y), int(mo), int(d)).toordinal()
    except ValueError:
        return None
    by, rank = _calendar()
    if day not in rank:
        return None
    kind, at = rank[day]
    new = datetime.date.fromordinal(by[kind][f.number(at, len(by[kind]), f"date{kind}")])
    day_field, month_field = str(new.day).zfill(len(d)), str(new.month).zfill(len(mo))
    if sep == "-":
        return f"{new.year}-{month_field}-{day_field}"
    return f"{month_field if swapped else day_field}{sep}{day_field if swapped else month_field}{sep}{new.year}"


def _hexadecimal(s: str) -> bool:
    return re.fullmatch("[0-9a-f]+", s) is not None and any(c in DIGITS for c in s)


def _secret(m: str, f: Feistel) -> str:
    """Walked on until the image is hexadecimal exactly if the value is."""
    kind = _hexadecimal(m)
    step = f.hexadecimal if kind else f.text
    new = step(m, "secret")
    while _hexadecimal(new) != kind:
        new = step(new, "secret")
    return new


KINDS: dict[str, Callable[[str, Feistel], str | None]] = {"email": _email, "ip": _ip, "card": _card, "iban": _iban, "ssn": _ssn, "phone": _phone, "date": _date, "access": lambda m, f: m[:4] + f.text(m[4:], "access")}


def replace(text: str, f: Feistel) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and (kind, start, end) of each in the text that was given."""
    if not _FIRST.search(text):
        return text, []
    out, spans, at, pos = [], [], 0, 0
    while m := _FIND.search(text, pos):
        kind = m.lastgroup if m.lastgroup in KINDS else next(k for k in ("secret", *KINDS) if m[k] is not None)
        start, end = m.span("value") if kind == "secret" else m.span()
        if kind == "card":  # maybe with a number after it: the first place where a valid one ends
            new = None
            for cut in [*(m.start() + i for i, c in enumerate(m[0]) if c in " -"), end]:
                if 13 <= len(_digits(text[start:cut])) <= 19 and (new := _card(text[start:cut], f)):
                    end = cut
                    break
        else:
            new = _secret(m["value"], f) if kind == "secret" else KINDS[kind](m[0], f)
        if new is None:
            pos = m.end() if m.end() > pos else pos + 1
            later = _FIND.search(text, m.start() + 1, m.end())
            if later and later.end() <= m.end() and later.start() > m.start() and not text[later.start() - 1].isalnum():
                pos = later.start()
            continue
        out += [text[at:start], new]
        spans.append((kind, start, end))
        at = pos = end
    return "".join(out) + text[at:], spans


def pseudonymize(docs: DataFrame, key: bytes, forward: bool = True) -> DataFrame:
    """docs with the text replaced, and n_pii, pii_kinds and pii_spans (start and end in the given text)."""
    docs = docs.drop("n_pii", "pii_kinds", "pii_spans")
    names = docs.columns
    place = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Feistel(key, forward)
        for b in batches:
            got = [(None, []) if t is None else replace(t, f) for t in b.column(place).to_pylist()]
            cols = list(b.columns)
            cols[place] = pa.array([g[0] for g in got], pa.string())
            extra = [pa.array([len(g[1]) for g in got], pa.int32()), pa.array([[s[0] for s in g[1]] for g in got], pa.list_(pa.string())), pa.array([[[s[1], s[2]] for s in g[1]] for g in got], pa.list_(pa.list_(pa.int32())))]
            yield pa.RecordBatch.from_arrays(cols + extra, [*names, "n_pii", "pii_kinds", "pii_spans"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{schema}, n_pii int, pii_kinds array<string>, pii_spans array<array<int>>")


def reveal(docs: DataFrame, key: bytes) -> DataFrame:
    """Undo pseudonymize() with the same key."""
    return pseudonymize(docs, key, forward=False)
