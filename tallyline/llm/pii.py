"""PII: format-preserving pseudonyms by a keyed Feistel permutation.

Numbers and dates that pass their own validation (Luhn, mod 97, calendar, octets) and e-mail addresses
are permuted within their format: a card stays a valid card, a date a calendar date (with its month's
name in its language, if it has one), a name in its script. The permutation depends on the key and the
value alone, so equal values stay linked across documents, in whatever layout they are written, and
different values stay different.
"""

from __future__ import annotations

import datetime
import functools
import hashlib
import ipaddress
import re
import unicodedata

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_text

KINDS = ("email", "ip", "date", "ssn", "card", "iban", "phone")
ROUNDS = 10
#: Values that a worker remembers.
CACHE = 100_000

FIRST_DAY, DAYS = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal() - datetime.date(1900, 1, 1).toordinal() + 1
#: Characters of a name that are permuted at once.
PART = 64

#: Country calling codes of one and of two digits; all others have three.
CALLING_ONE = ("1", "7")
CALLING_TWO = "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
#: Names of months, January first.
MONTHS = tuple(
    tuple(x.split())
    for x in (
        "january february march april may june july august september october november december",
        "jan feb mar apr may jun jul aug sep oct nov dec",
        "januar februar märz april mai juni juli august september oktober november dezember",
        "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
        "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre",
    )
)
MONTH_OF = {name: (names, i + 1) for names in reversed(MONTHS) for i, name in enumerate(names)}

#: Phone numbers with a country's code, of North America, or national with a leading zero.
_PHONE = r"""(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}|\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:(?!\ 0)[ .-]?\(?\d{1,4}\)?){1,5}|\+\d{8,15}|\(?0\d{1,4}\)?[ /-]\d{3,8}(?:[ -]\d{2,5}){0,2}"""
_CARD = r"\d{4}(?P<a>[ -])\d{4}(?P=a)\d{4}(?P=a)\d{1,7}|\d{4}(?P<b>[ -])\d{6}(?P=b)\d{5}|\d{13,19}"
NUMBER = re.compile(
    rf"""(?<![\w@])(?:
      (?P<ip>\d{{1,3}}\.\d{{1,3}}\.\d{{1,3}}\.\d{{1,3}})(?![\w@]|\.\d)
    | (?P<ymd>\d{{4}}(?P<y>[-/.])\d{{1,2}}(?P=y)\d{{1,2}})(?:(?=T\d\d:?\d\d)|(?![\w@]|[-/.]\d))
    | (?P<dmy>\d{{1,2}}(?P<d>[-/.])\d{{1,2}}(?P=d)\d{{4}})(?![\w@]|[-/.]\d)
    | (?P<ssn>\d{{3}}-\d{{2}}-\d{{4}})(?![\w@]|-\d)
    | (?P<card>{_CARD})(?![\w@]|-\d)
    | (?P<phone>{_PHONE})(?![\w@]|[-/.]\d)
    )""",
    re.X | re.A,
)
PHONE, CARD = re.compile(rf"(?:{_PHONE})(?![\w@]|[-/.]\d)", re.A), re.compile(rf"(?<![\w@])(?:{_CARD})(?![\w@]|-\d)", re.A)
#: What card numbers begin with.
ISSUER = re.compile(r"[3-6]|2(?:22[1-9]|2[3-9]|[3-6]|7[01]|720)")
#: A day and a year with a month's name between, or behind one: `word` is looked up or looked for.
DAY_FIRST = re.compile(r"(?<![\w.,-])(?P<day>\d{1,2})(?P<mark>\.|st|nd|rd|th)?(?P<a>\s(?:de\s|of\s)?)(?P<word>[^\W\d_]{3,10})(?P<b>\.?,?\s(?:de\s)?)(?P<year>\d{4})(?![\w])")
MONTH_FIRST = re.compile(r"(?<=[^\W\d_])(?P<a>\.?\s)(?P<day>\d{1,2})(?P<mark>st|nd|rd|th)?(?P<b>,?\s)(?P<year>\d{4})(?![\w])")
_DIGIT, _YEAR = re.compile(r"\d").search, re.compile(r"(?<!\w)\d{4}(?!\w)").search
LONGEST_MONTH = max(map(len, MONTH_OF))
IPV6 = re.compile(r"(?<![\w:.])(?=[0-9a-f:]*\d)(?:[0-9a-f]{1,4}:|:(?=:))[0-9a-f:]*:[0-9a-f]{0,4}(?![\w:]|\.\d)", re.I | re.A)
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_LOCAL, _DOMAIN = re.compile(r"[\w.+%'-]"), re.compile(r"(?:[^\W_](?:[\w-]*[^\W_])?\.)+(?:xn--[a-z0-9-]*[a-z0-9]|[^\W\d_]{2,})")


@functools.lru_cache(maxsize=10_000)
def alphabet(c: str) -> str | None:
    """The characters that c may become: digits for a digit, else lower-case or caseless letters of its part of the code chart; None for marks.

    Latin letters have a to z; others those of their 128 code points, so that a name stays in its script.
    """
    if c.isdecimal():
        zero = ord(c) - unicodedata.decimal(c)
        return "".join(map(chr, range(zero, zero + 10)))
    if not c.isalpha() or c.lower() != c:
        return None
    if c.isascii():
        return "abcdefghijklmnopqrstuvwxyz"
    first, kind = ord(c) & ~0x7F, unicodedata.category(c)
    return "".join(x for x in map(chr, range(first, first + 128)) if not x.isascii() and unicodedata.category(x) == kind and x.lower() == x)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


class Permuter:
    """Keyed permutations of ranges of whole numbers: a balanced Feistel network, walked until it ends within the range."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key).digest()

    def said(self, round_: int, size: int, tweak: bytes, right: int, width: int) -> int:
        """The round function: as many bytes as asked for, of as many digests as that takes."""
        out = b""
        while len(out) < width + 8:
            head = b"%d|%d|" % (round_, size) if not out else b"%d|%d|%d|" % (round_, size, len(out))
            out += hashlib.blake2b(head + tweak + right.to_bytes(width, "big"), key=self.key, digest_size=min(64, width + 8)).digest()
        return int.from_bytes(out, "big")

    def number(self, value: int, size: int, tweak: str, back: bool = False) -> int:
        """The value's pseudonym within range(size); with back, the value of a pseudonym."""
        if size < 2:
            return value
        half = max(1, ((size - 1).bit_length() + 1) // 2)
        mask, width, at = (1 << half) - 1, (half + 7) // 8, tweak.encode()
        while True:
            left, right = value >> half, value & mask
            for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
                if back:
                    left, right = right ^ (self.said(i, size, at, left, width) & mask), left
                else:
                    left, right = right, left ^ (self.said(i, size, at, right, width) & mask)
            value = left << half | right
            if value < size:
                return value

    def letters(self, text: str, tweak: str) -> str:
        """Every digit and letter is replaced by one of its own kind; case and other characters stay. Parts of PART characters depend on those before."""
        if len(text) > PART:
            parts = [text[i : i + PART] for i in range(0, len(text), PART)]
            before = ["", *(hashlib.blake2b(text[:i].lower().encode("utf-8", "surrogatepass"), key=self.key, digest_size=16).hexdigest() for i in range(PART, len(text), PART))]
            return "".join(self.letters(p, f"{tweak}|{b}") for p, b in zip(parts, before, strict=True))
        low = [c.lower() if len(c.lower()) == 1 else c for c in text]
        sets = [alphabet(c) for c in low]
        value, size = 0, 1
        for c, a in zip(low, sets, strict=True):
            if a:
                value, size = value * len(a) + a.index(c), size * len(a)
        value = self.number(value, size, f"{tweak}|{''.join(c if not a else a[0] for c, a in zip(low, sets, strict=True))}")
        out = []
        for c, a in zip(reversed(text), reversed(sets), strict=True):
            if a:
                value, i = divmod(value, len(a))
                out.append(up if c.isupper() and len(up := a[i].upper()) == 1 else a[i])
            else:
                out.append(c)
        return "".join(reversed(out))

    def email(self, text: str) -> str:
        name, _, domain = text.rpartition("@")
        rest, _, last = domain.rpartition(".")
        return f"{self.letters(name, 'name')}@{self.letters(rest, 'domain')}.{last}"

    def ip(self, text: str) -> str | None:
        parts = [int(x) for x in text.split(".")]
        if max(parts) > 255:
            return None
        return ".".join(map(str, self.number(int.from_bytes(bytes(parts)), 1 << 32, "ip").to_bytes(4)))

    def ipv6(self, text: str) -> str | None:
        try:
            at = ipaddress.IPv6Address(text)
        except ValueError:
            return None
        made = str(ipaddress.IPv6Address(self.number(int(at), 1 << 128, "ipv6")))
        return made.upper() if text.upper() == text and text.lower() != text else made

    def day(self, year: int, month: int, day: int) -> datetime.date | None:
        try:
            at = datetime.date(year, month, day).toordinal() - FIRST_DAY
        except ValueError:
            return None
        return datetime.date.fromordinal(FIRST_DAY + self.number(at, DAYS, "date")) if 0 <= at < DAYS else None

    def date(self, text: str) -> str | None:
        mark = re.search(r"\D", text)[0]
        parts = text.split(mark)
        for order in ("ymd",) if len(parts[0]) == 4 else ("dmy", "mdy"):
            named = dict(zip(order, map(int, parts), strict=True))
            if new := self.day(named["y"], named["m"], named["d"]):
                made = {"y": new.year, "m": new.month, "d": new.day}
                return mark.join(f"{made[k]:0{len(p)}d}" for k, p in zip(order, parts, strict=True))
        return None

    def named_date(self, day: str, mark: str, word: str, year: str) -> tuple[str, str, str, str] | None:
        """The same parts of the pseudonym's date, its month in the language, case and length of the given one."""
        if (found := MONTH_OF.get(word.lower())) is None or not (new := self.day(int(year), found[1], int(day))):
            return None
        name = found[0][new.month - 1]
        name = name.upper() if word.isupper() else name.capitalize() if word[0].isupper() else name
        ending = "th" if 11 <= new.day <= 13 else {1: "st", 2: "nd", 3: "rd"}.get(new.day % 10, "th")
        return f"{new.day:02d}" if day[0] == "0" else str(new.day), ending if mark.isalpha() else mark, name, f"{new.year:04d}"

    def ssn(self, text: str) -> str | None:
        digits = text.replace("-", "")
        good = lambda s: s[:3] not in ("000", "666") and s[0] != "9" and s[3:5] != "00" and s[5:] != "0000"
        if not good(digits):
            return None
        while True:
            digits = f"{self.number(int(digits), 10**9, 'ssn'):09d}"
            if good(digits):
                return laid(text, digits)

    def card(self, text: str) -> str | None:
        digits = re.sub(r"\D", "", text)
        if not luhn(digits) or not digits.strip("0"):
            return None
        body = f"{self.number(int(digits[:-1]), 10 ** (len(digits) - 1), 'card'):0{len(digits) - 1}d}"
        return laid(text, body + next(c for c in "0123456789" if luhn(body + c)))

    def digits(self, text: str) -> str:
        """Any number in any layout."""
        plain = re.sub(r"\D", "", text)
        return laid(text, f"{self.number(int(plain), 10 ** len(plain), 'digits'):0{len(plain)}d}")

    def phone(self, text: str) -> str | None:
        """The country's code stays; the rest is permuted in whatever layout, so that it is linked with the number without a code."""
        digits = re.sub(r"\D", "", text)
        code = 0 if text[0] != "+" else 1 if digits.startswith(CALLING_ONE) else 2 if digits[:2] in CALLING_TWO else 3
        kept, rest = digits[:code], digits[code:]
        if not 7 <= len(rest) <= 15 or (text[0] != "+" and digits[0] == "0" and not 9 <= len(digits) <= 12):
            return None
        if text[0] != "+" and rest[0] == "0":
            # The trunk prefix stays too.
            kept, rest = "0", rest[1:]
        return laid(text, kept + f"{self.number(int(rest), 10 ** len(rest), 'phone' + str(len(rest))):0{len(rest)}d}")

    def iban(self, text: str) -> str | None:
        plain = text.replace(" ", "")
        if not 15 <= len(plain) <= 34 or mod97(plain) != 1:
            return None
        body = self.letters(plain[4:], "iban" + plain[:2])
        new = f"{plain[:2]}{98 - mod97(plain[:2] + '00' + body):02d}{body}"
        return laid(text, new, r"[A-Z0-9]")


def laid(layout: str, chars: str, place: str = r"\d") -> str:
    """chars, one after the other, at the places of the layout."""
    it = iter(chars)
    return re.sub(place, lambda _: next(it), layout)


class Redactor:
    def __init__(self, key: bytes):
        self.permuter, self.known = Permuter(key), {}

    def swap(self, kind: str, value: str) -> str | None:
        at = (kind, value)
        if at not in self.known:
            if len(self.known) >= CACHE:
                self.known.clear()
            self.known[at] = getattr(self.permuter, kind)(value)
        return self.known[at]

    def emails(self, text: str) -> list[tuple[int, int, str, str]]:
        out, at, done = [], text.find("@"), 0
        while at >= 0:
            start = at
            while start > done and _LOCAL.match(text[start - 1]):
                start -= 1
            while start < at and not text[start].isalnum():
                start += 1
            end = at + 1
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                end = m.end()
                out.append((start, end, "email", self.swap("email", text[start:end])))
            done, at = end, text.find("@", end)
        return out

    def named_dates(self, text: str) -> list[tuple[int, int, str, str]]:
        out = []
        if not _YEAR(text):
            return out
        for m in DAY_FIRST.finditer(text):
            if new := self.permuter.named_date(m["day"], m["mark"] or "", m["word"], m["year"]):
                out.append((*m.span(), "date", f"{new[0]}{new[1]}{m['a']}{new[2]}{m['b']}{new[3]}"))
        for m in MONTH_FIRST.finditer(text):
            start = m.start()
            while start and m.start() - start <= LONGEST_MONTH and text[start - 1].isalpha():
                start -= 1
            if new := self.permuter.named_date(m["day"], m["mark"] or "", text[start : m.start()], m["year"]):
                out.append((start, m.end(), "date", f"{new[2]}{m['a']}{new[0]}{new[1]}{m['b']}{new[3]}"))
        return out

    def passing(self, kind: str, whole: str) -> tuple[str, str | None]:
        """What of a match passes its validation, and its pseudonym: behind a phone's number another one may follow after a space."""
        while not (new := self.swap(kind, whole)) and kind == "phone" and " " in whole:
            whole = whole.rpartition(" ")[0]
        return whole, new

    def overlapping(self, text: str, start: int, end: int) -> re.Match | None:
        """A card's number that begins behind the start of one that was found, and ends behind its end."""
        at = start + 1
        while at < end and (m := CARD.search(text, at, end + 40)) and m.start() < end:
            if m.end() > end and self.swap("card", m[0]):
                return m
            at = m.start() + 1
        return None

    def spans(self, text: str) -> list[tuple[int, int, str, str]]:
        """(start, end, kind, pseudonym), in order and without overlaps."""
        found = self.emails(text) if "@" in text else []
        if not _DIGIT(text):
            return found
        at = 0
        while m := NUMBER.search(text, at):
            kind, start = "date" if m.lastgroup in ("ymd", "dmy") else m.lastgroup, m.start()
            whole, new = self.passing(kind, m[0])
            if not new and kind == "card" and (p := PHONE.match(text, start)):
                kind, (whole, new) = "phone", self.passing("phone", p[0])
            if not new:
                # What fails may hide a number that begins within it, behind another one's digits.
                at = start + 1
                continue
            at = start + len(whole)
            more = self.overlapping(text, start, at) if kind in ("card", "phone") else None
            if more and ISSUER.match(more[0]) and (kind == "phone" or not ISSUER.match(whole)):
                # Of two readings the one is taken that begins as cards do, and has a check digit.
                at = more.start()
                continue
            found.append((start, at, kind, new))
            if more:
                # It can't be told which of the two is the card: the rest of the other one doesn't stay in clear either.
                found.append((at, more.end(), "card", self.swap("digits", text[at : more.end()])))
                at = more.end()
        found += self.named_dates(text)
        if ":" in text:
            found += [(*m.span(), "ip", new) for m in IPV6.finditer(text) if (new := self.swap("ipv6", m[0]))]
        at = 0
        while m := IBAN.search(text, at):
            # Upper-case words or another IBAN may follow after a space; the scan goes on behind the part that passes.
            whole, at = m[0], m.start() + 1
            while len(whole) >= 15:
                if new := self.swap("iban", whole):
                    at = m.start() + len(whole)
                    found.append((m.start(), at, "iban", new))
                    break
                whole = whole.rpartition(" ")[0]
        found.sort(key=lambda s: (s[0], -s[1]))
        out, end = [], 0
        for s in found:
            if s[0] >= end:
                out.append(s)
                end = s[1]
        return out

    def redact(self, text: str | None) -> tuple[str | None, dict[str, int]]:
        counts = dict.fromkeys(KINDS, 0)
        if not text:
            return text, counts
        parts, end = [], 0
        for start, stop, kind, new in self.spans(text):
            parts += [text[end:start], new]
            end, counts[kind] = stop, counts[kind] + 1
        return "".join([*parts, text[end:]]) if parts else text, counts


def pseudonymise(docs: DataFrame, key: bytes, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns, the text with its personal data replaced, and n_<kind> for each kind.

    key: a secret; who has it can take pseudonyms back. Null and empty texts stay as they are, with counts
    of 0; so do texts without personal data. Each row, repeated ones and those without an id too, is taken
    by itself; an empty table gives an empty result. Texts of any length are read whole. Columns that
    aren't carried don't reach the workers.
    """

    def make():
        redactor = Redactor(key)

        def f(texts):
            made = [redactor.redact(t) for t in texts]
            return [[m[0] for m in made], *([m[1][k] for m in made] for k in KINDS)]

        return f

    out = "_redacted"
    made = map_text(docs, make, [(out, T.StringType()), *((f"n_{k}", T.LongType()) for k in KINDS)], text, carry)
    return made.select(*carry, F.col(out).alias(text), *(f"n_{k}" for k in KINDS))
