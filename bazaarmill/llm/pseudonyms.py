"""Format-preserving pseudonyms for personal values.

Values are found by their form and validated: card numbers by their check digit and length, bank account numbers by theirs, phone
numbers and social security numbers by their digit groups, dates by the calendar, network addresses by their ranges, mail
addresses and secrets by their parts. A validated value is written as a number or a row of letters and digits and permuted by
a keyed Feistel network on exactly that many values; a result that is no valid value of the kind is permuted again until one is.
So each kind maps one to one onto itself, the new value has the old one's length, separators and check digit, and equal
values get equal pseudonyms in all documents, however they are separated. Without the key none can be taken back;
``recover`` takes back with it.

A card number may stand next to other digits: all runs of whole digit groups are tried, the longest first. Pseudonyms keep the number's
effect on the check digit of digits around it, so a longer run is valid before and after alike. Where another run of the
same length or more shares only some of its groups, that one can become valid, and ``recover`` then takes back that one.
A date may be followed by ``T`` and a time.

Digits, check digits and separators that belong to the format stay: a phone number's country code, an account's country,
a mail address's host. Values that do not validate are left alone: version numbers, prices and other digits are not personal; nor are digits of
other scripts, which no kind reads.

Cases: a null text stays null; texts without values stay as they are; overlapping finds are resolved by the order of kinds,
then by place; equal rows give equal rows; texts are read whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import blake2b

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import read

KEY = b"a key for tests; give your own"
ROUNDS = 10


class Feistel:
    """A keyed permutation of the numbers below ``size``."""

    def __init__(self, key: bytes, kind: str, size: int):
        # Two halves whose product is the smallest one that holds the size; larger numbers are walked past.
        self.a = max(2, int(size**0.5))
        while self.a * self.a < size:
            self.a += 1
        self.b = -(-size // self.a)
        self.size = size
        self.key, self.kind = key, kind.encode()

    def mask(self, turn: int, half: int) -> int:
        text = b"%b:%d:%d:%d" % (self.kind, self.size, turn, half)
        return int.from_bytes(blake2b(text, key=blake2b(self.key, digest_size=32).digest(), digest_size=24).digest(), "big")

    def turn(self, x: int, back: bool) -> int:
        left, right = x // self.b, x % self.b
        for k in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if k % 2:
                right = (right + sign * self.mask(k, left)) % self.b
            else:
                left = (left + sign * self.mask(k, right)) % self.a
        return left * self.b + right

    def __call__(self, x: int, valid: Callable[[int], bool] = lambda x: True, back: bool = False) -> int:
        """The pseudonym of ``x`` among the valid numbers; ``x`` itself is one."""
        while True:
            x = self.turn(x, back)
            if x < self.size and valid(x):
                return x


def check_digit(digits: str) -> int:
    total = sum(sum(divmod(int(c) * (2 - i % 2), 10)) for i, c in enumerate(reversed(digits)))
    return -total % 10


def refill(shape: str, new: str) -> str:
    """The characters of ``new`` in the places of the letters and digits of ``shape``."""
    it = iter(new)
    return "".join(next(it) if c.isalnum() else c for c in shape)


def bare(text: str) -> str:
    return "".join(c for c in text if c.isalnum())


@dataclass(frozen=True)
class Kind:
    """A form of values: where to look, and how a find is permuted; ``permute`` gives None for a value that is not valid."""

    name: str
    pattern: re.Pattern
    permute: Callable[[str, bytes, bool], str | None]
    #: Start and end of finds to try in order, where one match of the pattern for each place is not enough.
    places: Callable[[str], Iterator[tuple[int, int]]] | None = None

    def tried(self, text: str) -> Iterator[tuple[int, int]]:
        return self.places(text) if self.places else (m.span() for m in self.pattern.finditer(text))


def card(text: str, key: bytes, back: bool) -> str | None:
    d = bare(text)
    if not 13 <= len(d) <= 19 or check_digit(d[:-1]) != int(d[-1]) or d[0] not in "23456" or len(set(d)) == 1:
        return None
    n = len(d) - 1
    low, after = 10 ** (n - 1), check_digit(d)

    def fits(v: int) -> bool:
        """Cards on which digits before or after have the same effect: so a longer find is valid before and after, or never."""
        own = str(v)
        if v < low or own[0] not in "23456":
            return False
        own += str(check_digit(own))
        return len(set(own)) > 1 and check_digit(own) == after

    x = Feistel(key, "card", 10**n)(int(d[:-1]), fits, back)
    return refill(text, f"{x}{check_digit(str(x))}")


def card_places(text: str) -> Iterator[tuple[int, int]]:
    """Where 13 to 19 digits stand between the edges of their groups, the longest of a chain of groups first."""
    for chain in re.finditer(r"\d(?:[ -]?\d){12,}", text):
        groups = [(m.start() + chain.start(), m.end() + chain.start()) for m in re.finditer(r"\d+", chain[0])]
        ends = [not re.match(r"[\w-]|\.\d", text[b : b + 2]) for _, b in groups]
        found = []
        for i, (a, _) in enumerate(groups):
            if a and re.match(r"[\w.-]", text[a - 1]):
                continue
            n = 0
            for (x, b), end in zip(groups[i : i + 19], ends[i : i + 19]):
                n += b - x
                if n > 19:
                    break
                if n >= 13 and end:
                    found.append((-n, a, b))
        yield from ((a, b) for _, a, b in sorted(found))


def account(text: str, key: bytes, back: bool) -> str | None:
    """International bank account numbers: the country and the pattern of letters and digits stay, check digits follow."""
    v = bare(text).upper()
    number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if not 15 <= len(v) <= 34 or number(v[4:] + v[:4]) % 97 != 1:
        return None
    body = spell(v[4:], "iban" + v[:2], key, back)
    return refill(text, f"{v[:2]}{98 - number(body + v[:2] + '00') % 97:02d}{body}")


def spell(text: str, kind: str, key: bytes, back: bool) -> str:
    """Letters become letters of their case, digits digits: one permutation over the whole row."""
    base = [10 if c.isdigit() else 26 for c in text]
    size, x = 1, 0
    for c, b in zip(text, base):
        x = x * b + (int(c) if b == 10 else ord(c.lower()) - 97)
        size *= b
    shape = "".join("9" if b == 10 else "a" for b in base)
    x = Feistel(key, f"{kind}:{shape}", size)(x, back=back) if size > 1 else x
    out = []
    for c, b in zip(reversed(text), reversed(base)):
        x, r = divmod(x, b)
        out.append(str(r) if b == 10 else chr(r + (65 if c.isupper() else 97)))
    return "".join(reversed(out))


def phone(text: str, key: bytes, back: bool) -> str | None:
    d = bare(text)
    plus = text.lstrip().startswith("+")
    if plus and d[:1] != "1":
        # a number of another country: its first digits stay, the last eight or fewer are permuted
        keep = max(2, len(d) - 8)
        if not 8 <= len(d) <= 15:
            return None
        n = len(d) - keep
        return refill(text, d[:keep] + f"{Feistel(key, f'phone:{d[:keep]}', 10**n)(int(d[keep:]), back=back):0{n}d}")
    # North American numbers by their groups alone: texts have many whose area was never assigned
    head, own = d[:-10], d[-10:]
    if len(own) != 10 or head not in ("", "1"):
        return None
    return refill(text, f"{head}{Feistel(key, 'phone', 10**10)(int(own), back=back):010d}")


def social(text: str, key: bytes, back: bool) -> str | None:
    fits = lambda v: f"{v:09d}"[:3] not in ("000", "666") and v < 900_000_000 and f"{v:09d}"[3:5] != "00" and f"{v:09d}"[5:] != "0000"
    d = bare(text)
    return refill(text, f"{Feistel(key, 'social', 10**9)(int(d), fits, back):09d}") if fits(int(d)) else None


def network(text: str, key: bytes, back: bool) -> str | None:
    """Addresses of four parts; those that name no host but every machine's own, or all, stay."""
    part = [int(p) for p in text.split(".")]

    def fits(p: list[int]) -> bool:
        return p not in ([0, 0, 0, 0], [127, 0, 0, 1], [255, 255, 255, 255])

    if any(p > 255 for p in part) or any(len(p) > 1 and p[0] == "0" for p in text.split(".")):
        return None
    # parts of one, two and three digits stay such: a number with the base of each part
    low = [(0, 10, 100)[len(x) - 1] for x in text.split(".")]
    base = [(10, 90, 156)[len(x) - 1] for x in text.split(".")]

    def parts(x: int) -> list[int]:
        out = []
        for b, n in zip(reversed(base), reversed(low)):
            x, r = divmod(x, b)
            out.append(r + n)
        return out[::-1]

    if not fits(part):
        return None
    v = 0
    for x, b, n in zip(part, base, low):
        v = v * b + x - n
    size = base[0] * base[1] * base[2] * base[3]
    return ".".join(map(str, parts(Feistel(key, f"network:{low}", size)(v, lambda y: fits(parts(y)), back))))


DAYS = (dt.date(1900, 1, 1), dt.date(2099, 12, 31))


def date(text: str, key: bytes, back: bool) -> str | None:
    """Days from 1900 to 2099; the order of day, month and year and the separators stay."""
    p = re.findall(r"[0-9]+", text)
    y, m, d = (0, 1, 2) if len(p[0]) == 4 else (2, 1, 0) if "." in text or int(p[0]) > 12 else (2, 0, 1)
    try:
        day = dt.date(int(p[y]), int(p[m]), int(p[d]))
    except ValueError:
        return None
    if not DAYS[0] <= day <= DAYS[1]:
        return None
    padded = len(p[m]) == 2 and len(p[d]) == 2
    # Dates written without zeros stay among those that need none, so that lengths and links hold.
    fits = (lambda v: True) if padded else (lambda v: plain(DAYS[0] + dt.timedelta(v)))
    plain = lambda x: len(str(x.month)) == len(p[m]) and len(str(x.day)) == len(p[d])
    if not fits((day - DAYS[0]).days):
        return None
    new = DAYS[0] + dt.timedelta(Feistel(key, "date", (DAYS[1] - DAYS[0]).days + 1)((day - DAYS[0]).days, fits, back))
    parts = ["", "", ""]
    parts[y], parts[m], parts[d] = f"{new.year:04d}", f"{new.month:0{len(p[m])}d}", f"{new.day:0{len(p[d])}d}"
    return refill(text, "".join(parts))


def mail(text: str, key: bytes, back: bool) -> str | None:
    name, _, host = text.rpartition("@")
    own = "".join(c for c in name if c.isascii() and c.isalnum())
    if not own or own != bare(name):
        return None
    return refill(name, spell(own, f"mail:{host.lower()}", key, back)) + "@" + host


def secret(text: str, key: bytes, back: bool) -> str | None:
    """Access keys and the values of assignments; hexadecimal ones stay so."""
    m = re.fullmatch(r"(AKIA)([0-9A-Z]{16})|(.*?[:=]\s*[\"']?)([\w+/-]{8,})", text, re.S)
    if m is None:
        return None
    head, value = (m[1], m[2]) if m[1] else (m[3], m[4])
    own = bare(value)
    if not own.isascii() or not any(c.isdigit() for c in own):
        return None
    if not m[1] and re.fullmatch(r"[0-9a-f]+", own):
        n = len(own)
        return head + refill(value, f"{Feistel(key, 'secret:hex', 16**n)(int(own, 16), back=back):0{n}x}")
    return head + refill(value, spell(own, "secret", key, back))


KINDS = (
    Kind("secret", re.compile(r"\b(?-i:AKIA[0-9A-Z]{16})\b|\b(?:password|passwd|pwd|token|secret|api[_-]?key)\s*[:=]\s*[\"']?[\w+/-]{8,}", re.I), secret),
    Kind("mail", re.compile(r"(?<![\w.+-])[\w.+-]{1,64}@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?!\w)"), mail),
    Kind("account", re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?!\w)"), account),
    Kind("network", re.compile(r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])(?!\w)"), network),
    Kind("date", re.compile(r"(?<![\w./-])(?:[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-/.])[0-9]{1,2}\2[0-9]{4})(?:(?![\w/-])(?!\.[0-9])|(?=T[0-9]{2}(?::?[0-9]{2}){0,2}(?![0-9])))"), date),
    Kind("social", re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"), social),
    Kind("card", re.compile(r"(?<![\w.-])[0-9](?:[ -]?[0-9]){12,18}(?![\w-])(?!\.[0-9])"), card, card_places),
    Kind("phone", re.compile(r"(?<![\w.])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![\w-])|(?<![\w.])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}(?![\w-])"), phone),
)
#: A text without any of these has no value of any kind.
LIKELY = re.compile(r"\d|@")


def pseudonymise(text: str | None, key: bytes, back: bool = False) -> tuple[str | None, list[tuple[str, int, int]]]:
    """The text with its values replaced, and (kind, start, end) of each in the original."""
    if not text or not LIKELY.search(text):
        return text, []
    found: list[tuple[int, int, str, str]] = []
    for kind in KINDS:
        for start, end in kind.tried(text):
            if any(a < end and start < b for a, b, *_ in found):
                continue
            new = kind.permute(text[start:end], key, back)
            if new is not None:
                found.append((start, end, kind.name, new))
    found.sort()
    parts, at = [], 0
    for a, b, _, new in found:
        parts += [text[at:a], new]
        at = b
    return "".join([*parts, text[at:]]), [(kind, a, b) for a, b, kind, _ in found]


def recover(text: str | None, key: bytes) -> str | None:
    return pseudonymise(text, key, back=True)[0]


def with_pseudonyms(docs: DataFrame, name: str, key: bytes = KEY) -> DataFrame:
    """``docs`` and a column ``name``: struct(text, kinds, spans) with the new text and each value's kind and place."""

    @F.pandas_udf("text string, kinds array<string>, spans array<long>")
    def replaced(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for b in texts:
            rows = [pseudonymise(t, key) for t in b]
            yield pd.DataFrame({"text": [r[0] for r in rows], "kinds": [[k for k, *_ in r[1]] for r in rows], "spans": [[x for _, *s in r[1] for x in s] for r in rows]})

    return docs.withColumn(name, replaced("text"))


def op6_pseudonyms(spark: SparkSession, root: str) -> DataFrame:
    docs = read(spark, root, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = with_pseudonyms(docs, "p")
    return found.select("doc_id", "p.text", F.size("p.kinds").cast("long").alias("n_values"), F.array_join(F.array_sort(F.array_distinct("p.kinds")), ",").alias("kinds"))
