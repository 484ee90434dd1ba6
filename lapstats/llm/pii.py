"""Format-preserving Feistel pseudonyms for personal data (operator 3).

Values are found by pattern, checked (card and IBAN check digits, calendar dates, telephone
and social security number plans, address octets), turned into a number within their format,
and permuted by a keyed Feistel network over exactly that range, walking the cycle until the
result is valid too. The pseudonym has the same format and length class and passes the same
check; equal values have equal pseudonyms in every document, whatever their separators, and
the holder of the key can invert them. Mail names and credentials are permuted character
class by character class.

A telephone number with a country code or an area code in parentheses counts whatever its
leading digits: one that breaks the North American plan is permuted among those that break
it. Other numbers with + keep their country code; their other digits are permuted. Ten bare
digits that break the plan are left alone.

A map over rows: no shuffle, no state. Defined cases: null and empty texts stay as they are;
values that fail their check are left alone; repeated rows change alike; other columns stay.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import extend, map_arrow

ROUNDS = 8
FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
BLOCK = 64      # characters of a credential permuted as one number: a half fits the 192 bits of a round
DAYS = datetime.date(2100, 1, 1).toordinal() - FIRST_DAY
QUICK = re.compile(r"[0-9@]")
TWO_DIGITS = set("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 "
                 "81 82 84 86 90 91 92 93 94 95 98".split())      # country codes; 1 and 7 have one digit, others three

PATTERN = re.compile(r"""
  (?P<email>(?<![\w.+-])[A-Za-z0-9][\w.+-]{0,63}@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,24}(?![\w-]))
| (?P<aws>(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9]))
| (?P<secret>(?i:(?<![A-Za-z])(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)["']?\s{0,3}[:=]\s{0,3}["']?)(?P<value>[A-Za-z0-9_\-/+]{12,}))
| (?P<iban>(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))
| (?P<date>(?<![\d.,/-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![\d/-]|[.,]\d))
| (?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))
| (?P<ip>(?<![\w.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\w|\.\d))
| (?P<phone>(?<![\w+])(?:\+?1[ .-]?)?(?:\(\d{3}\)[ ]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\w))
| (?P<intl>(?<![\w+])\+(?![2-689]\.)[1-9](?:[ ./-]?\(?\d\)?){7,14}(?!\w))
| (?P<card>(?<![\w-])(?:\d{13,19}|\d{4}(?P<sep>[ -])\d{4}(?P=sep)\d{4}(?P=sep)\d{1,7}|\d{4}(?P<sep2>[ -])\d{6}(?P=sep2)\d{5})(?!\w))
""", re.X)


class Cipher:
    """A keyed permutation of range(n) for every n, kind and direction."""

    def __init__(self, key: bytes):
        if not key:
            raise ValueError("a key is needed")
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, kind: str, n: int, i: int, value: int, size: int) -> int:
        data = f"{kind}/{n}/{i}/{value}".encode()
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=24).digest(), "little") % size

    def permute(self, kind: str, n: int, x: int, back: bool = False) -> int:
        """Feistel rounds on the digits of x in a mixed base a * b >= n, repeated while the
        result lies outside range(n)."""
        if n < 2:
            return x
        a = isqrt(n - 1) + 1
        b = -(-n // a)
        while True:
            left, right = divmod(x, b)
            for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
                if i % 2 == 0:
                    f = self._round(kind, n, i, right, a)
                    left = (left - f if back else left + f) % a
                else:
                    f = self._round(kind, n, i, left, b)
                    right = (right - f if back else right + f) % b
            x = left * b + right
            if x < n:
                return x


def luhn_digit(digits: str) -> str:
    """The check digit that follows these digits."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def iban_check(country: str, bban: str) -> str:
    number = int("".join(str(int(c, 36)) for c in bban + country + "00"))
    return f"{98 - number % 97:02d}"


def refill(template: str, chars: str) -> str:
    """The characters in place of the letters and digits of a template."""
    it = iter(chars)
    return "".join(next(it) if c.isalnum() else c for c in template)


def by_class(cipher: Cipher, kind: str, value: str, back: bool) -> str:
    """Permute a string among those with the same class (digit, upper, lower) at each place."""
    bases = [(10, "0") if c in "0123456789" else (26, "A") if "A" <= c <= "Z" else (26, "a") if "a" <= c <= "z" else (1, c)
             for c in value]
    n, x = 1, 0
    for (size, zero), c in zip(bases, value):
        n, x = n * size, x * size + ord(c) - ord(zero)
    x = cipher.permute(kind, n, x, back)
    out = []
    for size, zero in reversed(bases):
        x, d = divmod(x, size)
        out.append(chr(ord(zero) + d))
    return "".join(reversed(out))


def phone_number(digits: str) -> bool:
    return digits[0] in "23456789" and digits[3] in "23456789"


def ssn_number(digits: str) -> bool:
    return digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000"


def walk(cipher, kind, digits, valid, back):
    """Permute digits until the result is valid; a permutation of the valid numbers."""
    while True:
        digits = f"{cipher.permute(kind, 10 ** len(digits), int(digits), back):0{len(digits)}d}"
        if valid(digits):
            return digits


def pseudonym(cipher: Cipher, kind: str, value: str, back: bool = False) -> str | None:
    """The pseudonym of a found value, or None where it fails its check."""
    digits = re.sub(r"\D", "", value)
    if kind == "card":
        if luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
            return None
        body = walk(cipher, kind, digits[1:-1], lambda d: True, back)
        return refill(value, digits[0] + body + luhn_digit(digits[0] + body))
    if kind == "phone":
        number = digits[-10:]
        if phone_number(number):
            return refill(value, digits[:-10] + walk(cipher, kind, number, phone_number, back))
        if len(digits) == 10 and "(" not in value:
            return None
        return refill(value, digits[:-10] + walk(cipher, kind, number, lambda d: not phone_number(d), back))
    if kind == "intl":
        n = 1 if digits[0] in "17" else 2 if digits[:2] in TWO_DIGITS else 3
        return refill(value, digits[:n] + walk(cipher, kind + digits[:n], digits[n:], lambda d: True, back))
    if kind == "ssn":
        return refill(value, walk(cipher, kind, digits, ssn_number, back)) if ssn_number(digits) else None
    if kind == "ip":
        octets = [int(p) for p in value.split(".")]
        if max(octets) > 255 or any(len(p) > 1 and p[0] == "0" for p in value.split(".")):
            return None
        x = cipher.permute(kind, 1 << 32, int.from_bytes(bytes(octets), "big"), back)
        return ".".join(map(str, x.to_bytes(4, "big")))
    if kind == "date":
        sep = "/" if "/" in value else "." if "." in value else "-"
        order = "%Y{0}%m{0}%d" if value[4] == sep else "%d{0}%m{0}%Y"
        for form in (order, "%m{0}%d{0}%Y")[:2 if sep == "/" and value[4] != sep else 1]:
            try:
                day = datetime.datetime.strptime(value, form.format(sep)).date().toordinal() - FIRST_DAY
            except ValueError:
                continue
            while 0 <= day < DAYS:
                day = cipher.permute(kind, DAYS, day, back)
                new = datetime.date.fromordinal(FIRST_DAY + day)
                # month first is only read where day first fails, so that must stay so
                if form == order or new.day > 12:
                    return new.strftime(form.format(sep))
        return None
    if kind == "iban":
        plain = value.replace(" ", "")
        if iban_check(plain[:2], plain[4:]) != plain[2:4]:
            return None
        bban = by_class(cipher, kind, plain[4:], back)
        return refill(value, plain[:2] + iban_check(plain[:2], bban) + bban)
    if kind == "email":
        name, _, domain = value.partition("@")
        return by_class(cipher, kind, name, back) + "@" + domain
    if kind == "aws":
        return value[:4] + by_class(cipher, kind, value[4:], back)
    n = -(-len(value) // BLOCK)
    cuts = [len(value) * i // n for i in range(n + 1)]
    return "".join(by_class(cipher, f"{kind}/{i}" if i else kind, value[a:b], back)
                   for i, (a, b) in enumerate(zip(cuts, cuts[1:])))


def replace(text: str, cipher: Cipher, back: bool = False) -> tuple[str, list[dict]]:
    """(new text, [{kind, start, end}] in the original text)."""
    out, at, found = [], 0, []
    for m in PATTERN.finditer(text):
        kind = m.lastgroup if m.lastgroup not in ("value", "sep", "sep2") else "secret" if m["secret"] else "card"
        group = "value" if kind == "secret" else kind
        new = pseudonym(cipher, kind, m[group], back)
        if new is not None:
            a, b = m.span(group)
            out += [text[at:a], new]
            at = b
            found.append({"kind": "phone" if kind == "intl" else kind, "start": a, "end": b})
    return ("".join(out) + text[at:], found) if found else (text, found)


def pseudonymise(df: DataFrame, key: bytes, text: str = "text", back: bool = False) -> DataFrame:
    """``df`` with its text under pseudonyms, and pii: kind and original place of each value."""
    src = df.drop("pii")
    schema = extend(src.schema, "pii array<struct<kind:string,start:int,end:int>>")
    names = schema.names

    def run(batches):
        cipher = Cipher(key)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            done = [replace(t, cipher, back) if t and QUICK.search(t) else (t, [])
                    for t in batch.column(text).to_pylist()]
            cols = {n: batch.column(n) for n in names if n != "pii"}
            cols[text] = pa.array([d[0] for d in done], pa.string())
            cols["pii"] = pa.array([d[1] for d in done], kind)
            yield pa.RecordBatch.from_arrays([cols[n] for n in names], names=names)

    return map_arrow(src, run, schema)


KEY_CONF = "spark.lapstats.pii.key"
DEMO_KEY = b"registered query: set your own key"


def session_key(spark) -> bytes:
    """The key in ``spark.lapstats.pii.key``; the public one only where the session has none, as
    for the registered query on test tables. Whoever knows the key can undo the pseudonyms."""
    found = spark.conf.get(KEY_CONF, None)
    return found.encode() if found else DEMO_KEY


def op3_pii(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pseudonymise(docs, session_key(spark))


def stage(spark, docs: DataFrame, sf_dir) -> DataFrame:
    """Pipeline stage: the documents with pseudonyms in their texts."""
    return pseudonymise(docs, session_key(spark)).select(*docs.columns)
