"""Format-preserving Feistel pseudonyms for personal data.

Validated values are permuted within their format by a keyed Feistel network: e-mail
addresses (letters among letters, digits among digits, the last label kept), payment cards
(Luhn, the first digit kept and the last one recomputed), IBANs (mod 97), IPv4 addresses,
telephone numbers, social security numbers and calendar dates of 1900 to 2099. Outputs are
valid values of the same format, so that equal values stay linked across documents and
formats; with the key, reverse=True undoes the change. Values outside a format's domain
are walked on until they are inside again, which keeps the permutation one to one.

Defined cases: null texts stay null and empty ones empty; numbers that fail validation
(Luhn, mod 97, octets, calendar) are left alone, as are 0.0.0.0 and 127.x; repeated rows
are changed alike; texts are searched whole, however long; an empty table gives no rows.
Other columns stay, but for one named like the spans, which these replace. A day-first date
with slashes whose new day is 12 or less is written month first, as such dates are read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from datetime import date, timedelta
from hashlib import blake2b

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .shared import others

ROUNDS = 10
_FIRST_DAY, _DAYS = date(1900, 1, 1), (date(2100, 1, 1) - date(1900, 1, 1)).days

PATTERN = re.compile(
    r"(?P<email>(?<![\w.+%-])[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,24}(?![\w-]))"
    r"|(?P<iban>(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w))"
    r"|(?P<ip>(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\w|\.\d))"
    r"|(?P<card>(?<![\w+])(?:\d{4}(?P<c1>[ -])\d{4}(?P=c1)\d{4}(?P=c1)\d{1,7}|\d{4}(?P<c2>[ -])\d{6}(?P=c2)\d{4,5}|\d{13,19})(?!\w))"
    r"|(?P<phone>(?<!\w)\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}(?!\w)|(?<!\w)\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){1,4}(?!\w)"
    r"|(?<![\w(])(?:\([2-9]\d\d\) ?|[2-9]\d\d[ .-])[2-9]\d\d[ .-]\d{4}(?!\w|[.-]\d))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<date>(?<![\w./-])(?:\d{4}(?P<d1>[-/.])\d{1,2}(?P=d1)\d{1,2}|\d{1,2}(?P<d2>[-/.])\d{1,2}(?P=d2)\d{4})(?!\d|[./-]\d))"
)


class Pseudonyms:
    """Keyed permutations of formatted values; what was permuted is remembered for a while."""

    def __init__(self, key: str, reverse: bool = False) -> None:
        self.key, self.reverse, self.seen = blake2b(key.encode(), digest_size=32).digest(), reverse, {}

    def permute(self, kind: str, left: int, right: int, m_left: int, m_right: int) -> tuple[int, int]:
        """A permutation of pairs below (m_left, m_right)."""
        for i in reversed(range(ROUNDS)) if self.reverse else range(ROUNDS):
            other = right if i % 2 == 0 else left
            f = int.from_bytes(blake2b(f"{kind}|{m_left}|{m_right}|{i}|{other}".encode(), key=self.key, digest_size=32).digest(), "big")
            f = -f if self.reverse else f
            if i % 2 == 0:
                left = (left + f) % m_left
            else:
                right = (right + f) % m_right
        return left, right

    def walk(self, kind: str, value: int, size: int, good: Callable[[int], bool]) -> int:
        """A permutation of the good numbers below size."""
        m_left = 1
        while m_left * m_left < size:
            m_left += max(1, m_left // 8)
        m_right = -(-size // m_left)
        while True:
            a, b = self.permute(kind, value // m_right, value % m_right, m_left, m_right)
            value = a * m_right + b
            if value < size and good(value):
                return value

    def characters(self, kind: str, text: str) -> str:
        """Letters permuted among letters and digits among digits; all else stays in place."""
        radix = [10 if c.isdigit() else 26 if c.isalpha() else 1 for c in text]
        base = [48 if c.isdigit() else 65 if c.isupper() else 97 for c in text]
        half = len(text) // 2
        values = [1, 1]
        numbers = [0, 0]
        for i, c in enumerate(text):
            if radix[i] > 1:
                numbers[i >= half] = numbers[i >= half] * radix[i] + ord(c) - base[i]
                values[i >= half] *= radix[i]
        numbers = list(self.permute(f"{kind}|{radix}", *numbers, *values))
        out = list(text)
        for i in reversed(range(len(text))):
            if radix[i] > 1:
                numbers[i >= half], digit = divmod(numbers[i >= half], radix[i])
                out[i] = chr(base[i] + digit)
        return "".join(out)

    def change(self, kind: str, value: str) -> str | None:
        """The pseudonym of a value, or None if the value isn't valid."""
        if (kind, value) not in self.seen:
            if len(self.seen) > 100_000:
                self.seen.clear()
            self.seen[kind, value] = getattr(self, kind)(value)
        return self.seen[kind, value]

    def email(self, value: str) -> str:
        body, dot, last = value.rpartition(".")
        # case is kept letter by letter; addresses that differ in case only stay linked
        return self.characters("email", body) + dot + last

    def card(self, value: str) -> str | None:
        digits = re.sub(r"\D", "", value)
        if _luhn(digits) or not 13 <= len(digits) <= 19 or digits[0] == "0":
            return None
        n = len(digits) - 2
        body = digits[0] + f"{self.walk(f'card{digits[0]}', int(digits[1:-1]), 10**n, lambda v: True):0{n}d}"
        return _fill(value, body + str((10 - _luhn(body + "0")) % 10))

    def iban(self, value: str) -> str | None:
        plain = value.replace(" ", "")
        number = lambda s: int("".join(str(int(c, 36)) for c in s))
        if not 15 <= len(plain) <= 34 or number(plain[4:] + plain[:4]) % 97 != 1:
            return None
        body = self.characters(f"iban{plain[:2]}", plain[4:])
        out = iter(f"{plain[:2]}{98 - number(body + plain[:2] + '00') % 97:02d}{body}")
        return "".join(c if c == " " else next(out) for c in value)

    def ip(self, value: str) -> str | None:
        octets = [int(x) for x in value.split(".")]
        good = lambda v: 1 <= v >> 24 <= 223 and v >> 24 != 127
        number = int.from_bytes(bytes(octets), "big") if max(octets) < 256 else -1
        if number < 0 or not good(number) or any(x != str(int(x)) for x in value.split(".")):
            return None
        return ".".join(map(str, self.walk("ip", number, 1 << 32, good).to_bytes(4, "big")))

    def phone(self, value: str) -> str | None:
        digits = re.sub(r"\D", "", value)
        if not 7 <= len(digits) <= 15:
            return None
        code = (re.match(r"\+(\d{1,3})[ .(-]", value) or re.match(r"\+(\d{2})", value) or [None, ""])[1]
        rest = digits[len(code) :]
        if code in ("", "1") and len(rest) == 10:  # area and exchange begin with 2 to 9
            good = lambda v: v >= 2 * 10**9 and v // 10**6 % 10 >= 2
            if not good(int(rest)):
                return None
            return _fill(value, code + str(self.walk("phone1", int(rest), 10**10, good)))
        return _fill(value, code + f"{self.walk(f'phone{code}', int(rest), 10 ** len(rest), lambda v: True):0{len(rest)}d}") if rest else None

    def ssn(self, value: str) -> str | None:
        def good(v: int) -> bool:
            return 0 < v // 10**6 < 900 and v // 10**6 != 666 and v // 10**4 % 100 > 0 and v % 10**4 > 0

        number = int(value.replace("-", ""))
        return _fill(value, f"{self.walk('ssn', number, 10**9, good):09d}") if good(number) else None

    def date(self, value: str) -> str | None:
        parts = re.split(r"([-/.])", value)
        a, b, c = parts[::2]
        order = "ymd" if len(a) == 4 else "mdy" if parts[1] == "/" and int(a) <= 12 else "dmy"
        found = dict(zip(order, (a, b, c), strict=True))
        try:
            day = date(int(found["y"]), int(found["m"]), int(found["d"]))
        except ValueError:
            return None
        number = (day - _FIRST_DAY).days
        if not 0 <= number < _DAYS:
            return None
        new = _FIRST_DAY + timedelta(days=self.walk("date", number, _DAYS, lambda v: True))
        if parts[1] == "/" and order != "ymd":
            order = "mdy" if new.day <= 12 or order == "mdy" else "dmy"
        wide = len(a) == len(b) == 2 or len(b) == len(c) == 2
        text = {"y": f"{new.year:04d}", "m": f"{new.month:0{2 if wide else 1}d}", "d": f"{new.day:0{2 if wide else 1}d}"}
        return parts[1].join(text[k] for k in order)


def _luhn(digits: str) -> int:
    """0 for a number that passes the Luhn check."""
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10


def _fill(value: str, digits: str) -> str:
    """The digits in the places of those of value."""
    new = iter(digits)
    return re.sub(r"\d", lambda _: next(new), value)


def replace_all(text: str, names: Pseudonyms) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and (kind, start, length) of each in it."""
    out, spans, at, size = [], [], 0, 0
    for m in PATTERN.finditer(text):
        if (new := names.change(m.lastgroup, m[0])) is not None:
            out += [text[at : m.start()], new]
            size += m.start() - at
            spans.append((m.lastgroup, size, len(new)))
            size += len(new)
            at = m.end()
    return ("".join([*out, text[at:]]), spans) if spans else (text, spans)


def pseudonymise(df: DataFrame, key: str, text: str = "text", spans: str = "pii", reverse: bool = False) -> DataFrame:
    """Replace personal data in a text column; spans gets an array of (kind, start, length) in the new text."""
    df = df.select(*others(df, spans))
    names, at = df.columns, df.columns.index(text)
    schema = df.select("*", F.lit(None).cast("array<struct<kind:string,start:int,length:int>>").alias(spans)).schema
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("length", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pseudonyms = Pseudonyms(key, reverse)
        for batch in batches:
            column = batch.column(at)
            may = pc.match_substring_regex(column, r"[0-9@]").to_pylist()  # no format lacks both
            texts, found = [], []
            changed = False
            for x, some in zip(column, may, strict=True):
                new, own = replace_all(x.as_py(), pseudonyms) if some else (None, [])
                changed |= bool(own)
                texts.append(new if own else None)
                found.append([{"kind": k, "start": s, "length": n} for k, s, n in own])
            columns = list(batch.columns)
            if changed:
                columns[at] = pc.coalesce(pa.array(texts, column.type), column)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, kind)], names=[*names, spans])

    return df.mapInArrow(tx.giving_back(run), schema)
