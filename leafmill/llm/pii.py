"""PII: format-preserving Feistel pseudonyms of validated numbers, dates, addresses and secrets.

A value is found by a pattern, validated (Luhn sum, octets, area rules, mod 97, calendar), read as an integer of its
format's domain, keyed-permuted by a Feistel network within that domain (cycle-walking past values that the format
forbids), and written back with its own separators. Equal values get equal pseudonyms in every document and run, so they
stay linked; the key's holder can invert them (`Cipher(key, ...).back`). The work is a map over rows: no shuffle. The key
is a required argument. The registered query and the pipeline take it from the session's spark.leafmill.pii.secret; where
that is unset they draw a random one for the driver's life, so that no printed key can invert their output.

Kinds: card (13 to 19 digits, Luhn), ssn, phone, ipv4, date (day-month-year, year-month-day, month names), iban (mod
97), email, secret (cloud key ids, password, token and key assignments).

Defined cases: null text stays null, empty text stays empty; text without values is returned unchanged; where found values
overlap, secrets, addresses and account numbers go before plain numbers, and of these the one that begins first wins (of
one beginning, the shorter end); repeated rows are treated each; an empty table gives no row; other columns pass through
unchanged, whatever they are called (a count column that would clash gets underscores at its end); very long texts are
read whole.
"""

from __future__ import annotations

import datetime
import functools
import hashlib
import re
import secrets
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, small_batches, table

#: The session setting that holds the key (its name makes Spark hide it in its pages).
KEY_SETTING = "spark.leafmill.pii.secret"
ROUNDS = 8

MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]
DAY_ONE, DAYS = datetime.date(1900, 1, 1).toordinal(), datetime.date(2100, 1, 1).toordinal() - datetime.date(1900, 1, 1).toordinal()


class Cipher:
    """Keyed permutation of the integers below `size`."""

    def __init__(self, key: bytes, tweak: str, size: int) -> None:
        self.size = size
        self.a = int(size**0.5) if size < 1 << 40 else 1 << (size.bit_length() // 2)
        self.a = max(self.a, 1)
        self.b = -(-size // self.a)
        self.seed = hashlib.blake2b(f"{tweak}|{size}|".encode(), key=key[:64], digest_size=32).digest()

    def _round(self, i: int, x: int, m: int) -> int:
        n = (m.bit_length() + 71) // 8
        return int.from_bytes(hashlib.shake_256(self.seed + bytes([i]) + x.to_bytes((x.bit_length() + 8) // 8, "big")).digest(n), "big") % m

    def _once(self, x: int) -> int:
        l, r = divmod(x, self.b)
        for i in range(0, ROUNDS, 2):
            l = (l + self._round(i, r, self.a)) % self.a
            r = (r + self._round(i + 1, l, self.b)) % self.b
        return l * self.b + r

    def _undo(self, x: int) -> int:
        l, r = divmod(x, self.b)
        for i in range(ROUNDS - 2, -1, -2):
            r = (r - self._round(i + 1, l, self.b)) % self.b
            l = (l - self._round(i, r, self.a)) % self.a
        return l * self.b + r

    def forth(self, x: int, allowed: Callable[[int], bool] = lambda x: True) -> int:
        while True:
            x = self._once(x)
            if x < self.size and allowed(x):
                return x

    def back(self, x: int, allowed: Callable[[int], bool] = lambda x: True) -> int:
        while True:
            x = self._undo(x)
            if x < self.size and allowed(x):
                return x


def luhn_digit(body: str) -> str:
    d = [int(c) for c in reversed(body)]
    return str(-(sum(d[1::2]) + sum(sum(divmod(2 * x, 10)) for x in d[::2])) % 10)


def refill(shape: str, digits: str) -> str:
    """The shape with its digits replaced in order."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in shape)


def mixed(value: str) -> tuple[int, int, list[tuple[int, int, int]]]:
    """A string's ASCII letters and digits as one integer, its domain's size, and (place, base, first code) of each."""
    slots = [(i, 10, 48) if "0" <= c <= "9" else (i, 26, 97) if "a" <= c <= "z" else (i, 26, 65) for i, c in enumerate(value) if c.isascii() and c.isalnum()]
    x, size = 0, 1
    for i, base, first in slots:
        x, size = x * base + ord(value[i]) - first, size * base
    return x, size, slots


class Pseudonyms:
    """Finds and replaces values; back=True inverts."""

    #: Tried only where START, a plain character class, has found a digit, a plus or a bracket.
    START = re.compile(r"[+(\d]")
    NUMBERS = re.compile(
        r"(?P<ipv4>\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\d.]*\d))"
        r"|(?P<ymd>\d{4}([-/.])\d{1,2}\3\d{1,2}(?!\d))"
        r"|(?P<dmy>\d{1,2}([-/.])\d{1,2}\5\d{4}(?!\d))"
        r"|(?P<ssn>\d{3}-\d{2}-\d{4}(?![\d-]))"
        r"|(?P<card>\d{13,19}(?!\d)|\d{4}(?P<gap>[ -])\d{4}(?P=gap)\d{4}(?P=gap)\d{4}(?!\d)|\d{4}(?P<gap2>[ -])\d{6}(?P=gap2)\d{5}(?!\d))"
        r"|(?P<named>\d{1,2} (?:January|February|March|April|May|June|July|August|September|October|November|December) \d{4}(?!\d))"
        r"|(?P<phone>(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?!\d)|\+\d{8,15}(?!\d))"
    )
    KINDS = ("ipv4", "ymd", "dmy", "ssn", "card", "named", "phone")
    IBAN = re.compile(r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")
    EMAIL = re.compile(r"[A-Za-z0-9_][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
    SECRET = re.compile(r"AKIA[A-Z0-9]{16}(?![A-Z0-9])|(?:password|passwd|pwd|secret|token|api_?key)[\"']?\s*[=:]\s*[\"']?([A-Za-z0-9+/_.-]{8,})", re.I)

    def __init__(self, key: bytes, back: bool = False, most: int = 100_000) -> None:
        self.key, self.way, self.most = key, "back" if back else "forth", most
        self.ciphers: dict = {}
        self.known: dict = {}

    def permute(self, kind: str, size: int, x: int, allowed: Callable[[int], bool] = lambda x: True) -> int:
        c = self.ciphers.get((kind, size)) or self.ciphers.setdefault((kind, size), Cipher(self.key, kind, size))
        return getattr(c, self.way)(x, allowed)

    def digits(self, kind: str, d: str, allowed: Callable[[str], bool] = lambda d: True) -> str:
        n = len(d)
        return f"{self.permute(kind, 10**n, int(d), lambda x: allowed(f'{x:0{n}d}')):0{n}d}"

    def replace(self, kind: str, v: str) -> str | None:
        """Pseudonym of a value; None if it isn't valid."""
        if (kind, v) not in self.known:
            if len(self.known) >= self.most:
                self.known.clear()
            self.known[kind, v] = getattr(self, f"of_{kind}")(v)
        return self.known[kind, v]

    def of_ipv4(self, v: str) -> str | None:
        o = [int(x) for x in v.split(".")]
        ok = lambda x: x >> 24 > 0
        if max(o) > 255 or not ok(o[0] << 24):
            return None
        x = self.permute("ipv4", 1 << 32, int.from_bytes(bytes(o), "big"), ok)
        return ".".join(map(str, x.to_bytes(4, "big")))

    def day(self, y: int, m: int, d: int) -> datetime.date | None:
        try:
            n = datetime.date(y, m, d).toordinal() - DAY_ONE
        except ValueError:
            return None
        return datetime.date.fromordinal(self.permute("date", DAYS, n) + DAY_ONE) if 0 <= n < DAYS else None

    def of_ymd(self, v: str) -> str | None:
        t = self.day(*map(int, re.split(r"[-/.]", v)))
        return t and f"{t.year:04d}{v[4]}{t.month:02d}{v[4]}{t.day:02d}"

    def of_dmy(self, v: str) -> str | None:
        a, b, y = map(int, re.split(r"[-/.]", v))
        s, month_first = v[-5], a <= 12 < b
        t = self.day(y, a, b) if month_first else self.day(y, b, a)
        return t and (f"{t.month:02d}{s}{t.day:02d}{s}{t.year:04d}" if month_first else f"{t.day:02d}{s}{t.month:02d}{s}{t.year:04d}")

    def of_named(self, v: str) -> str | None:
        d, m, y = v.split(" ")
        t = self.day(int(y), MONTHS.index(m) + 1, int(d))
        return t and f"{t.day} {MONTHS[t.month - 1]} {t.year:04d}"

    def of_ssn(self, v: str) -> str | None:
        ok = lambda d: d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"
        d = v.replace("-", "")
        return refill(v, self.digits("ssn", d, ok)) if ok(d) else None

    def of_card(self, v: str) -> str | None:
        d = re.sub(r"\D", "", v)
        if luhn_digit(d[:-1]) != d[-1] or d[0] == "0":
            return None
        body = self.digits("card", d[:-1], lambda x: x[0] != "0")
        return refill(v, body + luhn_digit(body))

    def of_phone(self, v: str) -> str | None:
        d = re.sub(r"\D", "", v)
        if not 7 <= len(d) <= 15:
            return None
        n = min(10, len(d))  # the national number, so that one written with or without its country's code stays linked
        return refill(v, d[:-n] + self.digits("phone", d[-n:]))

    def of_iban(self, v: str) -> str | None:
        s = v.replace(" ", "")
        num = lambda t: int("".join(str(int(c, 36)) for c in t))
        if not 15 <= len(s) <= 34 or num(s[4:] + s[:4]) % 97 != 1:
            return None
        x, size, slots = mixed(s[4:])
        body = self.fill("iban", s[4:], x, size, slots)
        s = s[:2] + f"{98 - num(body + s[:2] + '00') % 97:02d}" + body
        it = iter(s)
        return "".join(c if c == " " else next(it) for c in v)

    def fill(self, kind: str, v: str, x: int, size: int, slots: list) -> str:
        x, out = self.permute(kind, size, x), list(v)
        for i, base, first in reversed(slots):
            x, r = divmod(x, base)
            out[i] = chr(first + r)
        return "".join(out)

    def of_email(self, v: str) -> str | None:
        head, dot, top = v.lower().rpartition(".")
        return self.fill("email", head, *mixed(head)) + dot + top

    def of_secret(self, v: str) -> str | None:
        head = "AKIA" if v.startswith("AKIA") else ""
        rest = v[len(head) :]
        x, size, slots = mixed(rest)
        return head + self.fill("secret", rest, x, size, slots) if slots else None

    def apply(self, text: str) -> tuple[str, Counter]:
        n: Counter = Counter()
        spans: list[tuple[int, int, str]] = []

        def found(kind: str, a: int, b: int, v: str) -> None:
            if (new := self.replace(kind, v)) is not None:
                spans.append((a, b, new))
                n["date" if kind in ("ymd", "dmy", "named") else kind] += 1

        def edit() -> str:
            nonlocal text
            out, at = [], 0
            for a, b, new in spans:
                out += [text[at:a], new]
                at = b
            text = "".join([*out, text[at:]]) if spans else text
            spans.clear()
            return text

        if "AKIA" in text or "=" in text or ":" in text:
            for m in self.SECRET.finditer(text):
                g = 1 if m[1] else 0
                found("secret", m.start(g), m.end(g), m[g])
        if "@" in text:
            for m in self.EMAIL.finditer(text):
                found("email", m.start(), m.end(), m[0])
        for m in self.IBAN.finditer(text):
            if not (m.start() and text[m.start() - 1].isalnum()):
                found("iban", m.start(), m.end(), m[0])
        spans.sort()
        spans[:] = drop_overlaps(spans)
        taken = [(a, b) for a, b, _ in spans]
        at, k = 0, 0
        while s := self.START.search(text, at):
            a = s.start()
            m = self.NUMBERS.match(text, a)
            if not m:
                at = a + 1
                while at < len(text) and text[at].isdigit():
                    at += 1
                continue
            b = m.end()
            while k < len(taken) and taken[k][1] <= a:
                k += 1
            before = text[a - 1] if a else " "
            if k < len(taken) and taken[k][0] < b:
                at = max(taken[k][1], a + 1)
            elif (before.isalnum() or before in "_.-" and a > 1 and text[a - 2].isdigit()) and text[a].isdigit():
                at = a + 1
                while at < len(text) and text[at].isdigit():
                    at += 1
            else:
                size = len(spans)
                found(next(k for k in self.KINDS if m[k]), a, b, m[0])
                at = b
                if len(spans) == size:  # not valid: go on behind its first run of digits
                    at = a + 1
                    while at < b and text[at].isdigit():
                        at += 1
        spans.sort()
        return edit(), n


def drop_overlaps(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    out, end = [], 0
    for s in spans:
        if s[0] >= end:
            out.append(s)
            end = s[1]
    return out


@functools.cache
def _drawn() -> bytes:
    return secrets.token_bytes(32)


def key_of(spark: SparkSession) -> bytes:
    """The key in the session's settings, or else one drawn for the life of this driver."""
    given = spark.conf.get(KEY_SETTING, None)
    return given.encode() if given else _drawn()


def pseudonymise(docs: DataFrame, key: bytes, text_col: str = "text", found_col: str | None = None) -> DataFrame:
    """docs with values in text_col replaced; found_col, if given, gets their number."""
    small_batches(docs.sparkSession)
    names = docs.columns
    d = docs.toDF(*[f"_lm_{i}" for i in range(len(names))])
    at = names.index(text_col)
    d = d.withColumn(f"_lm_{at}", F.col(f"_lm_{at}").cast("string"))
    kinds = [f"{c} {t}" for c, t in d.dtypes]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Pseudonyms(key)
        for b in batches:
            texts, n = [], []
            for t in b.column(at):
                new, c = p.apply(t.as_py()) if t.is_valid else (None, {})
                texts.append(new)
                n.append(sum(c.values()))
            cols = list(b.columns)
            cols[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n, pa.int64())], [*b.schema.names, "_lm_n"])

    out = d.mapInArrow(run, ", ".join([*kinds, "_lm_n long"]))
    out = out.select(*[F.col(f"_lm_{i}").alias(c) for i, c in enumerate(names)], *([F.col("_lm_n").alias(fresh(found_col, names))] if found_col else []))
    return out


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymise(docs, key_of(spark), found_col="n_values")


QUERIES = {"op8_pii": op8_pii}
SQL: dict[str, str] = {}
