"""Format-preserving pseudonyms for personal data by a keyed Feistel permutation.

Numbers that pass their check, calendar dates, addresses and the local parts of e-mail addresses
are replaced by others of the same format. The replacement is a permutation of all values of that
format, so equal values get equal pseudonyms in every document, different values different ones,
and the holder of the key can go back.
"""

from __future__ import annotations

import datetime
import hashlib
import ipaddress
import math
import re
import warnings
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from veilframe.llm.shared import documents, small_batches
from veilframe.llm.words import groups

ROUNDS = 10
#: Where a session holds the key, and what the query uses where it is unset. The latter is public, so it protects nothing.
KEY_SETTING, PUBLIC_KEY = "spark.veilframe.pseudonyms.key", b"veilframe: replace by a secret of your own"
KINDS = ["email", "phone", "card", "ip", "ssn", "iban", "date"]
#: Characters of an IBAN by country, from the SWIFT registry.
IBAN_LENGTHS = {
    c: n
    for n, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
        26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
        31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for c in countries.split()
}
# Country calling codes of one and of two digits (ITU-T E.164); all others have three.
_ONE_DIGIT = "1 7".split()
_TWO_DIGITS = "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
_FIRST_DAY, _DAYS = datetime.date(1900, 1, 1).toordinal(), 73_049  # to the end of 2099
_ALPHABETS = [
    "0123456789",
    "abcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7),
    "".join(chr(c) for c in range(0xC0, 0xDF) if c != 0xD7),
]
_CLASS = {c: a for a in _ALPHABETS for c in a}


class Feistel:
    """A keyed permutation of 0 .. size - 1 for each size and tweak."""

    def __init__(self, key: bytes = PUBLIC_KEY) -> None:
        self.key = hashlib.sha256(key).digest()

    def _round(self, i: int, half: int, width: int, tweak: str) -> int:
        said = f"{tweak}|{width}|{i}|{half}".encode()
        return int.from_bytes(hashlib.blake2b(said, key=self.key, digest_size=min(64, 16 + width.bit_length() // 8)).digest(), "big") % width

    def _once(self, value: int, width: int, tweak: str, back: bool) -> int:
        """A permutation of pairs below width: each round adds a function of one half to the other."""
        left, right = divmod(value, width)
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            if back:
                left, right = (right - self._round(i, left, width, tweak)) % width, left
            else:
                left, right = right, (left + self._round(i, right, width, tweak)) % width
        return left * width + right

    def permute(self, value: int, size: int, tweak: str, back: bool = False, allowed: Callable[[int], bool] = lambda v: True) -> int:
        """Walks the cycle of a slightly larger permutation until it is back among the allowed values."""
        width = math.isqrt(size - 1) + 1 if size > 1 else 1
        while True:
            value = self._once(value, width, tweak, back)
            if value < size and allowed(value):
                return value


def luhn_digit(digits: str) -> int:
    """The digit that completes digits to a Luhn number."""
    total = sum(sum(divmod(int(d) * (2 - i % 2), 10)) for i, d in enumerate(reversed(digits)))
    return -total % 10


def _fill(shape: str, new: str, member: Callable[[str], bool] = str.isdigit) -> str:
    """shape with its members replaced one by one; separators stay."""
    it = iter(new)
    return "".join(next(it) if member(c) else c for c in shape)


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def _email(f: Feistel, text: str, back: bool) -> str | None:
    local, _, domain = text.partition("@")
    spots = [c for c in local if c in _CLASS]
    if not spots:
        return None
    size = value = 1
    value = 0
    for c in spots:
        a = _CLASS[c]
        value, size = value * len(a) + a.index(c), size * len(a)
    shape = "".join(str(_ALPHABETS.index(_CLASS[c])) if c in _CLASS else c for c in local)
    value, new = f.permute(value, size, "email" + shape, back), []
    for c in reversed(spots):
        value, r = divmod(value, len(_CLASS[c]))
        new.append(_CLASS[c][r])
    return _fill(local, "".join(reversed(new)), _CLASS.__contains__) + "@" + domain


def _calling_code(digits: str) -> str:
    return next((digits[:n] for n, codes in ((1, _ONE_DIGIT), (2, _TWO_DIGITS)) if digits[:n] in codes), digits[:3])


def _phone(f: Feistel, text: str, back: bool) -> str | None:
    """The country code stays, and a leading 0 of a national number; what follows is permuted, however it is grouped.

    Numbers of three, three and four digits without a code are taken for those of code 1.
    """
    digits = _digits(text)
    if text[0] == "+":
        code = _calling_code(digits)
    elif digits[0] == "0" and not re.fullmatch(r"\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-][0-9]{4}", text):
        code = "0"
    else:
        code = digits[:-10]
    rest = digits[len(code) :]
    if not 7 <= len(rest) <= 14:
        return None
    new = str(f.permute(int(rest), 10 ** len(rest), f"phone{code or 1}|{len(rest)}", back)).zfill(len(rest))
    return _fill(text, code + new)


def _card(f: Feistel, text: str, back: bool) -> str | None:
    digits = _digits(text)
    n = len(digits) - 1
    if luhn_digit(digits[:-1]) != int(digits[-1]) or digits[0] == "0":
        return None
    new = str(f.permute(int(digits[:-1]), 10**n, f"card{n}", back, lambda v: v >= 10 ** (n - 1)))
    return _fill(text, new + str(luhn_digit(new)))


def _ip(f: Feistel, text: str, back: bool) -> str | None:
    """Version 6 addresses are written in their shortest form (RFC 5952), however they came, so that equal ones stay equal."""
    if ":" in text:
        groups = [x for x in text.split(":") if x]
        if len(groups) < 3 and not (len(groups[0]) == 4 and re.search("[0-9]", groups[0])):
            return None
    try:
        address = ipaddress.ip_address(".".join(str(int(x)) for x in text.split(".")) if ":" not in text else text)
    except ValueError:
        return None
    v = f.permute(int(address), 1 << address.max_prefixlen, "ip" if address.version == 4 else "ip6", back)
    return str(type(address)(v))


def _ssn(f: Feistel, text: str, back: bool) -> str | None:
    def valid(v: int) -> bool:
        area, group, serial = v // 1_000_000, v // 10_000 % 100, v % 10_000
        return 0 < area < 900 and area != 666 and group > 0 and serial > 0

    v = int(_digits(text))
    return _fill(text, str(f.permute(v, 10**9, "ssn", back, valid)).zfill(9)) if valid(v) else None


def _iban_check(country: str, account: str) -> int:
    return 98 - int("".join(str(int(c, 36)) for c in account + country + "00")) % 97


def _iban_end(text: str, start: int, end: int) -> int | None:
    """Where the IBAN ends that starts a match: a match may go on into the next words. None if its check digits are wrong.

    The country says how long it is; one of a country without a known length, or shorter than that, is the whole match.
    """
    spots = [i for i in range(start, end) if text[i] != " "]
    n = IBAN_LENGTHS.get(text[start : start + 2], len(spots))
    if n < len(spots):
        end = spots[n - 1] + 1
        if text[end].isascii() and text[end].isalnum():
            return None
    bare = text[start:end].replace(" ", "")
    return end if 15 <= len(bare) <= 34 and _iban_check(bare[:2], bare[4:]) == int(bare[2:4]) else None


def _iban(f: Feistel, text: str, back: bool) -> str | None:
    """Digits and letters of the account are permuted, the check digits follow."""
    bare = text.replace(" ", "")
    country, account = bare[:2], bare[4:]
    if not 11 <= len(account) <= 30 or _iban_check(country, account) != int(bare[2:4]):
        return None
    value, size = 0, 1
    for c in account:
        value, size = value * len(_CLASS[c]) + _CLASS[c].index(c), size * len(_CLASS[c])
    shape = "".join("9" if c.isdigit() else "A" for c in account)
    value, new = f.permute(value, size, "iban" + country + shape, back), []
    for c in reversed(account):
        value, r = divmod(value, len(_CLASS[c]))
        new.append(_CLASS[c][r])
    account = "".join(reversed(new))
    return _fill(text, f"{country}{_iban_check(country, account):02d}{account}", lambda c: c != " ")


def _date(f: Feistel, text: str, back: bool) -> str | None:
    """Year first, or day or month before the year; where both fit, the month is taken to come first after slashes, the day after other marks.

    What fits the other order only is permuted among the dates of which that is true, so that it can be told apart again.
    """
    mark = re.search(r"[^0-9]", text)[0]
    a, b, c = text.split(mark)
    orders = ["ymd"] if len(a) == 4 else ["mdy", "dmy"] if mark == "/" else ["dmy", "mdy"]
    for order in orders:
        of = dict(zip(order, (a, b, c), strict=True))
        try:
            day = datetime.date(int(of["y"]), int(of["m"]), int(of["d"])).toordinal() - _FIRST_DAY
        except ValueError:
            continue
        break
    else:
        return None
    if not 0 <= day < _DAYS:
        return None
    # Which of day and month are below 10 stays, so numbers keep their widths, whether padded or not.
    at = lambda v: datetime.date.fromordinal(_FIRST_DAY + v)
    low = lambda v: (at(v).day < 10, at(v).month < 10)
    own = low(day)
    if order == orders[0]:
        new = at(f.permute(day, _DAYS, "date", back, lambda v: low(v) == own))
    else:
        new = at(f.permute(day, _DAYS, "date" + order, back, lambda v: low(v) == own and at(v).day > 12))
    parts = {"y": f"{new.year:04d}", "m": str(new.month).zfill(len(of["m"])), "d": str(new.day).zfill(len(of["d"]))}
    return mark.join(parts[x] for x in order)


_MAKE = {"phone": _phone, "national": _phone, "card": _card, "ip": _ip, "ip6": _ip, "ssn": _ssn, "iban": _iban, "date": _date}
_COUNTED = {"national": "phone", "ip6": "ip"}
_NUMBERS = re.compile(
    r"""(?<![0-9])(?:
      (?P<iban>[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,4})?(?![A-Za-z0-9]))
    | (?P<phone>(?:\+?[0-9]{1,3}[ .-]?)?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}(?![0-9])
        | \+[0-9]{8,15}(?![0-9]) | \+[0-9]{1,3}(?:[ .-][0-9]{1,8}){1,5}(?![0-9])
        | [0-9]{3}[-.][0-9]{3}[-.][0-9]{4}(?![0-9]))
    | (?P<card>[0-9]{13,19}(?![0-9]) | [0-9]{4}([ -])[0-9]{4}\4[0-9]{4}\4[0-9]{4}(?![0-9]) | [0-9]{4}([ -])[0-9]{6}\5[0-9]{5}(?![0-9]))
    | (?P<ip>(?<![0-9]\.)[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9]))
    | (?P<ssn>[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9]))
    | (?P<date>[0-9]{4}(?P<first>[-/.])[0-9]{2}(?P=first)[0-9]{2}(?![0-9]|[-.][0-9])
        | [0-9]{1,2}(?P<mark>[./])[0-9]{1,2}(?P=mark)[0-9]{4}(?![0-9]) | (?<![0-9]-)[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}(?![0-9]|-[0-9]))
    | (?P<national>(?<![\w./-])0[1-9][0-9]{1,4}(?:[ /-][0-9]{2,8}){1,4}(?![\w/]|[.-][0-9]))
    )
    | (?P<ip6>(?<![\w:.])(?:[0-9A-Fa-f]{1,4}:){1,7}(?::?[0-9A-Fa-f]{1,4}){1,7}(?![\w:]|\.[0-9]))""",
    re.X | re.A,
)
_LOCAL = re.compile(r"[\w.%+-]{1,64}\Z")
_DOMAIN = re.compile(r"@[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,}")


def find(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of what looks like personal data, before any but IBANs are validated; e-mail addresses come first where kinds overlap."""
    spans = []
    at = text.find("@")
    while at >= 0:
        local, domain = _LOCAL.search(text, max(0, at - 64), at), _DOMAIN.match(text, at)
        if local and domain and (not spans or local.start() >= spans[-1][1]):
            spans.append((local.start(), domain.end(), "email"))
        at = text.find("@", at + 1)
    emails, at = list(spans), 0
    while m := _NUMBERS.search(text, at):
        kind = next(k for k in _MAKE if m[k] is not None)
        end = _iban_end(text, *m.span()) if kind == "iban" else m.end()
        if kind == "national" and not 9 <= len(_digits(m[0])) <= 12:
            end = None
        at = end or m.start() + 1  # behind the letters of a wrong IBAN there may be another number
        if end and not any(a < end and m.start() < b for a, b, _ in emails):
            spans.append((m.start(), end, _COUNTED.get(kind, kind)))
    return sorted(spans)


def pseudonymise(text: str, feistel: Feistel, back: bool = False) -> tuple[str, dict[str, int]]:
    """The text with pseudonyms and how many of each kind; back restores what was replaced."""
    out, at, counts = [], 0, {}
    for start, end, kind in find(text):
        new = (_email if kind == "email" else _MAKE[kind])(feistel, text[start:end], back)
        if new is not None:
            out += [text[at:start], new]
            at = end
            counts[kind] = counts.get(kind, 0) + 1
    return "".join(out) + text[at:], counts


def pseudonymise_documents(docs: DataFrame, *, key: bytes, back: bool = False) -> DataFrame:
    """doc_id, text with pseudonyms and n_<kind> (long) for each of KINDS, for every row.

    Null text stays null and empty text empty, with counts 0; a text without personal data is
    returned as it is. Numbers that fail their check (Luhn, mod 97, calendar, octets, areas) are no
    personal data. Whole texts are searched; repeated rows are treated alike; other columns are not looked at;
    an empty table gives an empty result.

    Equal values get equal pseudonyms under one key: dates in any order and padding, phone numbers with
    a country code in any grouping, cards and IBANs with or without spaces. Whoever has the key can go
    back (back=True); version 6 addresses then come back in their shortest form.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        feistel = Feistel(key)
        for b in batches:
            texts, counts = b.column(1).to_pylist(), {k: np.zeros(b.num_rows, np.int64) for k in KINDS}
            for first, last, group in groups(b.column(1)):
                marks = np.concatenate([[0], np.cumsum((group.data == 64) | (group.data >= 48) & (group.data <= 57))])
                for i in (first + np.flatnonzero(np.diff(marks[group.offsets]) > 0)).tolist():
                    texts[i], n = pseudonymise(texts[i], feistel, back)
                    for k, x in n.items():
                        counts[k][i] = x
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), *map(pa.array, counts.values())], ["doc_id", "text", *[f"n_{k}" for k in KINDS]])

    small_batches(docs.sparkSession)
    given = docs.select("doc_id", "text")
    return given.mapInArrow(run, f"doc_id {given.schema['doc_id'].dataType.simpleString()}, text string, " + ", ".join(f"n_{k} long" for k in KINDS))


def op9_pseudonyms(spark, sf_dir):
    """documents under the session's key, KEY_SETTING. Without one the results show the format but protect nothing, and a warning says so."""
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        warnings.warn(f"{KEY_SETTING} is not set: pseudonyms of a public key can be undone by anyone", stacklevel=2)
    return pseudonymise_documents(documents(spark, sf_dir), key=key.encode() if key else PUBLIC_KEY)
