"""Format-preserving pseudonyms for personal data: keyed Feistel permutations within each format.

A found value is validated (check digits, ranges, calendar), read as a number below the size of its
format's domain, permuted there under the key, and written in the same format. Equal
values get equal pseudonyms in every document, without a table of values and without a shuffle.
"""

from __future__ import annotations

import re
from bisect import bisect_left
import string
from collections.abc import Iterator
from datetime import date, timedelta
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbwatch.llm.common import Batches, map_batches, named, read_table, text_blocks, texts_of

KINDS = ("email", "secret", "iban", "date", "ssn", "card", "phone", "ip")
KEY = b"replace this key"  # of the registered query; a deployment passes its own
ROUNDS = 10

_DIGITS, _LOWER, _UPPER = string.digits, string.ascii_lowercase, string.ascii_uppercase
_FIRST_DAY, _DAYS = date(1900, 1, 1), (date(2100, 1, 1) - date(1900, 1, 1)).days


def permuted(value: int, size: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of 0 .. size - 1: a Feistel network over an even number of bits, walked until inside."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask, width = (1 << half) - 1, (half + 7) // 8
    while True:
        left, right = value >> half, value & mask
        for i in range(ROUNDS):
            said = blake2b(right.to_bytes(width, "big"), key=key[:64], digest_size=min(64, width + 8), person=bytes([i]), salt=b"")
            said.update(tweak.encode())
            left, right = right, left ^ int.from_bytes(said.digest(), "big") & mask
        value = left << half | right
        if value < size:
            return value


def _shaped(text: str, key: bytes, tweak: str, letters: dict[str, str]) -> str:
    """Permutes the characters that have an alphabet, each within its own; the others stay."""
    size, value, shape = 1, 0, []
    for c in text:
        if alphabet := letters.get(c):
            value, size = value * len(alphabet) + alphabet.index(c), size * len(alphabet)
        shape.append(alphabet)
    if size == 1:
        return text
    tag = "".join(a[0] if a else c for a, c in zip(shape, text))  # the format, the same for the result
    value, out = permuted(value, size, key, f"{tweak}:{tag}"), []
    for c, alphabet in zip(reversed(text), reversed(shape)):
        if alphabet:
            value, i = divmod(value, len(alphabet))
            c = alphabet[i]
        out.append(c)
    return "".join(reversed(out))


_ALNUM = {c: a for a in (_DIGITS, _LOWER, _UPPER) for c in a}
_NUMERIC = {c: _DIGITS for c in _DIGITS}
_HEX_LOWER = {c: "0123456789abcdef" for c in "0123456789abcdef"}
_HEX_UPPER = {c: "0123456789ABCDEF" for c in "0123456789ABCDEF"}


def _email(text: str, key: bytes) -> str | None:
    name, _, host = text.rpartition("@")
    labels, _, top = host.rpartition(".")
    return f"{_shaped(f'{name}@{labels}', key, 'email', _ALNUM)}.{top}"


def _secret(text: str, key: bytes) -> str | None:
    lower, upper = set(text) <= _HEX_LOWER.keys(), set(text) <= _HEX_UPPER.keys()
    return _shaped(text, key, "secret", _HEX_LOWER if lower else _HEX_UPPER if upper else _ALNUM)


def _iban_check(country: str, account: str) -> str:
    turned = "".join(str(int(c, 36)) for c in f"{account}{country}00")
    return f"{98 - int(turned) % 97:02d}"


def _iban(text: str, key: bytes) -> str | None:
    plain = text.replace(" ", "")
    country, check, account = plain[:2], plain[2:4], plain[4:]
    if not 11 <= len(account) <= 30 or check != _iban_check(country, account):
        return None
    account = _shaped(account, key, f"iban:{country}", _ALNUM)
    return _refilled(text, f"{country}{_iban_check(country, account)}{account}", str.isalnum)


def _refilled(text: str, signs: str, wanted) -> str:
    """The text with the wanted characters replaced by the signs, in order."""
    fresh = iter(signs)
    return "".join(next(fresh) if wanted(c) else c for c in text)


def _day(year: str, month: str, day: str) -> date | None:
    try:
        found = date(int(year), int(month), int(day))
    except ValueError:
        return None
    return found if 0 <= (found - _FIRST_DAY).days < _DAYS else None


def _moved(day: date, key: bytes, tweak: str) -> date:
    return _FIRST_DAY + timedelta(days=permuted((day - _FIRST_DAY).days, _DAYS, key, tweak))


def _date(text: str, key: bytes) -> str | None:
    parts = re.split("[-./]", text)
    for order, tweak in (("ymd", "date"),) if len(parts[0]) == 4 else (("dmy", "date"), ("mdy", "month first")):
        width = dict(zip(order, map(len, parts)))
        by = dict(zip(order, parts))
        found = _day(by["y"], by["m"], by["d"])
        if not found:
            continue
        while True:  # walk on to a day that fits the digits, and with the month first to one that tells so
            found = _moved(found, key, tweak)
            signs = {"y": f"{found.year:04d}", "m": f"{found.month:0{width['m']}d}", "d": f"{found.day:0{width['d']}d}"}
            if all(len(signs[c]) == width[c] for c in order) and (tweak == "date" or found.day >= 13):
                return _refilled(text, "".join(signs[c] for c in order), str.isdigit)
    return None


def _ssn(text: str, key: bytes) -> str | None:
    area, group, serial = map(int, text.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    value = permuted(((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1, 898 * 99 * 9999, key, "ssn")
    value, serial = divmod(value, 9999)
    area, group = divmod(value, 99)
    area += 1 + (area >= 665)
    return f"{area:03d}-{group + 1:02d}-{serial + 1:04d}"


def luhn_digit(digits: str) -> str:
    """The check digit that follows the digits."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 - i % 2)
        total += d - 9 * (d > 9)
    return str(-total % 10)


def _card(text: str, key: bytes) -> str | None:
    digits = re.sub("[^0-9]", "", text)
    if luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
        return None
    kept = digits[0] + _shaped(digits[1:-1], key, f"card:{digits[0]}", _NUMERIC)  # the issuer class stays
    return _refilled(text, kept + luhn_digit(kept), str.isdigit)


def _phone(text: str, key: bytes) -> str | None:
    digits = sum(map(str.isdigit, text))
    if not 9 <= digits <= 15:
        return None
    code = re.match(r"\+[0-9]{1,3}(?=[ .(-])|", text)[0]
    return code + _shaped(text[len(code) :], key, f"phone:{code}", _NUMERIC)


def _ip(text: str, key: bytes) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or p != str(int(p)) for p in parts):
        return None
    value = permuted(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, key, "ip")
    return ".".join(map(str, value.to_bytes(4, "big")))


_MAKERS = {"email": _email, "secret": _secret, "iban": _iban, "date": _date, "ssn": _ssn, "card": _card, "phone": _phone, "ip": _ip}
_EDGE, _END = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
_PATTERNS = {
    "email": re.compile(r"(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])|"
                        r"[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}"),
    "secret": re.compile(r"(?i)(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)[\"']?\s{0,3}[:=]\s{0,3}[\"']?([A-Za-z0-9_/+-]{16,256})"),
    "iban": re.compile(_EDGE + r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?" + _END),
    "date": re.compile(r"(?<![0-9./-])(?:[0-9]{4}([-./])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-./])[0-9]{1,2}\2[0-9]{4})(?![0-9]|[./-][0-9])"),
    "ssn": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])"),
    "card": re.compile(r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5})(?![0-9])"),
    "phone": re.compile(r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{1,12}(?:[ .-][0-9]{1,12}){0,6}|(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4})(?![0-9])"),
    "ip": re.compile(r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"),
}
_DIGIT = re.compile("[0-9]")
_GROUP_END = re.compile(_END + "(?<=[0-9A-Za-z])")
_IBAN_SIZES = {  # of the countries in the registry
    n: set(countries.split()) for n, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV YE",
        29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
}


def _ends(kind: str, text: str, first: int, last: int) -> list[int]:
    """Where a match may end, the likeliest first: a following word or number can look like one more group of an IBAN or a phone."""
    if kind not in ("iban", "phone"):
        return [last]
    ends = [m.start() for m in _GROUP_END.finditer(text, first, last) if m.start() < last]
    ends = [last, *reversed(ends)]
    if kind == "iban":
        size = lambda x: sum(map(str.isalnum, text[first:x]))
        return sorted(ends, key=lambda x: text[first : first + 2] not in _IBAN_SIZES.get(size(x), ()))
    fixed = text[first : first + 2] in ("+1", "+7")  # their numbers have eleven digits

    def rank(x: int) -> tuple[bool, bool]:
        splits = text[x : x + 1] in (".", "-") and text[x + 1 : x + 2].isdigit()  # what follows hangs on
        return fixed and sum(map(str.isdigit, text[first:x])) != 11, splits

    return sorted(ends, key=rank)


@lru_cache(100_000)
def pseudonym(kind: str, text: str, key: bytes) -> str | None:
    """The value's pseudonym, or None if the value is not valid for its kind."""
    return _MAKERS[kind](text, key)


def found_values(text: str, key: bytes) -> list[tuple[int, int, str, str]]:
    """(first, last, kind, pseudonym) of the valid values, in order and apart; earlier kinds win an overlap."""
    taken: list[tuple[int, int, str, str]] = []
    firsts: list[int] = []  # of the values so far, in order, and their ends
    lasts: list[int] = []
    digits = _DIGIT.search(text)
    for kind in KINDS:
        if "@" not in text if kind == "email" else not digits and kind != "secret":
            continue
        at = 0
        while m := _PATTERNS[kind].search(text, at):
            first, whole = m.span(1 if kind == "secret" else 0)
            at = m.start() + 1  # a value may begin within a match that is not one
            for last in _ends(kind, text, first, whole):
                place = bisect_left(firsts, last)  # values that begin before this one's end
                if place and lasts[place - 1] > first:
                    continue
                if (name := pseudonym(kind, text[first:last], key)) is not None:
                    taken.append((first, last, kind, name))
                    firsts.insert(place, first)
                    lasts.insert(place, last)
                    at = last
                    break
    return sorted(taken)


def replaced(text: str, values: list[tuple[int, int, str, str]]) -> str:
    parts, at = [], 0
    for first, last, _, name in values:
        parts += text[at:first], name
        at = last
    return "".join(parts) + text[at:]


def pseudonymised(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: bytes = KEY, keep: tuple[str, ...] = (),
) -> DataFrame:
    """Rows with the id, the columns of ``keep``, the text with pseudonyms, and ``values`` (first, last, kind).

    ``values`` has the replaced spans as offsets of characters in the original text. Null texts stay null,
    and texts without valid values stay as they are. Repeated rows give equal rows. A permutation may
    map a value to itself, with a chance of one in the size of its format's domain.
    """
    columns = list(dict.fromkeys([id_col, text_col, *keep]))
    rows = named(docs, *columns)

    def work(batches: Batches) -> Batches:
        span = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("kind", pa.string())]))
        for b in (part for whole in batches for part in text_blocks(whole, text_col)):
            texts, spans = b.column(text_col).to_pylist(), []
            for i, text in enumerate(texts):
                values = found_values(text, key) if text else []
                if values:
                    texts[i] = replaced(text, values)
                spans.append([{"first": x, "last": y, "kind": k} for x, y, k, _ in values])
            fresh = {text_col: pa.array(texts, pa.string())}
            yield pa.RecordBatch.from_arrays(
                [*(fresh.get(c, b.column(c)) for c in columns), pa.array(spans, span)], [*columns, "values"]
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return map_batches(rows, work, f"{schema}, values array<struct<first: int, last: int, kind: string>>")


def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pseudonymised(read_table(spark, sf_dir, "documents"))
    kinds = F.transform("values", lambda v: v["kind"])
    counts = [F.size(F.array_remove(kinds, k)) for k in KINDS]
    counts = [(F.size("values") - n).cast("long").alias(f"n_{k}") for k, n in zip(KINDS, counts)]
    return found.select("doc_id", "text", "values", F.size("values").cast("long").alias("n_values"), *counts)
