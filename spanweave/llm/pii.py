"""Format-preserving pseudonyms of personal data by a keyed Feistel permutation.

Validated values are permuted within their own format, so the result is valid again, equal values get
equal pseudonyms in all documents, and nothing but the key is needed: e-mail addresses (letters stay
letters of their script, digits digits, the last label stays), IBANs (mod 97; country and length stay), card numbers
(Luhn and issuer digit), US social security numbers, telephone numbers (country code stays), IPv4
addresses and calendar dates (a day from 1900 to 2099 becomes another). Separators stay as they are.
A candidate that does not validate is tried with shorter ends (an IBAN first with the length of its
country), then from later starts within it, so that neighbours do not hide a value; what validates in
no way is left alone, as is all other text.

The permutation of 0..n-1 is a ten-round balanced Feistel network over enough bits, with keyed BLAKE2b as
round function, walked until the value is below n again (cycle walking).

Defined cases: null text stays null, empty text empty; overlapping finds go to the earlier kind in
the order above, then to the left; all columns but text, and all rows, are kept.
"""

from __future__ import annotations

import bisect
import datetime
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import cache, lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import functions as F

from spanweave.llm.common import release

ROUNDS = 10
KINDS = ("email", "iban", "card", "ssn", "phone", "ip", "date")
_FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2100, 1, 1).toordinal() - _FIRST_DAY


@lru_cache(10_000)
def permute(value: int, n: int, key: bytes, tweak: str) -> int:
    """The place of value in a keyed permutation of range(n)."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, size = (1 << half) - 1, (half + 7) // 8
    while True:
        left, right = value >> half, value & mask
        for r in range(ROUNDS):
            told = blake2b(b"%d|%d|%s|%d" % (r, n, tweak.encode(), right), key=key, digest_size=min(64, size + 8)).digest()
            left, right = right, left ^ (int.from_bytes(told, "big") & mask)
        value = left << half | right
        if value < n:
            return value


def permute_until(value: int, n: int, key: bytes, tweak: str, valid: Callable[[int], bool]) -> int:
    """As permute, walked on until valid holds; a permutation of the valid values."""
    while not valid(value := permute(value, n, key, tweak)):
        pass
    return value


def _digits(text: str, new: str) -> str:
    """text with its digits replaced in order."""
    it = iter(new)
    return re.sub("[0-9]", lambda _: next(it), text)


_CLASSES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_CLASS_OF = {c: k for k in _CLASSES for c in k}
#: Characters that are permuted as one number; longer texts are permuted in such blocks, chained.
BLOCK = 64


@cache
def _class_of(c: str) -> str:
    """The characters that may stand for c: ASCII digits and letters, else letters of its kind in its part of Unicode, else itself."""
    if c in _CLASS_OF:
        return _CLASS_OF[c]
    kind = unicodedata.category(c)
    if c.isascii() or kind[0] not in "LN":
        return c
    first = ord(c) // 128 * 128
    return "".join(x for x in map(chr, range(first, first + 128)) if unicodedata.category(x) == kind)


def permute_text(text: str, key: bytes, tweak: str) -> str:
    """Characters permuted together within their classes; others stay.

    Up to BLOCK characters are one number. Longer texts are permuted block by block, each under a digest of the new
    block before it, and then once more from the end, so that every character depends on all others.
    """
    classes = [_class_of(c) for c in text]
    at = [i for i, k in enumerate(classes) if len(k) > 1]
    if not at:
        return text
    shape = tweak + "".join(k[0] for k in classes)
    parts, out = [at[i : i + BLOCK] for i in range(0, len(at), BLOCK)], list(text)
    if len(parts) == 1:
        _permute_block(out, classes, at, key, shape)
        return "".join(out)
    told = blake2b(shape.encode(), key=key, digest_size=16).hexdigest()
    for turn, order in enumerate((parts, parts[::-1])):
        before = ""
        for part in order:
            _permute_block(out, classes, part, key, f"{told}{turn}{before}")
            before = blake2b("".join(out[i] for i in part).encode(), key=key, digest_size=16).hexdigest()
    return "".join(out)


def _permute_block(out: list[str], classes: list[str], at: list[int], key: bytes, tweak: str) -> None:
    """Permutes the characters of out at these places as one number."""
    value, n = 0, 1
    for i in at:
        value, n = value * len(classes[i]) + classes[i].index(out[i]), n * len(classes[i])
    value = permute(value, n, key, tweak)
    for i in reversed(at):
        value, k = divmod(value, len(classes[i]))
        out[i] = classes[i][k]


_DOUBLED = {str(d): 2 * d - 9 * (d > 4) for d in range(10)}


def luhn(digits: str) -> bool:
    return (sum(map(int, digits[::-2])) + sum(map(_DOUBLED.__getitem__, digits[-2::-2]))) % 10 == 0


def _email(m: str, key: bytes) -> str:
    local, _, domain = m.rpartition("@")
    host, _, last = domain.rpartition(".")
    return f"{permute_text(local, key, 'email')}@{permute_text(host, key, 'host')}.{last}"


_VALUES = str.maketrans({c: str(int(c, 36)) for k in _CLASSES for c in k})


def _iban_number(text: str) -> int:
    return int(text.translate(_VALUES))


def _iban(m: str, key: bytes) -> str | None:
    flat = m.replace(" ", "")
    if not 15 <= len(flat) <= 34 or _iban_number(flat[4:] + flat[:4]) % 97 != 1:
        return None
    if flat[0].islower() and len(flat) != IBAN_LENGTHS.get(flat[:2].upper()):
        return None
    inner = permute_text(flat[4:], key, "iban" + flat[:2])
    new = iter(flat[:2] + f"{98 - _iban_number(inner + flat[:2] + '00') % 97:02d}" + inner)
    return re.sub(r"\S", lambda _: next(new), m)


_SEPARATORS = str.maketrans("", "", " .-")


def _issued(digits: str) -> bool:
    """Whether a card number begins as those of known issuers do."""
    return digits[0] in "456" or digits[:2] in ("30", "34", "35", "36", "37", "38") or 2221 <= int(digits[:4]) <= 2720


def _card(m: str, key: bytes) -> str | None:
    digits = m.translate(_SEPARATORS)
    if not 13 <= len(digits) <= 19 or not _issued(digits) or not luhn(digits):
        return None
    first, inner = digits[0], digits[1:-1]
    made = permute_until(int(inner), 10 ** len(inner), key, "card" + first, lambda v: _issued(f"{first}{v:0{len(inner)}d}"))
    return _digits(m, next(x for x in (f"{first}{made:0{len(inner)}d}{c}" for c in "0123456789") if luhn(x)))


def _ssn(m: str, key: bytes) -> str | None:
    def valid(v: int) -> bool:
        area, group, serial = v // 10**6, v // 10**4 % 100, v % 10**4
        return 0 < area < 900 and area != 666 and group > 0 and serial > 0

    value = int(m.replace("-", ""))
    return _digits(m, f"{permute_until(value, 10**9, key, 'ssn', valid):09d}") if valid(value) else None


def _phone(m: str, key: bytes) -> str | None:
    code = re.match(r"(?:\+|00)\d{1,3}(?=[ .(-])", m)
    rest = m[code.end() :] if code else m
    digits = re.sub("[^0-9]", "", rest)
    if not 7 <= len(digits) <= 14:
        return None
    n = 10 ** len(digits)
    full = lambda v: v * 10 >= n
    new = permute_until(int(digits), n, key, "phone", full) if digits[0] != "0" else permute(int(digits[1:]), n // 10, key, "phone0")
    return m[: len(m) - len(rest)] + _digits(rest, f"{new:0{len(digits)}d}")


def _ip(m: str, key: bytes) -> str | None:
    parts = [int(x) for x in m.split(".")]
    if max(parts) > 255 or any(len(x) > 1 and x[0] == "0" for x in m.split(".")):
        return None
    return ".".join(map(str, permute(int.from_bytes(bytes(parts), "big"), 1 << 32, key, "ip").to_bytes(4, "big")))


def _date(m: str, key: bytes) -> str | None:
    a, sep, b, c = re.fullmatch(r"(\d+)([-/.])(\d+)[-/.](\d+)", m).groups()
    orders = ("ymd",) if len(a) == 4 else ("dmy", "mdy") if sep == "/" else ("dmy",)
    for order in orders:
        parts = dict(zip(order, (a, b, c), strict=True))
        try:
            day = datetime.date(*(int(parts[k]) for k in "ymd")).toordinal() - _FIRST_DAY
        except ValueError:
            continue
        if 0 <= day < _DAYS:
            # what is read as month first only because it cannot be day first stays so
            sound = (lambda v: datetime.date.fromordinal(_FIRST_DAY + v).day > 12) if order == "mdy" else (lambda v: True)
            new = datetime.date.fromordinal(_FIRST_DAY + permute_until(day, _DAYS, key, "date", sound))
            said = {"y": f"{new.year:04d}", "m": f"{new.month:0{len(parts['m'])}d}", "d": f"{new.day:0{len(parts['d'])}d}"}
            return sep.join(said[k] for k in order)
    return None


#: Lengths of IBANs by country; other countries are tried from the longest candidate down.
IBAN_LENGTHS = {
    code: n
    for n, codes in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
        23: "AE GI IL IQ OM SO TL", 24: "AD CZ DZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for code in codes.split()
}


#: Fixed formats, in the order of KINDS behind e-mail.
FORMATS = (
    (re.compile(r"(?<!\w)(?:[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?|[a-z]{2}[0-9]{2}[a-z0-9]{11,30})(?!\w)", re.A), _iban),
    (re.compile(r"(?<![\w.])[2-6](?:[ .-]?[0-9]){12,18}(?!\w)"), _card),
    (re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"), _ssn),
    (re.compile(r"(?<![\w+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?!\w)|(?<![\w+])(?:\+[0-9]{1,3}|00[1-9][0-9]{0,2}[ .-])(?:[ .-]?[0-9]{2,4}){2,5}(?!\w)"), _phone),
    (re.compile(r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w]|\.[0-9])"), _ip),
    (re.compile(r"(?<![\w/.-])(?:[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}|[0-9]{1,2}([/.-])[0-9]{1,2}\1[0-9]{4})(?!(?![Tt][0-9])[\w/-]|\.[0-9])"), _date),
)
_ANY = re.compile("[0-9@]")
#: What an address may hold before its @, and the host behind it.
_NOT_LOCAL = re.compile(r"[^\w.%+'-]")
_HOST = re.compile(r"(?:[\w-]++\.)+[^\W\d_]{2,}")
#: Kinds with ends to choose from, and the least length of a value.
_LEAST = {"iban": 15, "card": 13, "phone": 8}
_WORD = re.compile(r"\w")


def _ends(kind: str, m: re.Match) -> Iterator[int]:
    """Where a value that starts as the candidate does may end, in the order of trial."""
    text, s, e = m.string, m.start(), m.end()
    if kind not in _LEAST:
        yield e
        return
    ends = [e, *(k for k in range(e - 1, s + _LEAST[kind] - 1, -1) if not _WORD.match(text, k) and m.re.fullmatch(text, s, k))]
    if kind == "iban":
        n = IBAN_LENGTHS.get(text[s : s + 2])
        ends.sort(key=lambda k: len(text[s:k].replace(" ", "")) != n)
    yield from ends


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """E-mail addresses, looked for from each @ outward: no character is looked at twice."""
    end, at = 0, text.find("@")
    while at >= 0:
        s = at
        while s > end:
            begin = max(end, s - BLOCK)
            last = None
            for last in _NOT_LOCAL.finditer(text, begin, s):
                pass
            s = last.end() if last else begin
            if last:
                break
        s += len(text[s:at]) - len(text[s:at].lstrip("._%+'-"))
        if s < at and (host := _HOST.match(text, at + 1)):
            yield s, host.end()
            end = host.end()
        else:
            end = at + 1
        at = text.find("@", end)


def pseudonymise(text: str, key: bytes) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and the finds (kind, start, end) in it as it was."""
    if not _ANY.search(text):
        return text, []
    taken = [(s, e, _email(text[s:e], key), "email") for s, e in _addresses(text)]
    for kind, (find, new) in zip(KINDS[1:], FORMATS, strict=True):
        at = 0
        while m := find.search(text, at):
            s, at = m.start(), m.start() + 1
            for e in _ends(kind, m):
                k = bisect.bisect(taken, (e,))
                if (k == 0 or taken[k - 1][1] <= s) and (made := new(text[s:e], key)) is not None:
                    taken.insert(k, (s, e, made, kind))
                    at = e
                    break
    out, at = [], 0
    for s, e, made, _ in taken:
        out += [text[at:s], made]
        at = e
    return "".join([*out, text[at:]]), [(kind, s, e) for s, e, _, kind in taken]


def pseudonyms(key: bytes):
    """A column function text -> struct(text, n_found, kinds) with the pseudonymised text."""
    kind = pa.struct([("text", pa.string()), ("n_found", pa.int64()), ("kinds", pa.string())])

    @F.arrow_udf("text string, n_found bigint, kinds string")
    def hide(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for k in range(len(batch)):
                text = batch[k].as_py()
                new, found = (None, []) if text is None else pseudonymise(text, key)
                out.append((new, len(found), ",".join(sorted({f[0] for f in found}))))
            yield pa.StructArray.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), kind, strict=True)] if out else [pa.array([], t.type) for t in kind], fields=list(kind))
        release()

    return hide
