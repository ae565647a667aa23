"""Cleaning of text and the map from cleaned to original positions, as column expressions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters that cleaning removes or turns into a space.
ZERO_WIDTH = "".join(map(chr, (0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, 0xAD)))
MAPPED_SPACES = "".join(map(chr, (0x09, 0x0B, 0x0C, 0x0D, 0xA0, 0x2007, 0x202F, 0x3000)))
SPACES = r" \t\n\r\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
RARE_SPACES = r"\x0b\x0c\x1c-\x1f"
CONTROLS = r"\x00-\x08\x0b\x0c\x0e-\x1f\x7f"
# The punctuation that noise drops; the last one is the em dash.
PUNCTUATION = ",.;:!?-|\u2014"


@dataclass(frozen=True)
class CleanConfig:
    """The switches of cleaning; the JSON sidecar holds the same names."""

    strip_zero_width: bool = True
    strip_control_chars: bool = True
    normalize_whitespace: bool = True
    collapse_whitespace: bool = True
    trim: bool = True
    nfc_normalize: bool = False


DEFAULT = CleanConfig()


def _odd(chars: str) -> str:
    """A class of these characters that are not printable ASCII. Of a long class each part is tried at every character; this passes over plain ones at once."""
    return f"[[^ -~]&&[{chars}]]"


def clean(text: Column, config: CleanConfig = DEFAULT) -> Column:
    """Zero-width and control characters go, runs of white space become one space, ends are trimmed."""
    gone = ZERO_WIDTH * config.strip_zero_width + CONTROLS * config.strip_control_chars
    if gone:
        text = F.regexp_replace(text, f"{_odd(gone)}+", "")
    spaces = SPACES + ("" if config.strip_control_chars else RARE_SPACES)
    if config.collapse_whitespace:
        text = F.regexp_replace(F.regexp_replace(text, _odd(spaces), " "), "  +", " ")
    elif config.normalize_whitespace:
        text = F.regexp_replace(text, _odd(MAPPED_SPACES), " ")
    if config.trim and config.collapse_whitespace:
        text = F.trim(text)
    elif config.trim:
        text = F.regexp_replace(text, f"^[{spaces}]+|[{spaces}]+$", "")
    return text


def has_text(text: Column) -> Column:
    """Whether cleaning with the default switches leaves anything; stops at the first such character."""
    return text.rlike(f"[^{ZERO_WIDTH}" + r"\x00-\x20\x7f" + f"{SPACES}]")


_WHITE = [0x20, 0x09, 0x0A, 0x0D, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0x0B, 0x0C, *range(0x1C, 0x20)]
_CONTROL = [*(c for c in range(0x20) if c not in (0x09, 0x0A, 0x0D)), 0x7F]
#: Bits by code: 1 zero width, 2 control, 4 white space. None is beyond the first plane, whose last code has no character.
_KINDS = np.zeros(1 << 16, np.uint8)
for _bit, _codes in enumerate(([*map(ord, ZERO_WIDTH)], _CONTROL, _WHITE)):
    _KINDS[_codes] |= 1 << _bit
#: Characters that are looked at together.
_TOGETHER = 1 << 18


def _kept(texts: list[str], config: CleanConfig) -> tuple[np.ndarray, np.ndarray]:
    """places() of texts, joined, and how many each has."""
    sizes = np.array([*map(len, texts)], np.int64)
    kinds = _KINDS[np.minimum(np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), (1 << 16) - 1)]
    starts, owner = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(texts)), sizes)
    alive = np.flatnonzero((kinds & (config.strip_zero_width + 2 * config.strip_control_chars)) == 0)
    white = (kinds[alive] & 4) > 0
    if config.collapse_whitespace and len(alive):
        kept = ~(white & np.r_[False, white[:-1] & (owner[alive[1:]] == owner[alive[:-1]])])
        alive, white = alive[kept], white[kept]
    if config.trim:
        solid = alive[~white]
        ends = np.searchsorted(solid, np.r_[starts, len(kinds)])
        some = ends[1:] > ends[:-1]
        bounds = np.full((2, len(texts)), -1)  # first and last solid place
        bounds[:, some] = solid[ends[:-1][some]], solid[ends[1:][some] - 1]
        alive = alive[(alive >= bounds[0][owner[alive]]) & (alive <= bounds[1][owner[alive]])]
    own = owner[alive]
    return alive - starts[own], np.bincount(own, minlength=len(texts))


def places(text: str, config: CleanConfig = DEFAULT) -> np.ndarray:
    """For each position of the cleaned text the position it comes from; NFC is not looked at.

    A run of white space, also one broken by characters that go, keeps its first character.
    """
    return _kept([text], config)[0]


@cache
def _char_map(config: CleanConfig):
    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def run(texts: pa.Array) -> pa.Array:
        given = [t or "" for t in texts.to_pylist()]
        sizes = np.cumsum([*map(len, given)])
        made, counts, at = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)], 0
        while at < len(given):
            to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + _TOGETHER, "right")))
            found, n = _kept(given[at:to], config)
            made.append(found.astype(np.int32))
            counts.append(n)
            at = to
        return pa.ListArray.from_arrays(pa.array(np.cumsum(np.concatenate(counts)), pa.int32()), pa.array(np.concatenate(made)))

    return run


def char_map(text: Column, config: CleanConfig = DEFAULT) -> Column:
    """places() as a column. In Arrow batches: arrays of a text's length are slow in interpreted SQL lambdas."""
    return _char_map(config)(text)


@cache
def _map_digest(config: CleanConfig):
    @F.arrow_udf("struct<n:bigint,map_md5:string>")
    def run(texts: pa.Array) -> pa.Array:
        sizes, sums = [], []
        for t in texts:  # one map at a time
            made = pa.array(places(t.as_py() or "", config).astype(np.int32)).cast(pa.string())
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(made)], pa.int32()), made), ",")[0]
            sizes.append(len(made))
            sums.append(md5(joined.as_buffer() or b"").hexdigest())
        return pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), pa.array(sums, pa.string())], names=["n", "map_md5"])

    return run


def char_map_digest(text: Column, config: CleanConfig = DEFAULT) -> Column:
    """(n, map_md5) of char_map: its length, and the md5 of its positions joined by commas. No map leaves its task."""
    return _map_digest(config)(text)


def lower_in_place(text: Column) -> Column:
    """Lower case that keeps every position: the one letter whose lower case is longer stays."""
    kept, aside = F.lit(chr(0x130)), F.lit(chr(0xE000))
    return F.replace(F.lower(F.replace(text, kept, aside)), aside, kept)


def span_text(text: Column, start: Column, end: Column) -> Column:
    return F.substring(text, start + 1, end - start)


def token_set(text: Column) -> Column:
    """Distinct lower-case white-space tokens of the cleaned text, sorted."""
    return F.array_sort(F.array_distinct(F.filter(F.split(F.lower(clean(text)), " "), lambda t: t != "")))
