"""Helpers shared by the corpus operators: shared storage, row digests, skew-proof joins."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanweave.functions.plan import join_hot as join_hot
from spanweave.functions.stored import discard as discard
from spanweave.functions.stored import hold as hold
from spanweave.functions.stored import materialize as materialize
from spanweave.functions.stored import shared_dir as shared_dir

#: Lower-cases A-Z and turns every ASCII character that is not a letter or digit into a space,
#: so that split() on the result gives the words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)

try:
    _libc = ctypes.CDLL("libc.so.6")
except OSError:  # not glibc
    _libc = None


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased ASCII-folded words of UTF-8 bytes; bytes of 0x80 and above are word characters."""
    return text.translate(WORD_BYTES).split()


def release() -> None:
    """Give freed memory back to the system. Spark keeps Python workers; without this each keeps its peak."""
    pa.default_memory_pool().release_unused()
    if _libc and hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(columns: list[str], name: str) -> str:
    """The name, with as many underscores in front as make it clash with no column."""
    name = f"__{name}"
    while name.lower() in {c.lower() for c in columns}:
        name = f"_{name}"
    return name


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of doc_id as text, modulo n; null ids count as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n))
