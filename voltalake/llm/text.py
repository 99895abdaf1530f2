"""Words, hashes and Arrow batches, shared by the corpus operators.

All splitting works on UTF-8 bytes: ``bytes.translate`` and ``bytes.split`` run
in C, and bytes of at least 0x80 never match an ASCII class.
"""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Callable, Iterable, Iterator
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Batch = pa.RecordBatch

# A-Z to a-z; everything else stays.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# A-Z to a-z; what is neither a letter, a digit nor beyond ASCII becomes a blank.
ALNUM = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
# Entries a worker's cache may hold before it starts afresh.
CACHE_ENTRIES = 200_000
# Longer keys are computed each time, so that a cache is bounded in bytes too.
CACHED_LENGTH = 64
# Texts are turned into arrays in portions of about so many bytes.
PORTION_BYTES = 1 << 19


def _members(inside: bytes) -> np.ndarray:
    return np.array([b in inside for b in range(128)] + [True])


# Which code points belong to words, the last entry for all beyond ASCII.
BLANKS = b" \t\n\x0b\x0c\r"
NOT_BLANK = _members(bytes(set(range(128)) - set(BLANKS)))
ALPHANUMERIC = _members(bytes(b for b in range(128) if chr(b).isalnum()))
LETTER = _members(bytes(b for b in range(128) if chr(b).isalpha()))

K1, K2, K3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


class Cache(dict):
    """Memo of a function of one short key, emptied when full: results never depend on it."""

    def __init__(self, compute: Callable[[Any], Any], entries: int = CACHE_ENTRIES):
        super().__init__()
        self.compute, self.entries = compute, entries

    def __missing__(self, key: Any) -> Any:
        value = self.compute(key)
        if len(key) <= CACHED_LENGTH:
            if len(self) >= self.entries:
                self.clear()
            self[key] = value
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x *= K2
    x ^= x >> np.uint64(27)
    x *= K3
    x ^= x >> np.uint64(31)
    return x


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` hashes; empty if there are fewer."""
    if len(hashes) < n:
        return hashes[:0]
    out = hashes[: len(hashes) - n + 1]
    for k in range(1, n):
        out = mixed(out) + hashes[k : len(hashes) - n + 1 + k]
    return mixed(out)


class Portion(NamedTuple):
    """Several whole texts as arrays. Characters outside words have the value 0."""

    values: np.ndarray  # scrambled code points
    inside: np.ndarray  # whether a character belongs to a word
    first: np.ndarray  # first character of each text; a text ends with one outside
    starts: np.ndarray  # of words
    ends: np.ndarray
    text: np.ndarray  # the text of each word

    @property
    def words(self) -> np.ndarray:
        """The number of words of each text."""
        return np.bincount(self.text, minlength=len(self.first))

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word: a polynomial in scrambled code points."""
        power, inverse = powers(len(self.values) + 1)
        total = np.zeros(len(self.values) + 1, np.uint64)
        np.cumsum(self.values * power[:-1], out=total[1:])
        length = (self.ends - self.starts).astype(np.uint64)
        return mixed((total[self.ends] - total[self.starts]) * inverse[self.starts] + length)

    def per_text(self) -> np.ndarray:
        """Where each text's words begin, and the end of the last: a slice for each text."""
        return np.append(0, np.cumsum(self.words))


_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2 to the 64."""
    if len(_POWERS[0]) < n:
        base = int(K1)
        for k, x in enumerate((base, pow(base, -1, 1 << 64))):
            steps = np.full(n, x, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def read(of: list[bytes], members: np.ndarray = NOT_BLANK, lower: bool = False) -> Portion:
    """Texts as arrays; words are the longest runs of ``members``."""
    if lower:
        of = [x.translate(LOWER) for x in of]
    joined = b"\n".join([*of, b""]).decode().encode("utf-32-le")
    points = np.frombuffer(joined, np.uint32)
    lengths = np.array([len(x.decode()) for x in of], np.int64) + 1
    inside = members[np.minimum(points, 128)]
    inside[np.cumsum(lengths) - 1] = False
    values = (points.astype(np.uint64) + K3) * K2
    values ^= values >> np.uint64(29)
    values *= K1
    values[~inside] = 0
    edge = np.diff(inside.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    first = np.cumsum(lengths) - lengths
    text = np.searchsorted(first, starts, "right") - 1
    return Portion(values, inside, first, starts, ends, text)


def portions(
    of: Iterable[bytes], size: int = PORTION_BYTES, count: int = 1 << 30
) -> Iterator[list[bytes]]:
    """The texts in order, some at a time; a long text stays whole."""
    part: list[bytes] = []
    total = 0
    for text in of:
        part.append(text)
        total += len(text) + 1
        if total >= size or len(part) >= count:
            yield part
            part, total = [], 0
    if part:
        yield part


def texts(batch: Batch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    values = batch.column(batch.schema.get_field_index(column))
    return [x or b"" for x in values.cast(pa.binary()).to_pylist()]


def map_tasks(
    df: DataFrame, schema: Any, function: Callable[[Iterator[Batch]], Iterator[Batch]]
) -> DataFrame:
    """The function on the Arrow batches of each task."""

    def run(batches: Iterator[Batch]) -> Iterator[Batch]:
        yield from function(batches)
        give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return freed memory to the system. Workers serve many tasks, and each worker
    would keep what its largest task needed, idle ones too."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim:
        trim(0)


def map_batches(df: DataFrame, schema: Any, function: Callable[[Batch], Batch]) -> DataFrame:
    """One output batch for each Arrow batch."""

    def run(batches: Iterator[Batch]) -> Iterator[Batch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return map_tasks(df, schema, run)


def held_out(doc_id: Column) -> Column:
    """The fifth of the documents that no model learns from; a null id is learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def crc(value: object) -> int:
    """CRC-32 of a value's text, as Spark's ``crc32`` gives it."""
    return zlib.crc32(str(value).encode())


def packed(docs: DataFrame) -> DataFrame:
    """(doc_id, packed): texts compressed, as they travel by id."""

    def pack(batch: Batch) -> Batch:
        return pa.record_batch(
            [batch.column("doc_id"), compressed(texts(batch))], ["doc_id", "packed"]
        )

    return map_batches(docs.select("doc_id", "text"), "doc_id long, packed binary", pack)


def compressed(of: list[bytes]) -> pa.Array:
    coder = zstandard.ZstdCompressor(level=1)
    return pa.array([coder.compress(x) for x in of], pa.binary())


def unpacked(batch: Batch, column: str = "packed") -> list[bytes]:
    coder = zstandard.ZstdDecompressor()
    return [coder.decompress(x) for x in batch.column(column).to_pylist()]
