"""Arrow and numpy helpers shared by the operators: views of text columns, word spans and hashes of byte ranges.

Texts are handled in slices of whole documents of about half a megabyte, so memory in a task follows the slice, not the
partition. A document larger than a slice makes a slice of its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tokenloom.session import ensure_checkpoint_dir

SLICE_BYTES = 1 << 19
U64 = np.uint64

# White space of the query contracts is the blank and the bytes 9 to 13.
WHITE = np.zeros(256, bool)
WHITE[[32, *range(9, 14)]] = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Scramble 64-bit values (the splitmix64 finaliser), a different permutation for each seed."""
    with np.errstate(over="ignore"):
        x = x + U64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


# A random 64-bit code for each byte, and the same with A-Z read as a-z.
CODES = mix(np.arange(256, dtype=U64), 11)
_LOWER = np.arange(256)
_LOWER[65:91] += 32
LOWER_CODES = CODES[_LOWER]
PRIME, PRIME_BASE = 2**31 - 1, 1_283_742_901
# An odd base of which 1 - base is divisible by 2 only once.
BASE = 0x5851F42D4C957F2B


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo the prime: n of them."""
    out = np.ones(1, U64)
    while len(out) < n:
        out = np.concatenate([out, out * U64(pow(base, len(out), PRIME)) % U64(PRIME)])
    return out[:n].copy()


class _Powers:
    """Powers of both bases and of their inverses, modulo 2^64 and modulo the prime, grown when a longer slice needs them."""

    def __init__(self) -> None:
        self.up = self.down = self.prime_up = self.prime_down = np.ones(1, U64)

    def reach(self, n: int) -> "_Powers":
        if len(self.up) < n + 1:
            n = max(n, SLICE_BYTES) + 1
            ones = np.ones(n, U64)
            up, down = ones * U64(BASE), ones * U64(pow(BASE, -1, 1 << 64))
            up[0] = down[0] = 1
            self.up, self.down = np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)
            self.prime_up, self.prime_down = _powers(PRIME_BASE, n), _powers(pow(PRIME_BASE, -1, PRIME), n)
        return self


POWERS = _Powers()


class QuickHash:
    """Prefix polynomial hashes modulo 2^64 over a byte array; any range is hashed in constant time.

    Texts of a known form (Thue-Morse words) have equal hashes for every base, so it is for where more is looked at before
    equality counts.
    """

    def __init__(self, data: np.ndarray, codes: np.ndarray = CODES) -> None:
        powers = POWERS.reach(len(data))
        self.down = powers.down
        self.prefix = np.zeros(len(data) + 1, U64)
        with np.errstate(over="ignore"):
            np.cumsum(codes[data] * powers.up[: len(data)], out=self.prefix[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.prefix[end] - self.prefix[start]) * self.down[start]


class PrimeHash:
    """The same modulo a prime of 31 bits; two different texts of n bytes agree with a chance of about n / 2^31."""

    def __init__(self, data: np.ndarray, codes: np.ndarray = CODES) -> None:
        powers = POWERS.reach(len(data))
        self.down = powers.prime_down
        # Sums of up to 2^33 numbers below 2^31 fit in 64 bits, so only the differences are reduced.
        self.prefix = np.zeros(len(data) + 1, U64)
        np.cumsum((codes % U64(PRIME))[data] * powers.prime_up[: len(data)] % U64(PRIME), out=self.prefix[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.prefix[end] - self.prefix[start]) % U64(PRIME) * self.down[start] % U64(PRIME)


class RangeHash:
    """Both hashes in one number: 64 bits for texts of no known form, and 31 for those that the quick one can't tell apart."""

    def __init__(self, data: np.ndarray, codes: np.ndarray = CODES) -> None:
        self.quick, self.prime = QuickHash(data, codes), PrimeHash(data, codes)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return self.quick(start, end) + self.prime(start, end) * U64(0x9E3779B97F4A7C15)


@dataclass
class Slice:
    """Rows ``first`` to ``last`` of a batch: their bytes side by side, and where each begins."""

    first: int
    last: int
    data: np.ndarray
    bounds: np.ndarray


def text_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a text column; a null counts as an empty text."""
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    bounds = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return bounds, body


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a text column into slices of whole rows."""
    bounds, data = text_parts(column)
    first, rows = 0, len(bounds) - 1
    while first < rows:
        last = int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1
        last = min(max(last, first + 1), rows)
        low, high = bounds[first], bounds[last]
        yield Slice(first, last, data[low:high], bounds[first : last + 1] - low)
        first = last


@dataclass
class Words:
    """Words of a slice: byte range, row within the slice, and a 64-bit hash that ignores the case of A-Z."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray
    counts: np.ndarray


def words(part: Slice) -> Words:
    n, rows = len(part.data), len(part.bounds) - 1
    solid = ~WHITE[part.data]
    starts, ends = solid.copy(), solid.copy()
    starts[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    inner = part.bounds[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    starts[inner] |= solid[inner]
    ends[inner - 1] |= solid[inner - 1]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    at = np.searchsorted(start, part.bounds)
    counts = np.diff(at)
    row = np.repeat(np.arange(rows), counts)
    with np.errstate(over="ignore"):
        code = mix(RangeHash(part.data, LOWER_CODES)(start, end) + (end - start).astype(U64))
    return Words(start, end, row, code, counts)


def fold(values: np.ndarray, starts: np.ndarray, seed: int) -> np.ndarray:
    """Order-free 64-bit digest of each run of values (runs must not be empty)."""
    with np.errstate(over="ignore"):
        return np.add.reduceat(mix(values, seed), starts)


def ragged(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of a row of runs."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` to a new folder below the shared checkpoint folder and read it back: cuts lineage, outlives executors."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
