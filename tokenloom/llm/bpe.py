"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one: a minimal perfect hash over the vocabulary's tokens resolves every pre-token that is itself a token, for all
distinct pre-tokens of a slice at once. Tier two: a pre-token that is not in the vocabulary is merged over a linked list
of its bytes, with a heap that yields the lowest rank first and the leftmost of equals.

Edge cases: a null text counts as empty and gives no ids; repeated rows are encoded each on their own; extra columns are
ignored; an empty table gives an empty result. A pre-token of n bytes takes n log n steps.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tokenloom.llm.common import U64, QuickHash, mix, ragged, slices, text_parts

CACHE_ENTRIES = 500_000
ENCODED = "doc_id long, ids binary, decoded binary"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> id, from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def hash_tokens(column: pa.Array) -> np.ndarray:
    bounds, data = text_parts(column)
    low = bounds[0]
    body = data[low : bounds[-1]]
    return mix(QuickHash(body)(bounds[:-1] - low, bounds[1:] - low) + np.diff(bounds).astype(U64))


@dataclass
class PerfectHash:
    """Minimal perfect hash by displacement: as many slots as tokens, one probe for each lookup."""

    shift: np.ndarray  # of each bucket: a seed, or -1 - slot where the bucket holds one token
    ids: np.ndarray  # of each slot

    @classmethod
    def build(cls, codes: np.ndarray, ids: np.ndarray) -> PerfectHash:
        n = len(codes)
        if n == 0:
            raise ValueError("the vocabulary is empty")
        if len(np.unique(codes)) < n:
            raise ValueError("two tokens have the same hash")
        buckets = max(1, n // 3)
        home = (codes % U64(buckets)).astype(np.int64)
        order = np.argsort(home, kind="stable")
        cuts = np.searchsorted(home[order], np.arange(buckets + 1))
        sizes = np.diff(cuts)
        shift, slots, free = np.zeros(buckets, np.int64), np.zeros(n, np.int64), np.ones(n, bool)
        seeds = np.arange(1, 65, dtype=U64)
        singles = []
        for b in np.argsort(-sizes, kind="stable"):
            members = order[cuts[b] : cuts[b + 1]]
            if len(members) < 2:
                singles += [(b, m) for m in members]
                continue
            base = U64(0)
            while True:
                tried = cls.place(codes[members][:, None], (base + seeds)[None, :], n)
                sorted_tries = np.sort(tried, axis=0)
                good = free[tried].all(axis=0) & (np.diff(sorted_tries, axis=0) > 0).all(axis=0)
                if good.any():
                    k = int(np.argmax(good))
                    shift[b] = int(base + seeds[k])
                    slots[members], free[tried[:, k]] = tried[:, k], False
                    break
                base += U64(64)
        for (b, m), slot in zip(singles, np.flatnonzero(free)):
            shift[b], slots[m] = -1 - slot, slot
        table = np.empty(n, np.int64)
        table[slots] = ids
        return cls(shift, table)

    @staticmethod
    def place(codes: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (mix(codes ^ (seeds * U64(0x9E3779B97F4A7C15))) % U64(n)).astype(np.int64)

    def lookup(self, codes: np.ndarray) -> np.ndarray:
        """The only id that each code can have; the caller compares the token's bytes."""
        shift = self.shift[(codes % U64(len(self.shift))).astype(np.int64)]
        slots = np.where(shift < 0, -1 - shift, self.place(codes, shift.astype(U64), len(self.ids)))
        return self.ids[slots]


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a piece by repeated merging of the pair with the lowest rank, leftmost first.

    A heap entry is the pair's rank in the high bits and its place in the low ones; an entry is stale if the pair at that
    place has another rank by now.
    """
    n = len(piece)
    get = ranks.get
    after, before = list(range(1, n + 2)), list(range(-1, n))
    current = [get(piece[i : i + 2], -1) for i in range(n - 1)] + [-1]
    heap = [rank << 32 | i for i, rank in enumerate(current) if rank >= 0]
    heapq.heapify(heap)
    pop, push = heapq.heappop, heapq.heappush
    while heap:
        entry = pop(heap)
        i = entry & 0xFFFFFFFF
        if current[i] != entry >> 32:
            continue
        gone = after[i]
        right = after[i] = after[gone]
        current[gone] = -1
        before[right] = i
        if right < n:
            rank = current[i] = get(piece[i : after[right]], -1)
            if rank >= 0:
                push(heap, rank << 32 | i)
        else:
            current[i] = -1
        left = before[i]
        if left >= 0:
            rank = current[left] = get(piece[left:right], -1)
            if rank >= 0:
                push(heap, rank << 32 | left)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


class Codec:
    """Vocabulary, its perfect hash and the pre-token pattern; small and of fixed size, so it may be broadcast."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"bytes without a token of their own: {missing[:5]}")
        self.ranks, self.pattern = ranks, pattern
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        codes = hash_tokens(pa.array(list(ranks), pa.binary()))
        self.perfect = PerfectHash.build(codes, np.array(list(ranks.values()), np.int64))

    def resolve(self, pieces: pa.Array, cache: dict[bytes, tuple]) -> list[tuple]:
        """Ids of each distinct pre-token."""
        guesses = self.perfect.lookup(hash_tokens(pieces)).tolist()
        tokens, ranks, out = self.tokens, self.ranks, []
        for guess, piece in zip(guesses, pieces.cast(pa.binary()).to_pylist()):
            if tokens[guess] == piece:
                out.append((guess,))
                continue
            found = cache.get(piece)
            if found is None:
                found = tuple(merge_bytes(piece, ranks))
                if len(piece) <= 64:
                    if len(cache) >= CACHE_ENTRIES:
                        cache.clear()
                    cache[piece] = found
            out.append(found)
        return out

    def encode(self, texts: list[str], cache: dict[bytes, tuple]) -> list[np.ndarray]:
        """Ids of each text."""
        split = regex.compile(self.pattern).findall
        found: list[str] = []
        counts = []
        for text in texts:
            matches = split(text)
            found += matches
            counts.append(len(matches))
        if not found:
            return [np.zeros(0, np.uint32) for _ in texts]
        coded = pa.array(found, pa.string()).dictionary_encode()
        known = self.resolve(coded.dictionary, cache)
        lengths = np.array([len(ids) for ids in known], np.int64)
        flat = np.array([i for ids in known for i in ids], np.uint32)
        starts = np.cumsum(lengths) - lengths
        which = coded.indices.to_numpy()
        sizes = lengths[which]
        ids = flat[np.repeat(starts[which], sizes) + ragged(sizes)]
        per_text = np.add.reduceat(np.append(sizes, 0), np.minimum(np.cumsum([0, *counts[:-1]]), len(sizes)))
        per_text[np.array(counts) == 0] = 0
        return np.split(ids, np.cumsum(per_text)[:-1])

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


def _coded(codec, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[np.ndarray], list[bytes]]]:
    """Keys, ids and decoded bytes of the rows of each slice."""
    cache: dict[bytes, tuple] = {}
    for batch in batches:
        column = batch.column(1)
        for part in slices(column):
            texts = [t or "" for t in column.slice(part.first, part.last - part.first).to_pylist()]
            ids = codec.value.encode(texts, cache)
            yield batch.column(0).slice(part.first, len(texts)), ids, [codec.value.decode(x) for x in ids]


def shared(df: DataFrame, path: str, pattern: str):
    """The codec, broadcast: its size is that of the vocabulary file."""
    return df.sparkSession.sparkContext.broadcast(Codec(read_ranks(path), pattern))


def encode(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every text's ids (little-endian unsigned 32-bit integers side by side) and the bytes they decode to."""
    codec = shared(df, path, pattern)

    def run(batches):
        for keys, ids, decoded in _coded(codec, batches):
            packed = [x.astype("<u4").tobytes() for x in ids]
            yield pa.record_batch([keys, pa.array(packed, pa.binary()), pa.array(decoded, pa.binary())], ["doc_id", "ids", "decoded"])

    return df.select(df[key].cast("long").alias("doc_id"), df[text].alias("text")).mapInArrow(run, ENCODED)


def digests(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``encode`` reduced to the token count and the SHA-256 of ids and decoded bytes."""
    codec = shared(df, path, pattern)

    def run(batches):
        for keys, ids, decoded in _coded(codec, batches):
            columns = [
                keys,
                pa.array([len(x) for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids]),
                pa.array([hashlib.sha256(x).hexdigest() for x in decoded]),
            ]
            yield pa.record_batch(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return df.select(df[key].cast("long").alias("doc_id"), df[text].alias("text")).mapInArrow(run, DIGESTS)
