"""Removal of long byte strings that occur more than once, by a suffix sort that compares with hashes.

Texts are UTF-8 bytes; a window is a string of ``length`` bytes within one text. Every byte covered by a window that also
starts anywhere else goes.

1. Prefix polynomial hashes give every 64-byte gram a hash. A window's anchor is its gram with the least hash, so equal
   windows have equal anchors. Neighbouring windows with one anchor are a run. Runs are dealt by the anchor's hash, one
   packed row for each task and bucket; runs that a task has seen twice are settled there and sent once, so a passage
   found everywhere makes one entry for each task.
2. A run whose whole bytes are found twice is repeated. A run whose anchor is found nowhere else is unique.
3. Only what is left (runs at the edge of a repeat) sends its bytes. Their window starts are suffix-sorted: ordered by
   the leading bytes, then by mergesort, in which two suffixes are compared by finding their common extension with a
   binary search over prefix hashes. Neighbours with a common extension of a whole window are equal; the bytes of these
   are compared before they count.

Texts are known by their MD5, so equal texts share their result and are never collected.

Edge cases: a null text is empty; a text shorter than a window loses nothing, repeated rows of at least that length lose
all; a null id is returned as it is; extra columns are ignored by ``spans`` and kept by ``without_repeats``. Where a
removal cuts a character, ``without_repeats`` drops its remaining bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import U64, PrimeHash, QuickHash, RangeHash, Slice, mix, ragged, slices, stored

LENGTH = 200
GRAM = 64
FLUSH_RUNS = 400_000
FLUSH_BYTES = 16 << 20
UNSETTLED, SETTLED, WITNESS = 0, 1, 2
PACKED = "bucket int, digests binary, key binary, whole binary, text binary, start binary, last binary, anchor binary, many binary"
FOUND = "digest binary, key long, start int, last int, anchor int, state int"
CONTEXTS = "bucket int, digests binary, key binary, text binary, start binary, size binary, state binary, body binary"
RANGES = "digest binary, start int, last int"


def digest(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def anchor_runs(part: Slice, length: int) -> tuple[np.ndarray, ...] | None:
    """Runs of windows with one anchor: row, first window, last window, anchor, hash of the gram and of all bytes covered.

    Of grams with the least hash the leftmost is the anchor, so the choice depends on the window's bytes alone.
    """
    data, n = part.data, len(part.data)
    width = length - GRAM + 1
    fits = np.diff(part.bounds) >= length
    if not fits.any():
        return None
    starts = np.zeros(n + 1, np.int8)
    starts[part.bounds[:-1][fits]] += 1
    starts[part.bounds[1:][fits] - length + 1] -= 1
    valid = np.flatnonzero(np.cumsum(starts[:-1], dtype=np.int8))
    # The choice of anchors concludes nothing from equal grams; the hash of all bytes covered does.
    hashed = RangeHash(data)
    at = np.arange(n - GRAM + 1)
    grams = mix(hashed.quick(at, at + GRAM))
    low = U64((1 << int(n).bit_length()) - 1)
    best = (grams & ~low) | at.astype(U64)
    span = 1
    while span * 2 <= width:
        best = np.minimum(best[:-span], best[span:])
        span *= 2
    if span < width:
        best = np.minimum(best[: len(best) - (width - span)], best[width - span :])
    anchor = (best[valid] & low).astype(np.int64)
    first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    end = np.r_[first[1:], len(anchor)] - 1
    start, last, anchor = valid[first], valid[end], anchor[first]
    row = np.searchsorted(part.bounds, start, "right") - 1
    with np.errstate(over="ignore"):
        whole = mix(hashed(start, last + length) + mix((anchor - start).astype(U64), 31))
    return row, start, last, anchor, grams[anchor], whole


def _split(order_by: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order by bucket, and where each bucket begins."""
    bucket = (mix(order_by, 41) % U64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _runs(length: int, buckets: int):
    def flush(held: list[tuple], digests: list[bytes]) -> Iterator[pa.RecordBatch]:
        text, start, last, anchor, key, whole = (np.concatenate(x) for x in zip(*held))
        # Equal texts of this task are one text here.
        names, text_of = _names(digests)
        text = text_of[text]
        order = np.lexsort((start, text, whole, key))
        text, start, last, anchor, key, whole = (x[order] for x in (text, start, last, anchor, key, whole))
        new = np.r_[True, (key[1:] != key[:-1]) | (whole[1:] != whole[:-1])]
        group = np.cumsum(new) - 1
        many = np.bincount(group)[group] > 1
        distinct = new | np.r_[True, (text[1:] != text[:-1]) | (start[1:] != start[:-1])]
        settled = many & distinct & ~new
        at = np.flatnonzero(settled)
        if len(at):
            yield _packed(-1, names, text[at], start[at], last[at], anchor[at], key[at], whole[at], many[at])
        sent = np.flatnonzero(new)
        order, cuts = _split(key[sent], buckets)
        for b in range(buckets):
            at = sent[order[cuts[b] : cuts[b + 1]]]
            if len(at):
                yield _packed(b, names, text[at], start[at], last[at], anchor[at], key[at], whole[at], many[at])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, digests, count = [], [], 0
        for batch in batches:
            for part in slices(batch.column(1)):
                found = anchor_runs(part, length)
                if found is None:
                    continue
                row, start, last, anchor, key, whole = found
                base = part.bounds[row]
                held.append((row + len(digests), start - base, last - base, anchor - base, key, whole))
                digests += batch.column(0).slice(part.first, part.last - part.first).to_pylist()
                count += len(row)
                if count >= FLUSH_RUNS:
                    yield from flush(held, digests)
                    held, digests, count = [], [], 0
        if held:
            yield from flush(held, digests)

    return run


def _names(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct digests as rows of two 64-bit numbers, and the row of each digest."""
    pairs = np.frombuffer(b"".join(digests), U64).reshape(-1, 2)
    return np.unique(pairs, axis=0, return_inverse=True)


def _packed(bucket, names, text, start, last, anchor, key, whole, many) -> pa.RecordBatch:
    used, text = np.unique(text, return_inverse=True)
    columns = [names[used], key, whole, text.astype(np.int32), start.astype(np.int32), last.astype(np.int32), anchor.astype(np.int32), many]
    cells = [pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in columns]
    return pa.record_batch([pa.array([bucket], pa.int32()), *cells], [c.split()[0] for c in PACKED.split(", ")])


def _cell(batch: pa.RecordBatch, name: str, row: int, kind) -> np.ndarray:
    return np.frombuffer(batch.column(name)[row].as_buffer(), kind)


def _found(names, text, key, start, last, anchor, state) -> pa.RecordBatch:
    pairs = np.ascontiguousarray(names[text])
    digests = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(pairs), [None, pa.py_buffer(pairs)]).cast(pa.binary())
    columns = [digests, pa.array(key.view(np.int64)), *(pa.array(x.astype(np.int32)) for x in (start, last, anchor, state))]
    return pa.record_batch(columns, [c.split()[0] for c in FOUND.split(", ")])


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All runs of some buckets: which are repeated as a whole, and which have to show their bytes."""
    held, names, offset = [], [], 0
    for batch in batches:
        for i in range(batch.num_rows):
            pairs = _cell(batch, "digests", i, U64).reshape(-1, 2)
            text, start, last, anchor = (_cell(batch, c, i, np.int32) for c in ("text", "start", "last", "anchor"))
            key, whole = _cell(batch, "key", i, U64), _cell(batch, "whole", i, U64)
            if batch.column("bucket")[i].as_py() < 0:
                yield _found(pairs, text, key, start, last, anchor, np.full(len(text), SETTLED))
                continue
            held.append((text.astype(np.int64) + offset, start, last, anchor, key, whole, _cell(batch, "many", i, np.bool_)))
            names.append(pairs)
            offset += len(pairs)
    if not held:
        return
    text, start, last, anchor, key, whole, many = (np.concatenate(x) for x in zip(*held))
    names = np.concatenate(names)
    order = np.lexsort((whole, key))
    text, start, last, anchor, key, whole, many = (x[order] for x in (text, start, last, anchor, key, whole, many))
    new_key = np.r_[True, key[1:] != key[:-1]]
    new = new_key | np.r_[True, whole[1:] != whole[:-1]]
    group, key_group = np.cumsum(new) - 1, np.cumsum(new_key) - 1
    repeated = (np.bincount(group, weights=many + 1.0)[group]) > 1
    kinds = np.bincount(key_group, weights=new)
    state = np.where(repeated, SETTLED, UNSETTLED)
    open_group = np.bincount(key_group, weights=~repeated) > 0
    state[new & repeated & open_group[key_group] & (kinds[key_group] > 1)] = WITNESS
    keep = repeated | (kinds[key_group] > 1)
    for at in np.array_split(np.flatnonzero(keep), max(1, keep.sum() // 50_000)):
        yield _found(names, text[at], key[at], start[at], last[at], anchor[at], state[at])


def _contexts(length: int, buckets: int):
    """Bytes of the runs that have to show them, packed by bucket."""

    def flush(held, digests):
        text, start, size, state, key = (np.concatenate(x) for x in list(zip(*held))[:5])
        bodies = [b for x in held for b in x[5]]
        order, cuts = _split(key, buckets)
        names, text_of = _names(digests)
        for b in range(buckets):
            at = order[cuts[b] : cuts[b + 1]]
            if not len(at):
                continue
            used, which = np.unique(text_of[text[at]], return_inverse=True)
            columns = [names[used], key[at], which.astype(np.int32), start[at], size[at], state[at]]
            cells = [pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in columns]
            cells.append(pa.array([b"".join(bodies[i] for i in at)], pa.binary()))
            yield pa.record_batch([pa.array([b], pa.int32()), *cells], [c.split()[0] for c in CONTEXTS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, digests, count = [], [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                body = batch.column("text")[i].as_buffer() or b""
                runs = batch.column("runs")[i].values
                start, last, state = (runs.field(c).to_numpy().astype(np.int32) for c in ("start", "last", "state"))
                key = runs.field("key").to_numpy().view(U64)
                size = last - start + length
                view = memoryview(body)
                shown = [bytes(view[s : s + n]) for s, n in zip(start.tolist(), size.tolist())]
                held.append((np.full(len(start), len(digests)), start, size, state, key, shown))
                digests.append(batch.column("digest")[i].as_py())
                count += int(size.sum())
                if count >= FLUSH_BYTES:
                    yield from flush(held, digests)
                    held, digests, count = [], [], 0
        if held:
            yield from flush(held, digests)

    return run


class Suffixes:
    """Suffixes of a byte array, compared over at most ``length`` bytes with prefix hashes."""

    def __init__(self, data: np.ndarray, length: int) -> None:
        self.data, self.length = data, length
        self.quick, self.prime = QuickHash(data), PrimeHash(data)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of two suffixes, by binary search over the quick hash.

        That is never too short. Where the prime hash of what was found differs, the search is done again with that one.
        """
        prefix, down = self.quick.prefix, self.quick.down
        from_a, from_b, down_a, down_b = prefix[a], prefix[b], down[a], down[b]
        with np.errstate(over="ignore"):
            low = self._search(len(a), lambda n: (prefix[a + n] - from_a) * down_a == (prefix[b + n] - from_b) * down_b)
        wrong = np.flatnonzero(self.prime(a, a + low) != self.prime(b, b + low))
        if len(wrong):
            low[wrong] = self._search(len(wrong), lambda n: self.prime(a[wrong], a[wrong] + n) == self.prime(b[wrong], b[wrong] + n))
        return low

    def _search(self, number: int, agree) -> np.ndarray:
        low, high = np.zeros(number, np.int64), np.full(number, self.length, np.int64)
        for _ in range(int(self.length).bit_length()):
            middle = (low + high + 1) >> 1
            same = agree(middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def less(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        shared = self.common(a, b)
        inside = shared < self.length
        shift = np.where(inside, shared, 0)
        return inside & (self.data[a + shift] < self.data[b + shift])

    def sort(self, at: np.ndarray) -> np.ndarray:
        """Suffixes in order: by their first eight bytes, then by merging runs of equal heads."""
        head = np.zeros(len(at), U64)
        for k in range(8):
            head = (head << U64(8)) | self.data[at + k]
        order = np.argsort(head, kind="stable")
        at, head = at[order], head[order]
        first = np.flatnonzero(np.r_[True, head[1:] != head[:-1]])
        sizes = np.diff(np.r_[first, len(at)])
        base, place = np.repeat(first, sizes), ragged(sizes)
        total = np.repeat(sizes, sizes)
        width = 1
        while True:
            # Elements of blocks that have a second half; each is ranked in the other half.
            block = place // (2 * width) * (2 * width)
            mine = np.flatnonzero(block + width < total)
            if not len(mine):
                return at
            left = place[mine] - block[mine] < width
            low = base[mine] + block[mine] + np.where(left, width, 0)
            high = np.minimum(low + width, base[mine] + total[mine])
            origin = low.copy()
            self_at = at[mine]
            while True:
                active = np.flatnonzero(low < high)
                if not len(active):
                    break
                middle = (low[active] + high[active]) >> 1
                x, y = self_at[active], at[middle]
                # Left elements go before equal right ones.
                below = np.where(left[active], self.less(y, x), ~self.less(x, y))
                low[active] = np.where(below, middle + 1, low[active])
                high[active] = np.where(below, high[active], middle)
            within = place[mine] - block[mine] - np.where(left, 0, width)
            moved = at.copy()
            moved[base[mine] + block[mine] + within + (low - origin)] = self_at
            at = moved
            width *= 2

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether two suffixes agree in all their bytes; what the hashes call equal is compared byte by byte."""
        same = self.common(a, b) == self.length
        step = np.arange(self.length)
        for at in np.array_split(np.flatnonzero(same), max(1, int(same.sum()) // 20_000)):
            same[at] = (self.data[a[at][:, None] + step] == self.data[b[at][:, None] + step]).all(axis=1)
        return same


def _windows(length: int):
    """Which windows of the shown runs are repeated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bodies, names, offset = [], [], [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                pairs = _cell(batch, "digests", i, U64).reshape(-1, 2)
                text, start, size, state = (_cell(batch, c, i, np.int32) for c in ("text", "start", "size", "state"))
                held.append((text.astype(np.int64) + offset, start.astype(np.int64), size.astype(np.int64), state, _cell(batch, "key", i, U64)))
                bodies.append(_cell(batch, "body", i, np.uint8))
                names.append(pairs)
                offset += len(pairs)
        if not held:
            return
        text, start, size, state, key = (np.concatenate(x) for x in zip(*held))
        data, names = np.concatenate(bodies), np.concatenate(names)
        place = np.cumsum(size) - size
        # Anchors part the runs, so they are sorted in portions of whole anchors.
        order = np.argsort(key, kind="stable")
        many = np.cumsum((size - length + 1)[order])
        fresh = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]])
        cuts = [0, *(int(fresh[i]) for i in np.unique(np.searchsorted(many[fresh], np.arange(200_000, many[-1], 200_000))) if 0 < i < len(fresh)), len(order)]
        for low, high in zip(cuts, cuts[1:]):
            runs = order[low:high]
            if not len(runs):
                continue
            windows = size[runs] - length + 1
            body = data[np.repeat(place[runs], size[runs]) + ragged(size[runs])]
            own = np.cumsum(size[runs]) - size[runs]
            at = np.repeat(own, windows) + ragged(windows)
            suffixes = Suffixes(body, length)
            sorted_at = suffixes.sort(at)
            same = suffixes.equal(sorted_at[1:], sorted_at[:-1])
            hit = np.zeros(len(body) + 1, bool)
            hit[sorted_at[1:][same]] = hit[sorted_at[:-1][same]] = True
            # Runs of repeated windows, within the runs that were open.
            open_ = np.zeros(len(body) + 1, bool)
            open_[at] = np.repeat(state[runs] == UNSETTLED, windows)
            hit &= open_
            edge = np.diff(np.r_[False, hit].astype(np.int8))
            begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
            if not len(begin):
                continue
            run_of = np.searchsorted(own, begin, "right") - 1
            shift = start[runs][run_of] - own[run_of]
            found = _found(names, text[runs][run_of], key[runs][run_of], begin + shift, end + shift, begin, np.zeros(len(begin)))
            yield found.select(["digest", "start", "last"])

    return run


def ranges(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """(digest, start, last): starts of repeated windows of every distinct text, as ranges."""
    if length < GRAM + 8:
        raise ValueError(f"a window has at least {GRAM + 8} bytes")
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    body = F.coalesce(docs[text], F.lit("")).alias("text")
    named = docs.select(digest(docs[text]).alias("digest"), body)
    dealt = named.mapInArrow(_runs(length, buckets), PACKED).repartition(buckets, "bucket")
    found = stored(dealt.mapInArrow(_settle, FOUND))
    shown = (
        found.where(f"state <> {SETTLED}")
        .groupBy("digest")
        .agg(F.collect_set(F.struct("start", "last", "state", "key")).alias("runs"))
    )
    contexts = named.join(shown, "digest").select("digest", "text", "runs").mapInArrow(_contexts(length, buckets), CONTEXTS)
    edges = contexts.repartition(buckets, "bucket").mapInArrow(_windows(length), RANGES)
    return found.where(f"state <> {UNSETTLED}").select("digest", "start", "last").union(edges)


def _cut(length: int, keep_bytes: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, spans = batch.column(0), batch.column(2)
            for part in slices(batch.column(1)):
                n_bytes, removed, count, out = [], [], [], []
                for i in range(part.first, part.last):
                    low, high = part.bounds[i - part.first : i - part.first + 2]
                    data = part.data[low:high]
                    found = spans[i].values
                    gone = np.zeros(len(data) + 1, np.int32)
                    if found is not None and len(found):
                        np.add.at(gone, found.field("start").to_numpy(), 1)
                        np.add.at(gone, found.field("last").to_numpy() + length, -1)
                    mask = np.cumsum(gone[:-1]) > 0
                    rest = data[~mask].tobytes()
                    n_bytes.append(len(data))
                    removed.append(int(mask.sum()))
                    count.append(int((np.diff(np.r_[False, mask].astype(np.int8)) == 1).sum()))
                    out.append(rest if keep_bytes else hashlib.sha256(rest).hexdigest())
                own = keys.slice(part.first, part.last - part.first)
                last = pa.array([x.decode("utf-8", "ignore") for x in out]) if keep_bytes else pa.array(out, pa.string())
                yield pa.record_batch(
                    [own, pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), last],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    return run


def _joined(docs: DataFrame, key: Column, text: str, length: int) -> DataFrame:
    spans = ranges(docs, text, length).groupBy("digest").agg(F.collect_set(F.struct("start", "last")).alias("spans"))
    named = docs.select(key.alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("text"), digest(docs[text]).alias("digest"))
    return named.join(spans, "digest", "left").select("doc_id", "text", "spans")


def spans(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept string"
    return (
        _joined(docs, docs[key].cast("long"), text, length)
        .mapInArrow(_cut(length, False), schema)
        .withColumnRenamed("kept", "kept_sha256")
    )


def without_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """The documents without their repeated bytes; all other columns are kept."""
    others = F.struct(*[docs[c] for c in docs.columns])
    joined = _joined(docs, others, text, length)
    schema = f"doc_id {joined.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept string"
    cut = joined.mapInArrow(_cut(length, True), schema)
    return cut.select(*[F.col("kept").alias(c) if c == text else F.col("doc_id")[c].alias(c) for c in docs.columns])
