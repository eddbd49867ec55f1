"""Arrow-batch helpers. Each works on whole batches with numpy; Spark does the partitioning and the shuffles."""

import itertools
import math
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Ship these helpers inside the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NO_RANK = np.iinfo(np.int64).max
# Tokens or bytes worked on at a time, so that working memory follows the slice and not the batch, and words kept merged.
SLICE = 1 << 19
CACHED_WORDS = 1 << 17


def flat_bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row offsets and the joined bytes of a binary or string array."""
    wide = pa.types.is_large_binary(values.type) or pa.types.is_large_string(values.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, dtype=kind, count=values.offset + len(values) + 1)[values.offset :].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return at - at[0], raw[at[0] : at[-1]]


def flat_lists(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row offsets and the joined items of a list array of integers (null rows count as empty)."""
    return list_offsets(values), values.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def list_offsets(values: pa.Array) -> np.ndarray:
    """Row offsets into ``values.flatten()``."""
    sizes = pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False)
    offsets = np.zeros(len(values) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    return offsets


def as_lists(offsets: np.ndarray, items: np.ndarray, like: pa.Array) -> pa.Array:
    mask = like.is_null() if like.null_count else None
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(items.astype(np.int32, copy=False)), mask=mask)


def spans(n: int):
    """Ranges of at most ``SLICE`` places of ``n``."""
    return ((low, min(low + SLICE, n)) for low in range(0, n, SLICE))


def expand(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions start, start+1, ... of each (start, size) range, joined."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)


def code_lookup(table: np.ndarray):
    """binary (one byte per token) -> list of token ids."""

    def run(codes: pa.Array) -> pa.Array:
        offsets, raw = flat_bytes(codes)
        ids = np.empty(len(raw), np.int32)
        for low, high in spans(len(raw)):
            ids[low:high] = table[raw[low:high]]
        return as_lists(offsets, ids, codes)

    return run


def id_bytes(pieces: list[bytes], skip: tuple[int, ...]):
    """list of token ids -> the bytes they stand for; ids in ``skip`` give nothing."""
    kept = [b"" if i in skip else p for i, p in enumerate(pieces)]
    sizes = np.array([len(p) for p in kept], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    raw = np.frombuffer(b"".join(kept), np.uint8)

    def run(ids: pa.Array) -> pa.Array:
        offsets, items = list_offsets(ids), ids.flatten().to_numpy(zero_copy_only=False)
        ends, parts, total = np.zeros(len(offsets), np.int32), [], 0
        for low, high in spans(len(items)):
            some = items[low:high]
            lengths = sizes[some]
            upto = total + np.cumsum(lengths)
            first, last = np.searchsorted(offsets, [low, high], "right")
            ends[first:last] = upto[offsets[first:last] - low - 1]
            parts.append(raw[expand(starts[some], lengths)])
            total = int(upto[-1])
        mask = pc.invert(ids.is_null()).buffers()[1] if ids.null_count else None
        data = np.concatenate(parts) if parts else raw[:0]
        return pa.BinaryArray.from_buffers(pa.binary(), len(ids), [mask, pa.py_buffer(ends), pa.py_buffer(data)])

    return run


class Merges:
    """Merge rules in lookup form: sorted pair keys with the rank and the merged id of each."""

    def __init__(self, pairs: list[tuple[int, int]], merged: list[int], n_ids: int, ranks: list[int] | None = None):
        self.n_ids = n_ids
        keys = np.array([left * n_ids + right for left, right in pairs], np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ranks = (np.arange(len(keys)) if ranks is None else np.array(ranks, np.int64))[order]
        self.merged = np.zeros(1 + max(self.ranks, default=-1), np.int64)
        self.merged[self.ranks] = np.array(merged, np.int64)[order]

    def rank_pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(left), NO_RANK)
        wanted = left * self.n_ids + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NO_RANK)


def merge_words(offsets: np.ndarray, ids: np.ndarray, merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Merge every word of a batch side by side: in each round a word merges its own lowest-ranked pair."""
    n_words = len(offsets) - 1
    word = np.repeat(np.arange(n_words), np.diff(offsets))
    ids = ids.astype(np.int64)
    done_words, done_ids = [], []
    while len(ids):
        ranks = np.full(len(ids), NO_RANK)
        inside = word[:-1] == word[1:]
        ranks[:-1][inside] = merges.rank_pairs(ids[:-1][inside], ids[1:][inside])
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        best = np.repeat(np.minimum.reduceat(ranks, starts), np.diff(np.r_[starts, len(ids)]))
        finished = best == NO_RANK
        done_words.append(word[finished])
        done_ids.append(ids[finished])
        if finished.all():
            break
        going = ~finished
        ids, word, ranks, best = ids[going], word[going], ranks[going], best[going]
        hit = ranks == best
        # In a run such as "aaaa" hits overlap: take the first, third, ... of the run.
        at = np.arange(len(hit))
        run_start = np.maximum.accumulate(np.where(hit & ~np.r_[False, hit[:-1]], at, 0))
        hit &= (at - run_start) % 2 == 0
        ids[hit] = merges.merged[ranks[hit]]
        keep = ~np.r_[False, hit[:-1]]
        ids, word = ids[keep], word[keep]
    if done_ids:
        word, ids = np.concatenate(done_words), np.concatenate(done_ids)
        order = np.argsort(word, kind="stable")
        word, ids = word[order], ids[order]
    sizes = np.bincount(word, minlength=n_words) if len(word) else np.zeros(n_words, np.int64)
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), ids


def summed(keys: list[np.ndarray], weights: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Sum weights over equal key tuples (exact integers)."""
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    if not len(order):
        return keys, weights
    change = np.r_[True, np.any([k[1:] != k[:-1] for k in keys], axis=0)]
    starts = np.flatnonzero(change)
    return [k[starts] for k in keys], np.add.reduceat(weights[order], starts)


class Literals:
    """A byte trie over any number of literals, walked from all places of a batch side by side.

    A walk starts wherever some literal's first byte stands and is as long as the longest literal at most, so no place is
    read more often than that. Of overlapping matches the leftmost counts, of those at one place the longest.
    """

    def __init__(self, literals: dict[str, int]):
        self.next = np.zeros((1, 256), np.int32)
        self.ids = np.full(1, -1, np.int64)
        for literal, token_id in literals.items():
            state = 0
            for byte in literal.encode():
                if not self.next[state, byte]:
                    self.next[state, byte] = len(self.next)
                    self.next = np.concatenate([self.next, np.zeros((1, 256), np.int32)])
                    self.ids = np.r_[self.ids, -1]
                state = self.next[state, byte]
            if state:
                self.ids[state] = token_id

    def find(self, offsets: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and id of every match; no match crosses a row."""
        first = self.next[0] > 0
        found = [low + np.flatnonzero(first[raw[low:high]]) for low, high in spans(len(raw))]
        start = np.concatenate([np.empty(0, np.int64), *found])
        limit = offsets[np.searchsorted(offsets, start, "right")] if len(start) else start
        end, found = np.zeros(len(start), np.int64), np.full(len(start), -1, np.int64)
        going, at, state = np.arange(len(start)), start.copy(), np.zeros(len(start), np.int32)
        while len(going):
            state = self.next[state, raw[at]]
            at = at + 1
            hit = self.ids[state] >= 0
            end[going[hit]], found[going[hit]] = at[hit], self.ids[state[hit]]
            on = (state > 0) & (at < limit[going])
            going, at, state = going[on], at[on], state[on]
        hit = found >= 0
        start, end, found = start[hit], end[hit], found[hit]
        if (start[1:] < end[:-1]).any():
            keep, free = np.zeros(len(start), bool), 0
            for i, (s, e) in enumerate(zip(start.tolist(), end.tolist())):
                if s >= free:
                    keep[i], free = True, e
            start, end, found = start[keep], end[keep], found[keep]
        return start, end, found


def literal_splitter(literals: Literals):
    """text -> the pieces between special literals, and the id of the literal after each piece (-1 after the last)."""

    def run(texts: pa.Array) -> pa.Array:
        offsets, raw = flat_bytes(texts)
        start, end, found = literals.find(offsets, raw)
        row = np.searchsorted(offsets, start, "right") - 1
        sizes = np.bincount(row, minlength=len(texts)) + 1
        bounds = np.r_[0, np.cumsum(sizes)]
        # A row's pieces begin at its start and after each literal, and end before each literal and at its end.
        last = np.zeros(bounds[-1], bool)
        last[bounds[1:] - 1] = True
        first = np.zeros(bounds[-1], bool)
        first[bounds[:-1]] = True
        begins, ends, marks = np.empty(bounds[-1], np.int64), np.empty(bounds[-1], np.int64), np.full(bounds[-1], -1)
        begins[first], begins[~first] = offsets[:-1], end
        ends[last], ends[~last], marks[~last] = offsets[1:], start, found
        lengths = ends - begins
        # Literals do not overlap, so one mark at each end tells what lies inside one.
        inside = np.zeros(len(raw) + 1, np.int8)
        inside[start] += 1
        inside[end] -= 1
        data = raw[np.cumsum(inside[:-1], dtype=np.int8) == 0] if len(start) else np.ascontiguousarray(raw)
        at = np.r_[0, np.cumsum(lengths)].astype(np.int32)
        pieces = pa.StringArray.from_buffers(len(lengths), pa.py_buffer(at), pa.py_buffer(data))
        lists = pa.array(bounds.astype(np.int32))
        columns = [pa.ListArray.from_arrays(lists, x) for x in (pieces, pa.array(marks.astype(np.int32)))]
        return pa.StructArray.from_arrays(columns, ["pieces", "marks"])

    return run


class MergedWords:
    """Words with their merges applied, kept from batch to batch: most words of a batch were in an earlier one."""

    def __init__(self, byte_table: np.ndarray, merges: Merges):
        self.byte_table, self.merges = byte_table, merges
        self.forget()

    def forget(self) -> None:
        self.known, self.at, self.ids = {}, np.zeros(1, np.int64), np.empty(0, np.int64)

    def of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Start and size in ``ids`` of each of some distinct words."""
        if len(self.known) + len(words) > CACHED_WORDS:
            self.forget()
        names = words.cast(pa.binary()).to_pylist()
        place = np.fromiter((self.known.get(name, -1) for name in names), np.int64, len(names))
        fresh = np.flatnonzero(place < 0)
        if len(fresh):
            offsets, raw = flat_bytes(words.take(pa.array(fresh)))
            at, ids = merge_words(offsets, self.byte_table[raw], self.merges)
            place[fresh] = np.arange(len(self.known), len(self.known) + len(fresh))
            self.known.update(zip([names[i] for i in fresh.tolist()], place[fresh].tolist()))
            self.at, self.ids = np.r_[self.at, len(self.ids) + at[1:]], np.r_[self.ids, ids]
        return self.at[place], self.at[place + 1] - self.at[place]


def word_encoder(byte_table: np.ndarray, merges: Merges):
    """list of words per piece and row, and the literal after each piece -> token ids per row.

    Each distinct word is merged once, as long as it is kept. Bytes without a token give nothing.
    """
    merged = MergedWords(byte_table, merges)

    def some_rows(words: pa.Array, word_at: np.ndarray, piece_at: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        coded = words.dictionary_encode()
        which = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        starts, sizes = merged.of(coded.dictionary)
        # The words of a piece, then its literal.
        order = np.empty(len(which) + len(mark), np.int64)
        piece = np.repeat(np.arange(len(mark)), np.diff(word_at))
        order[np.arange(len(which)) + piece] = which
        order[word_at[1:] + np.arange(len(mark))] = len(sizes) + np.arange(len(mark))
        starts, sizes = np.r_[starts, len(merged.ids) + np.arange(len(mark))], np.r_[sizes, (mark >= 0).astype(np.int64)]
        lengths = sizes[order]
        flat = np.r_[merged.ids, mark][expand(starts[order], lengths)]
        ends = np.r_[0, np.cumsum(lengths)][(word_at + np.arange(len(word_at)))[piece_at]]
        known = flat < merges.n_ids - 1
        if not known.all():
            flat, ends = flat[known], np.r_[0, np.cumsum(known)][ends]
        return np.diff(ends), flat.astype(np.int32)

    def run(words: pa.Array, marks: pa.Array) -> pa.Array:
        piece_at, pieces = list_offsets(words), words.flatten()
        word_at, flat = list_offsets(pieces), pieces.flatten()
        mark = marks.flatten().to_numpy(zero_copy_only=False)
        sizes, ids = [np.zeros(1, np.int64)], [np.empty(0, np.int32)]
        for low, high in row_slices(word_at[piece_at] + piece_at, SLICE):
            first, last = piece_at[low], piece_at[high]
            begin, end = word_at[first], word_at[last]
            found = some_rows(
                flat[begin:end], word_at[first : last + 1] - begin, piece_at[low : high + 1] - first, mark[first:last].astype(np.int64)
            )
            sizes.append(found[0])
            ids.append(found[1])
        return as_lists(np.cumsum(np.concatenate(sizes)), np.concatenate(ids), words)

    return run


def pair_sums(at: np.ndarray, ids: np.ndarray, weight: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Adjacent pairs (left, right) of words side by side, with the weights of their words summed."""
    word = np.repeat(np.arange(len(at) - 1), np.diff(at))
    inside = word[:-1] == word[1:]
    return summed([ids[:-1][inside], ids[1:][inside]], weight[word[:-1][inside]])


def pair_batch(pairs: list[np.ndarray], total: np.ndarray) -> pa.RecordBatch:
    columns = [*(pa.array(x.astype(np.int32)) for x in pairs), pa.array(total.astype(np.int64))]
    return pa.RecordBatch.from_arrays(columns, names=["left_id", "right_id", "n"])


def packed_lists(at: np.ndarray, ids: np.ndarray) -> pa.Array:
    """Id lists as BINARY of 32-bit numbers."""
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(at) - 1, [None, pa.py_buffer((at * 4).astype(np.int32).tobytes()), pa.py_buffer(ids.astype(np.int32).tobytes())]
    )


def unpacked_lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets, raw = flat_bytes(column)
    return offsets // 4, raw.view(np.int32).astype(np.int64)


# Stands for a null inside a packed list.
NO_ID = np.iinfo(np.int32).min


def list_packer(values: pa.Array) -> pa.Array:
    """list of 32-bit ids -> BINARY, four bytes for each id."""
    offsets, items = list_offsets(values), pc.fill_null(values.flatten(), NO_ID).to_numpy(zero_copy_only=False)
    mask = pc.invert(values.is_null()).buffers()[1] if values.null_count else None
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(values), [mask, pa.py_buffer((offsets * 4).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(items))]
    )


def list_unpacker(packed: pa.Array) -> pa.Array:
    """BINARY of ``list_packer`` -> list of ids."""
    offsets, raw = flat_bytes(packed)
    items = raw.view(np.int32)
    mask = packed.is_null() if packed.null_count else None
    values = pa.array(items, mask=items == NO_ID) if (items == NO_ID).any() else pa.array(items)
    return pa.ListArray.from_arrays(pa.array((offsets // 4).astype(np.int32)), values, mask=mask)


def word_ids(byte_table: np.ndarray):
    """(word, n) batches -> (ids, n), one id per byte."""

    def run(batches):
        for batch in batches:
            offsets, raw = flat_bytes(batch.column(0))
            yield pa.RecordBatch.from_arrays([packed_lists(offsets, byte_table[raw]), batch.column(1)], names=["ids", "n"])

    return run


def pair_counter():
    """(ids, n) batches -> counts of adjacent id pairs, summed per batch."""

    def run(batches):
        for batch in batches:
            yield pair_batch(*pair_sums(*unpacked_lists(batch.column(0)), batch.column(1).to_numpy()))

    return run


def touched(at: np.ndarray, ids: np.ndarray, merges: Merges) -> np.ndarray:
    """Words in which some merge applies."""
    word = np.repeat(np.arange(len(at) - 1), np.diff(at))
    hit = (word[:-1] == word[1:]) & (merges.rank_pairs(ids[:-1], ids[1:]) != NO_RANK)
    out = np.zeros(len(at) - 1, bool)
    out[word[:-1][hit]] = True
    return out


def some_lists(at: np.ndarray, ids: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    rows = np.flatnonzero(which)
    sizes = np.diff(at)[rows]
    return np.r_[0, np.cumsum(sizes)], ids[expand(at[:-1][rows], sizes)]


def pair_changes(merges: Merges):
    """(ids, n) batches -> signed changes of pair counts once ``merges`` apply; only the words they touch are counted."""

    def run(batches):
        for batch in batches:
            at, ids = unpacked_lists(batch.column(0))
            which = touched(at, ids, merges)
            if which.any():
                weight = batch.column(1).to_numpy()[which]
                before = some_lists(at, ids, which)
                gone, gone_n = pair_sums(*before, weight)
                made, made_n = pair_sums(*merge_words(*before, merges), weight)
                pairs, total = summed([np.r_[g, m] for g, m in zip(gone, made)], np.r_[-gone_n, made_n])
                changed = total != 0
                yield pair_batch([p[changed] for p in pairs], total[changed])

    return run


def merged_words(merges: Merges):
    """(ids, n) batches with ``merges`` applied."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([packed_lists(*merge_words(*unpacked_lists(batch.column(0)), merges)), batch.column(1)], names=["ids", "n"])

    return run


def counted(keys: list[np.ndarray], sizes: list[int]) -> tuple[list[np.ndarray], np.ndarray]:
    """How often each key tuple occurs; key i is below ``sizes[i]``."""
    if math.prod(sizes) >= 2**63:
        return summed(keys, np.ones(len(keys[0]), np.int64))
    # Sorting one packed number is several times faster than sorting tuples.
    packed = keys[0].astype(np.int64)
    for key, size in zip(keys[1:], sizes[1:]):
        packed = packed * size + key
    packed.sort()
    starts = np.flatnonzero(np.r_[True, packed[1:] != packed[:-1]]) if len(packed) else np.empty(0, np.int64)
    counts = np.diff(np.r_[starts, len(packed)])
    rest, out = packed[starts], []
    for size in reversed(sizes[1:]):
        out.append(rest % size)
        rest = rest // size
    return [rest, *reversed(out)], counts


def row_slices(offsets: np.ndarray, limit: int = 1 << 18):
    """Ranges of whole rows of about ``limit`` tokens, so that memory follows the slice and not the batch."""
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = min(rows, max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1))
        yield low, high
        low = high


def token_batches(batches, table: np.ndarray):
    """(key, tokens) batches -> (keys, group of each token, place of each token in its row, ids), a slice at a time.

    Tokens are id lists, or byte codes that ``table`` turns into ids.
    """
    for names, groups, offsets, ids in token_rows(batches, table):
        sizes = np.diff(offsets)
        yield names, np.repeat(groups, sizes), np.arange(len(ids)) - np.repeat(offsets[:-1], sizes), ids.astype(np.int64)


def token_rows(batches, table: np.ndarray, *limit: int):
    """(key, tokens) batches -> (keys, group of each row, row offsets, ids), a slice of ``row_slices`` at a time."""
    for batch in batches:
        tokens = batch.column(1)
        if pa.types.is_binary(tokens.type) or pa.types.is_large_binary(tokens.type):
            codes, (whole, raw) = table, flat_bytes(tokens)
        else:
            codes, whole, raw = None, list_offsets(tokens), tokens.flatten().to_numpy(zero_copy_only=False)
        coded = batch.column(0).dictionary_encode(null_encoding="encode")
        groups = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        for low, high in row_slices(whole, *limit):
            offsets, ids = whole[low : high + 1] - whole[low], raw[whole[low] : whole[high]]
            yield coded.dictionary, groups[low:high], offsets, ids if codes is None else codes[ids]


def ngram_counter(orders: tuple[int, ...], n_ids: int, table: np.ndarray):
    """(key, tokens) batches -> partial counts per (key, order, context, next id).

    A context is written as one number in base ``n_ids``; no n-gram crosses a row.
    """

    def run(batches):
        for names, group, place, ids in token_batches(batches, table):
            for order in orders:
                last = np.flatnonzero(place >= order - 1)
                context = np.zeros(len(last), np.int64)
                for back in range(order - 1, 0, -1):
                    context = context * n_ids + ids[last - back]
                keys, bounds = [group[last], context, ids[last]], [max(1, len(names)), n_ids ** (order - 1), n_ids]
                (g, ctx, nxt), total = counted(keys, bounds)
                yield gram_batch(names, g, order, pa.array(ctx), nxt, total)

    return run


def gram_batch(names: pa.Array, group, order: int, context: pa.Array, nxt, total) -> pa.RecordBatch:
    columns = [names.take(pa.array(group)), pa.array(np.full(len(group), order, np.int32)), context, pa.array(nxt.astype(np.int32)), pa.array(total)]
    return pa.RecordBatch.from_arrays(columns, names=["key", "gram", "ctx", "nxt", "n"])


def wide_ngram_counter(orders: tuple[int, ...], table: np.ndarray):
    """Like ``ngram_counter`` for any order and any number of ids: a context is BINARY, four bytes for each id, oldest first.

    Inside a slice contexts are numbered: that of one order is the number of the next lower one's and one id more.
    """

    def run(batches):
        for names, group, place, ids in token_batches(batches, table):
            number, at = group, np.arange(len(ids))
            for order in range(1, max(orders) + 1):
                if order > 1:
                    fits = place[at] >= order - 1
                    at, number = at[fits], number[fits]
                    number = np.unique(number << 32 | ids[at - order + 1], return_inverse=True)[1]
                if order not in orders or not len(at):
                    continue
                _, first, total = np.unique(number << 32 | ids[at], return_index=True, return_counts=True)
                here = at[first]
                older = here[:, None] - np.arange(order - 1, 0, -1)
                raw = np.ascontiguousarray(ids[older].astype(">u4"))
                bounds = np.arange(len(here) + 1, dtype=np.int32) * (4 * (order - 1))
                context = pa.BinaryArray.from_buffers(pa.binary(), len(here), [None, pa.py_buffer(bounds), pa.py_buffer(raw)])
                yield gram_batch(names, group[here], order, context, ids[here], total)

    return run


# Small batches are joined to so many tokens before their n-grams are packed, and so many n-grams are summed at a time.
PACKED_TOKENS = 1 << 21
SUMMED_NGRAMS = 1 << 17
# Single ids have no context to be dealt by.
NO_BUCKET = -1
ZSTD = "zstd"


def scrambled(numbers: np.ndarray) -> np.ndarray:
    numbers = (numbers ^ numbers >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return numbers ^ numbers >> np.uint64(32)


def hashed(columns: list[np.ndarray]) -> np.ndarray:
    """A 64-bit hash of each row."""
    total = np.zeros(len(columns[0]), np.uint64)
    for column in columns:
        total = scrambled(total + column + np.uint64(0x9E3779B97F4A7C15))
    return total


def changes(columns: list[np.ndarray]) -> np.ndarray:
    """Rows that differ from the one before, the first among them."""
    fresh = np.zeros(len(columns[0]), bool)
    fresh[:1] = True
    for column in columns:
        fresh[1:] |= column[1:] != column[:-1]
    return fresh


def ranks(numbers: np.ndarray) -> np.ndarray:
    """Numbers in the order of the given ones, from 0 on and without gaps."""
    order = np.argsort(numbers)
    out = np.empty(len(order), np.uint64)
    out[order] = np.cumsum(changes([numbers[order]])) - 1
    return out


def most_bits(numbers: np.ndarray) -> int:
    return int(numbers.max(initial=0)).bit_length()


def wider(number: np.ndarray, bits: int, column: np.ndarray) -> tuple[np.ndarray, int]:
    """Numbers of ``bits`` bits with a column added below; the numbers are given anew where that takes more than 64 bits."""
    more = most_bits(column)
    if bits + more > 64:
        number = ranks(number)
        bits = most_bits(number)
    return number << np.uint64(more) | column.astype(np.uint64), bits + more


def written_numbers(numbers: np.ndarray) -> bytes:
    """Numbers from 0 on in as few bytes as they need."""
    return numbers.astype(np.min_scalar_type(int(numbers.max(initial=0)))).tobytes()


def read_numbers(raw: bytes, count: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{len(raw) // count}")


def joined_batches(batches, limit: int):
    """Batches, small ones joined to about ``limit`` bytes."""
    held, size = [], 0
    for batch in batches:
        if held and size + batch.nbytes > limit:
            joined, held, size = pa.concat_batches(held), [], 0
            yield joined
        held.append(batch)
        size += batch.nbytes
    if held:
        yield pa.concat_batches(held)


def distinct(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers that occur, and the place among them of each given one."""
    most = int(numbers.max(initial=0)) + 1
    if most > len(numbers):
        found, place = np.unique(numbers, return_inverse=True)
        return found, place.astype(np.uint32)
    seen = np.zeros(most, bool)
    seen[numbers] = True
    return np.flatnonzero(seen), (np.cumsum(seen, dtype=np.uint32) - np.uint32(1))[numbers]


def squeezed(columns: list[np.ndarray]) -> tuple[int, bytes]:
    """The bytes a number has, and the columns: the first bytes of a column's numbers, then the second ones and so on, compressed."""
    width = next(w for w in (2, 4, 8) if max(map(most_bits, columns)) <= 8 * w)
    planes = [(column >> column.dtype.type(8 * i)).astype(np.uint8) for column in columns for i in range(min(width, column.itemsize))]
    return width, pa.Codec(ZSTD).compress(np.concatenate(planes), asbytes=True)


def unsqueezed(raw: bytes, width: int, sizes: list[int]) -> list[np.ndarray]:
    planes, at, columns = np.frombuffer(pa.Codec(ZSTD).decompress(raw, width * sum(sizes), asbytes=True), np.uint8), 0, []
    for size in sizes:
        columns.append(planes[at : at + size].astype(f"u{width}"))
        for i in range(1, width):
            columns[-1] |= planes[at + i * size : at + (i + 1) * size].astype(f"u{width}") << np.uint8(8 * i)
        at += width * size
    return columns


def packed_block(columns: list[np.ndarray], low: int) -> tuple[int, int, int, bytes]:
    """Rows of numbers, equal ones counted, as (rows, contexts, width, block). The first ``low`` columns are the context.

    A context is written once and in order, its first number as the step from the last one's.
    """
    number, bits = np.zeros(len(columns[0]), np.uint64), 0
    for column in columns[:low]:
        number, bits = wider(number, bits, column)
    if bits > 48:
        number = ranks(number)
    # Equal rows of a context stand side by side, but for some of equal hash.
    room = np.uint64(64 - max(1, most_bits(number)))
    order = np.argsort(number << room | hashed(columns[low:]) >> np.uint64(64) - room)
    number, columns = number[order], [column[order] for column in columns]
    starts = np.flatnonzero(changes([number, *columns[low:]]))
    heads = np.flatnonzero(changes([number[starts]]))
    first, *others = [column[starts[heads]] for column in columns[:low]]
    sizes, total = np.diff(np.r_[heads, len(starts)]), np.diff(np.r_[starts, len(order)])
    steps = np.diff(first, prepend=first.dtype.type(0))
    return len(starts), len(heads), *squeezed([steps, *others, sizes, *(column[starts] for column in columns[low:]), total])


def unpacked_block(size: int, contexts: int, width: int, block: bytes, low: int, columns: int) -> list[np.ndarray]:
    """The rows of a block, column by column, and their totals."""
    steps, *found = unsqueezed(block, width, [contexts] * (low + 1) + [size] * (columns - low + 1))
    found.insert(0, np.cumsum(steps, dtype=np.uint32))
    return [*(np.repeat(column, found[low]) for column in found[:low]), *found[low + 1 :]]


def ngram_packer(orders: tuple[int, ...], table: np.ndarray, buckets: int):
    """(key, tokens) batches -> partial counts as rows (bucket, keys, size, contexts, width, block).

    An n-gram of the highest order is written once for all orders above 1: the ids of its context, newest first, the id that
    follows, the number of its key, and how often it occurs. Ids are one higher than they are, and 0 stands for those before the
    beginning of a row. The bucket is a hash of the lowest order's context, so n-grams that share a context meet, whatever their order.
    Single ids are summed over many slices.
    """
    wide = [order for order in orders if order > 1]

    def rows(found: list[tuple], names: pa.Array) -> pa.RecordBatch:
        bucket, used, size, contexts, width, block = zip(*found)
        bounds = np.cumsum([0, *map(len, used)]).astype(np.int32)
        keys = pa.ListArray.from_arrays(pa.array(bounds), names.take(pa.array(np.concatenate(used))))
        numbers = [pa.array(x, pa.int32()) for x in (bucket, size, contexts, width)]
        columns = [numbers[0], keys, *numbers[1:], pa.array(block, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["bucket", "keys", "size", "contexts", "width", "block"])

    def contexts(group: np.ndarray, offsets: np.ndarray, ids: np.ndarray):
        low, high = min(wide), max(wide)
        starts, sizes = offsets[:-1], np.diff(offsets)
        place = np.full(len(ids), high, np.min_scalar_type(high))
        for i in range(high):
            place[starts[sizes > i] + i] = i
        padded = np.zeros(high - 1 + len(ids), np.uint16 if int(ids.max()) < 65535 else np.uint32)
        padded[high - 1 :] = ids
        padded[high - 1 :] += 1
        # The places of a span sorted by bucket, and where each bucket ends there.
        sorted_spans = []
        for a, b in spans(len(ids)):
            bucket = hashed([padded[high - 1 - back + a : high - 1 - back + b] for back in range(1, low)]) % np.uint64(buckets)
            bucket[place[a:b] < low - 1] = buckets
            order = np.argsort(bucket.astype(np.uint16 if buckets < 1 << 16 else np.uint32), kind="stable")
            ends = np.cumsum(np.r_[0, np.bincount(bucket.astype(np.int64), minlength=buckets + 1)[:buckets]])
            sorted_spans.append((order.astype(np.int32) + np.int32(a), ends))
        for number in np.flatnonzero(sum(np.diff(ends) for _, ends in sorted_spans)).tolist():
            at = np.concatenate([order[ends[number] : ends[number + 1]] for order, ends in sorted_spans]).astype(np.int64)
            columns, begun = [padded[at + (high - 1 - back)] for back in [*range(1, high), 0]], place[at]
            if begun.min() < high - 1:
                for back in range(low, high):
                    columns[back - 1][begun < back] = 0
            used, key = distinct(group[at])
            yield number, used, *packed_block([*columns, key], low - 1)

    def singles(sums: dict, kind: pa.DataType) -> pa.RecordBatch:
        ids, total = (np.concatenate(x) for x in zip(*sums.values()))
        key = np.repeat(np.arange(len(sums)), [len(x[0]) for x in sums.values()])
        return rows([(NO_BUCKET, np.arange(len(sums)), len(ids), 0, *squeezed([ids, key, total]))], pa.array(list(sums), kind))

    def run(batches):
        sums, kind = {}, None
        for names, group, offsets, ids in token_rows(joined_batches(batches, 4 * PACKED_TOKENS), table, PACKED_TOKENS):
            group = np.repeat(group.astype(np.min_scalar_type(len(names))), np.diff(offsets))
            for low, high in spans(len(ids) if 1 in orders else 0):
                kind = names.type
                (g, some), total = counted([group[low:high], ids[low:high].astype(np.int64)], [len(names), 1 << 32])
                add_singles(sums, names.to_pylist(), g, some, total)
            if sum(len(x[0]) for x in sums.values()) > PACKED_TOKENS:
                yield singles(sums, kind)
                sums = {}
            found = contexts(group, offsets, ids) if wide and len(ids) else iter(())
            while some := list(itertools.islice(found, 64)):
                yield rows(some, names)
        if sums:
            yield singles(sums, kind)

    return run


def add_singles(sums: dict, keys: list, group: np.ndarray, ids: np.ndarray, total: np.ndarray) -> None:
    """Add counts of ids to those kept by key as (ids, totals); groups, the places of their keys, are sorted."""
    at = np.flatnonzero(changes([group])).tolist()
    for first, last in zip(at, [*at[1:], len(group)]):
        key = keys[group[first]]
        seen = sums.get(key, (np.empty(0, np.int64),) * 2)
        (some,), n = summed([np.r_[seen[0], ids[first:last].astype(np.int64)]], np.r_[seen[1], total[first:last].astype(np.int64)])
        sums[key] = some, n


def whole_buckets(batches):
    """Batches sorted by bucket -> batches with all rows of each bucket, of about ``SUMMED_NGRAMS`` n-grams or more."""
    held, total = [], 0
    for batch in batches:
        sizes = np.concatenate([[0], np.cumsum(batch.column(2).to_numpy())])
        for low, high in row_slices(sizes, SUMMED_NGRAMS):
            some, bucket = batch[low:high], batch.column(0).to_numpy()[low:high]
            # Rows of the last bucket may go on in the next batch.
            last = int(np.searchsorted(bucket, bucket[-1]))
            ended = last or held and held[-1].column(0)[-1].as_py() != bucket[-1]
            if ended and total + sizes[low + last] - sizes[low] > SUMMED_NGRAMS:
                yield pa.concat_batches([*held, some[:last]])
                held, total, some, low = [], 0, some[last:], low + last
            held.append(some)
            total += sizes[high] - sizes[low]
    if held:
        yield pa.concat_batches(held)


def ngram_summer(orders: tuple[int, ...]):
    """Rows of ``ngram_packer``, sorted by bucket -> packed counts, the n-grams of a context in one row.

    A row has n-grams sorted by context, next id and key; their ids stand column after column, oldest first.
    """
    wide = sorted(order for order in orders if order > 1)

    def counts(keys: pa.Array, number: np.ndarray, bits: int, ids: list[np.ndarray], key: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
        """``number`` tells the contexts apart."""
        number, bits = wider(number, bits, ids[-1])
        number, bits = wider(number, bits, key)
        order = np.argsort(number)
        starts = np.flatnonzero(changes([number[order]]))
        first, total = order[starts], np.add.reduceat(total[order].astype(np.int64), starts)
        values = [written_numbers(x) for x in (np.concatenate([x[first] for x in ids]), key[first], total)]
        columns = [pa.array([len(ids)], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys), pa.array([len(total)], pa.int32())]
        return pa.RecordBatch.from_arrays([*columns, *(pa.array([x], pa.binary()) for x in values)], names=["gram", "keys", "size", "ids", "key_no", "n"])

    def contexts(keys: pa.Array, columns: list[np.ndarray]):
        number, bits, done = np.zeros(len(columns[0]), np.uint64), 0, 0
        for order in wide:
            whole = columns[order - 2] > 0
            if not whole.all():
                number, columns = number[whole], [x[whole] for x in columns]
            if not len(number):
                return
            for column in columns[done : order - 1]:
                number, bits = wider(number, bits, column)
            number, done = ranks(number), order - 1
            bits = most_bits(number)
            ids = [x - x.dtype.type(1) for x in [*columns[order - 2 :: -1], columns[-3]]]
            yield counts(keys, number, bits, ids, *columns[-2:])

    def blocks(batch: pa.RecordBatch):
        """The keys of some rows, and the columns of all their blocks."""
        numbers, found = {}, []
        for row in batch.to_pylist():
            found.append(unpacked_block(*(row[x] for x in ("size", "contexts", "width", "block")), wide[0] - 1, wide[-1] + 1))
            found[-1][-2] = np.array([numbers.setdefault(key, len(numbers)) for key in row["keys"]], np.uint32)[found[-1][-2]]
        columns = [np.concatenate(x) for x in zip(*found)]
        return pa.array(list(numbers), batch.schema.field("keys").type.value_type), columns

    def run(batches):
        sums, kind = {}, []

        def others():
            for batch in batches:
                n = int(np.searchsorted(batch.column(0).to_numpy(), NO_BUCKET, "right"))
                for row in batch[:n].to_pylist():
                    ids, key, total = unsqueezed(row["block"], row["width"], [row["size"]] * 3)
                    add_singles(sums, row["keys"], key, ids, total)
                kind.append(batch.schema.field("keys").type.value_type)
                yield batch[n:]

        for batch in whole_buckets(others()):
            keys, columns = blocks(batch)
            parts = -(-len(columns[0]) // (2 * SUMMED_NGRAMS))
            part = (hashed(columns[: wide[0] - 1]) >> np.uint64(32)) % np.uint64(parts) if parts > 1 else None
            for i in range(parts):
                yield from contexts(keys, columns if part is None else [x[part == i] for x in columns])
        if sums:
            ids, total = (np.concatenate(x) for x in zip(*sums.values()))
            key = np.repeat(np.arange(len(sums)), [len(x[0]) for x in sums.values()])
            yield counts(pa.array(list(sums), kind[0]), np.zeros(len(ids), np.uint64), 0, [ids], key, total)

    return run


def count_losses(n_ids: int, k: float):
    """Packed counts with the keys ``train`` and ``test`` -> (gram, n_pairs, loss): the test side's pairs and their summed loss, add-k smoothed."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                size, order = row["size"], row["gram"]
                ids = read_numbers(row["ids"], size * order).reshape(order, size)
                key, total = read_numbers(row["key_no"], size), read_numbers(row["n"], size).astype(np.int64)
                train, test = (np.where(np.array([x == side for x in row["keys"]])[key], total, 0) for side in ("train", "test"))
                context = changes([np.zeros(size, bool), *ids[:-1]])
                starts = np.flatnonzero(context | changes([ids[-1]]))
                held, seen = np.add.reduceat(test, starts), np.add.reduceat(train, starts)
                whole = np.add.reduceat(train, np.flatnonzero(context))[np.cumsum(context)[starts] - 1]
                some = held > 0
                held, p = held[some], (seen[some] + k) / (whole[some] + k * n_ids)
                sums = [pa.array([order], pa.int32()), pa.array([int(held.sum())], pa.int64()), pa.array([float(-(held * np.log(p)).sum())], pa.float64())]
                yield pa.RecordBatch.from_arrays(sums, names=["gram", "n_pairs", "loss"])

    return run


def segments(edges: np.ndarray, widths: np.ndarray, inner: int):
    """order value -> number of its range, each of the ranges that begin at ``edges`` cut into ``inner`` equal widths."""

    def run(values: pa.Array) -> pa.Array:
        v = pc.fill_null(values, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.searchsorted(edges, v, "right") - 1
        segment = at * inner + (v - edges[at]) // widths[at]
        return pa.array(np.where(values.is_null().to_numpy(zero_copy_only=False), -1, segment))

    return run
