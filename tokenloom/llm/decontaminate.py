"""Passages of benchmark items in documents, found by the CGK embedding and bit sampling, confirmed by edit distance.

Symbols are words without the case of A-Z, the distance is the number of words inserted, deleted or replaced, and a window
is as long as the item it is compared with. The CGK embedding walks over a string: at step j it writes the current symbol
and goes on to the next one if a random bit of (j, symbol) says so. One walk over strings at a small edit distance writes
strings at a small Hamming distance, so a few sampled steps of the walk are equal with good probability. Every repetition
has its own random bits and its own sampled steps; ``REPETITIONS`` of ``SAMPLES`` steps reach a recall above 0.9 for
windows at the limit, and nearly 1 for closer ones. Windows that agree with an item in all samples of some repetition are
compared exactly: one with distance of at most ``percent`` of the item's words is reported.

Walks drift apart with every edit, so a repetition walks over ``SPAN`` words of the window only: a third of the
repetitions over its first ones, the others over spans elsewhere, whose place and samples depend on the item's length class
only. So recall does not fall with the length (measured in the tests for 5 to 1,000 words).
Items below ``SHORT`` words are found exactly: where at most one edit is allowed, the first or the last half of
the item's words stands unchanged in the window, the last one at most a word off.

A window at distance d has at most d words that the item lacks, so windows with more words outside the items' vocabulary are
passed over; this loses nothing.

The items are broadcast in blocks of ``BLOCK_WORDS`` words, so a table of items of any size is searched block by block.
Documents are never shuffled.

Edge cases: a null or empty text has no window; a document shorter than an item is one window; items that are null or
without words are not searched, a short one is found wherever it stands; repeated rows give repeated findings, of
which one row for each document id and item is kept; a null id is a group of its own; extra columns are ignored by
``findings``. Ties go to the earliest window.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import U64, Slice, mix, ragged, slices, words

PERCENT = 20
SHORT = 8
REPETITIONS = 24
SAMPLES = 3
SPAN = 24
CELLS = 1 << 21
BLOCK_WORDS = 200_000
FINDINGS = "doc_id long, item_id long, start_word int, distance int, item_words int"


def size_class(n: int) -> int:
    """Lower bound of an item's length class; classes grow by a quarter, and short items have one each."""
    if n < SHORT:
        return n
    low = SHORT
    while (up := low + max(1, low // 4)) <= n:
        low = up
    return low


@lru_cache(maxsize=1 << 14)
def sample_steps(low: int, repetition: int) -> list[int]:
    """Sampled steps of the walk for a length class: one from each of equal parts of about the time its span lasts."""
    length = min(low, SPAN) * 3 // 2
    draw = np.random.default_rng([low, repetition, 77])
    edges = np.linspace(0, length, SAMPLES + 1).astype(int)
    return [int(draw.integers(a, max(b, a + 1))) for a, b in zip(edges, edges[1:])]


@lru_cache(maxsize=1 << 14)
def span_start(low: int, repetition: int) -> int:
    """First word of the span that a repetition walks over."""
    if repetition % 3 == 0 or low <= SPAN:
        return 0
    return int(np.random.default_rng([low, repetition, 78]).integers(0, low - SPAN + 1))


class Text:
    """Symbols with a 0 behind the last one, and the random bits of each for the steps of one walk at a time."""

    def __init__(self, symbols: np.ndarray) -> None:
        self.symbols, self.held, self.bits = np.r_[symbols, U64(0)], (-1, -1), np.zeros(0, np.int64)

    def moves(self, repetition: int, block: int) -> np.ndarray:
        """Bit k of a symbol's number says whether step ``64 * block + k`` goes on from it; none does from the last place."""
        if self.held != (repetition, block):
            self.bits = mix(self.symbols, 9000 + 128 * repetition + block).view(np.int64)
            self.bits[-1], self.held = 0, (repetition, block)
        return self.bits


class Walk:
    """Positions of many walks side by side, over one array of symbols with an end for each walk."""

    def __init__(self, text: Text, at: np.ndarray, end: np.ndarray, repetition: int) -> None:
        self.text, self.at, self.end, self.repetition, self.step = text, np.minimum(at, len(text.symbols) - 1), end, repetition, 0

    def keep(self, which: np.ndarray) -> None:
        self.at, self.end = self.at[which], self.end[which]

    def symbol(self) -> np.ndarray:
        """The symbol written at this step; 0 once the string has ended."""
        out = self.text.symbols.take(self.at)
        out[self.at >= self.end] = 0
        return out

    def go_to(self, step: int) -> None:
        """A walk past its end writes 0 wherever it goes from there."""
        while self.step < step:
            bits = self.text.moves(self.repetition, self.step // 64).take(self.at)
            bits >>= self.step % 64
            bits &= 1
            self.at += bits
            self.step += 1


def signatures(text: Text, at, end, low: int, repetition: int, known: list[np.ndarray] | None = None):
    """Hash of the sampled symbols of each window. With ``known``, windows whose samples so far no item has are left out.

    Returns the hashes, the places of the windows they belong to, and the hashes after each sample.
    """
    walk, place = Walk(text, at, end, repetition), np.arange(len(at))
    code, partial = np.zeros(len(at), U64), []
    for k, step in enumerate(sample_steps(low, repetition)):
        walk.go_to(step)
        with np.errstate(over="ignore"):
            code = mix(code + walk.symbol(), 13 + k)
        partial.append(code)
        if known is not None:
            here = np.searchsorted(known[k], code)
            good = np.flatnonzero(known[k][np.minimum(here, len(known[k]) - 1)] == code)
            code, place = code[good], place[good]
            walk.keep(good)
            if not len(good):
                break
    return code, place, partial


def distances(a: np.ndarray, a_at: np.ndarray, a_size: np.ndarray, b: np.ndarray, b_at: np.ndarray, b_size: np.ndarray) -> np.ndarray:
    """Edit distance of each pair of strings (slices of the symbol arrays a and b), as many side by side as ``CELLS`` allows."""
    out = np.zeros(len(a_at), np.int64)
    order = np.argsort(b_size, kind="stable")
    # From the longest to the shortest, so that a portion's first pair is its widest.
    low = len(order)
    while low:
        high, low = low, max(0, low - max(1, CELLS // (int(b_size[order[low - 1]]) + 1)))
        some = order[low:high]
        out[some] = _distances(a, a_at[some], a_size[some], b, b_at[some], b_size[some])
    return out


def _distances(a: np.ndarray, a_at: np.ndarray, a_size: np.ndarray, b: np.ndarray, b_at: np.ndarray, b_size: np.ndarray) -> np.ndarray:
    wide = int(b_size.max())
    column = np.arange(wide + 1, dtype=np.int32)
    last = np.tile(column, (len(a_at), 1))
    out = np.where(a_size == 0, b_size, 0)
    inside = np.minimum(b_at[:, None] + np.arange(wide), len(b) - 1)
    right = b[inside]
    for i in range(1, int(a_size.max()) + 1):
        symbol = a[np.minimum(a_at + i - 1, len(a) - 1)]
        row = np.empty_like(last)
        row[:, 0] = i
        row[:, 1:] = np.minimum(last[:, 1:] + 1, last[:, :-1] + (right != symbol[:, None]))
        # Insertions run along the row: a running minimum of value minus column.
        row -= column
        np.minimum.accumulate(row, axis=1, out=row)
        row += column
        last = row
        ended = a_size == i
        out[ended] = row[ended, b_size[ended]]
    return out


def gram_codes(symbols: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` symbols from each place on."""
    code = np.zeros(len(at), U64)
    with np.errstate(over="ignore"):
        for k in range(size):
            code = mix(code + symbols[np.minimum(at + k, len(symbols) - 1)], 401)
    return code


class Items:
    """A block of benchmark items: symbols, length classes and the signatures of each repetition."""

    def __init__(self, ids: list, texts: list[str], percent: int) -> None:
        column = pa.array(texts, pa.large_string())
        found = [words(part) for part in slices(column)]
        counts = np.concatenate([w.counts for w in found])
        self.ids, self.symbols, self.size = ids, np.concatenate([w.hash for w in found]), counts
        self.start, self.limit = np.cumsum(counts) - counts, counts * percent // 100
        searched = np.flatnonzero(counts)
        self.vocabulary = np.unique(self.symbols)
        self.classes: dict[int, np.ndarray] = {}
        for i in searched:
            self.classes.setdefault(size_class(int(counts[i])), []).append(i)
        self.classes = {low: np.array(of) for low, of in self.classes.items()}
        self.tables = {}
        self.short = {low: of for low, of in self.classes.items() if low < SHORT}
        self.classes = {low: of for low, of in self.classes.items() if low >= SHORT}
        text = Text(self.symbols)
        for r in range(REPETITIONS):
            for low, of in self.classes.items():
                skip = span_start(low, r)
                code, place, partial = signatures(text, self.start[of] + skip, self.start[of] + self.size[of], low, r)
                order = np.argsort(code, kind="stable")
                self.tables[low, r] = [np.unique(p) for p in partial], code[order], of[order]

    def search(self, part: Slice) -> tuple[np.ndarray, ...] | None:
        """Row, item, first word and distance of every confirmed window of a slice."""
        found = words(part)
        total = len(found.hash)
        if not total or not (self.classes or self.short):
            return None
        here = np.searchsorted(self.vocabulary, found.hash)
        known = self.vocabulary[np.minimum(here, len(self.vocabulary) - 1)] == found.hash
        # Words that no item has, before each place.
        foreign = np.r_[0, np.cumsum(~known)]
        first = np.cumsum(found.counts) - found.counts
        stop = (first + found.counts)[found.row]
        hits = [self.short_hits(found.hash, first[found.row], stop, low, of) for low, of in self.short.items()]
        begin = np.arange(total)
        windows = {}
        for low, of in self.classes.items():
            # A window at distance t has at most t words of its own, in each of its prefixes too, and lacks at most t.
            shortest, longest = int(self.size[of].min()), int(self.size[of].max())
            own = foreign[np.minimum(begin + shortest, stop)] - foreign[:-1]
            at = np.flatnonzero((own <= self.limit[of].max()) & (stop - begin >= (self.size[of] - self.limit[of]).min()))
            if len(at):
                # A window of the class is walked to the document's end or the longest item's; the samples come earlier.
                windows[low] = at, np.minimum(at + longest, stop[at])
        text = Text(found.hash)
        for r in range(REPETITIONS):
            for low, (at, end) in windows.items():
                partial, codes, items = self.tables[low, r]
                code, place, _ = signatures(text, at + span_start(low, r), end, low, r, partial)
                if len(code):
                    left, right = np.searchsorted(codes, code, "left"), np.searchsorted(codes, code, "right")
                    many = right - left
                    hits.append(np.stack([np.repeat(at[place], many), items[np.repeat(left, many) + ragged(many)]], axis=1))
        pairs = np.unique(np.concatenate(hits), axis=0) if hits else np.zeros((0, 2), np.int64)
        if not len(pairs):
            return None
        at, item = pairs[:, 0], pairs[:, 1]
        size = np.minimum(self.size[item], stop[at] - at)
        near = foreign[at + size] - foreign[at] <= self.limit[item]
        at, item, size = at[near], item[near], size[near]
        far = distances(self.symbols, self.start[item], self.size[item], found.hash, at, size)
        good = far <= self.limit[item]
        at, item, far = at[good], item[good], far[good]
        return found.row[at], item, at - first[found.row[at]], far

    def short_hits(self, symbols: np.ndarray, begin: np.ndarray, stop: np.ndarray, n: int, of: np.ndarray) -> np.ndarray:
        """Pairs (first word of a window, item) that may be at distance 0, or 1 where the limit allows it; none is missed.

        A window that its document cuts short lacks words, so half of the item's words stand in it as well.
        """
        head, hits = (n if not self.limit[of].any() else (n + 1) // 2), [np.zeros((0, 2), np.int64)]
        for skip, size, shifts in ((0, head, (0,)), (head, n - head, (-1, 0, 1))):
            if not size:
                continue
            at = np.flatnonzero(np.arange(len(symbols)) + size <= stop)
            codes = gram_codes(self.symbols, self.start[of] + skip, size)
            order = np.argsort(codes, kind="stable")
            code = gram_codes(symbols, at, size)
            left, right = np.searchsorted(codes[order], code, "left"), np.searchsorted(codes[order], code, "right")
            many = right - left
            place, item = np.repeat(at, many), of[order][np.repeat(left, many) + ragged(many)]
            for shift in shifts:
                start = place - skip + shift
                inside = start >= begin[place]
                hits.append(np.stack([start[inside], item[inside]], axis=1))
        return np.concatenate(hits)


def _search(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for batch in batches:
            for part in slices(batch.column(1)):
                found = items.search(part)
                if found is None or not len(found[0]):
                    continue
                row, item, start, far = found
                # The nearest window of each row and item, the earliest of equals.
                order = np.lexsort((start, far, item, row))
                row, item, start, far = (x[order] for x in (row, item, start, far))
                new = np.r_[True, (row[1:] != row[:-1]) | (item[1:] != item[:-1])]
                row, item, start, far = (x[new] for x in (row, item, start, far))
                yield pa.record_batch(
                    [
                        batch.column(0).take(pa.array(row + part.first)),
                        pa.array([items.ids[i] for i in item], pa.int64()),
                        pa.array(start, pa.int32()),
                        pa.array(far, pa.int32()),
                        pa.array(items.size[item], pa.int32()),
                    ],
                    ["doc_id", "item_id", "start_word", "distance", "item_words"],
                )

    return run


def blocks(benchmark: DataFrame, key: str, text: str, percent: int, block_words: int = BLOCK_WORDS) -> Iterator[Items]:
    """The items in blocks of bounded size, fetched one after the other."""
    rows = benchmark.where(F.col(text).isNotNull()).select(F.col(key).cast("long"), text)
    ids, texts, held = [], [], 0
    for item, body in rows.toLocalIterator():
        ids.append(item)
        texts.append(body)
        held += len(body) // 2 + 1
        if held >= block_words:
            yield Items(ids, texts, percent)
            ids, texts, held = [], [], 0
    if ids:
        yield Items(ids, texts, percent)


def findings(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    percent: int = PERCENT,
) -> DataFrame:
    """One row for each document and item found in it: nearest window, its distance and the item's length in words."""
    spark = docs.sparkSession
    source = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text"))
    out = spark.createDataFrame([], FINDINGS)
    for items in blocks(benchmark, item_key, item_text, percent):
        out = out.union(source.mapInArrow(_search(spark.sparkContext.broadcast(items)), FINDINGS))
    best = F.min(F.struct("distance", "start_word", "item_words")).alias("best")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.start_word", "best.distance", "best.item_words")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The documents in which no item was found, with their own columns."""
    found = findings(docs, benchmark, key, **options).select(F.col("doc_id").alias("__found")).distinct()
    return docs.join(found, docs[key].eqNullSafe(found["__found"]), "left_anti")
