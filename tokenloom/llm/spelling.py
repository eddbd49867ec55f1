"""Spelling variants: words one edit apart, each led to its commonest form.

Two words one inserted, deleted or replaced letter apart have letter counts at a squared distance of at most 2 and lengths
that differ by at most 1. The reverse need not hold, so such pairs are candidates and their edits are verified.

Which words meet: the letters are dealt into parts of about equal weight. An edit touches the counts of one part or two, so
two near words agree in the counts of all other parts. A word goes into one block for each choice of two open parts, named
by its counts in the others; every near pair shares a block. Inside a block, words lie by length, and NumPy products of the
letter-count matrices of equal and adjacent lengths (Gram matrices) give all squared distances at once. A pair that meets
in several blocks counts in one of them only, which the parts it differs in decide.

The more words there are, the more parts are made (``parts_for``), which keeps blocks about as large; the result is the
same for any number. A block of more than ``PORTION`` words is cut into portions, and every two portions are compared in
a group of their own, so no task holds more than two portions.

Edge cases: a null or empty text has no words; a word far longer than others is a word like any; repeated rows count each; a
null id counts as an empty one; extra columns are ignored; without words the result has no rows. Letters whose code
points are equal modulo ``COLUMNS`` share a column, which makes more candidates and loses none.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import U64, mix, ragged, stored

LETTERS = 7
COUNT = 2
RATIO = 10
COLUMNS = 191
PORTION = 2048
CELLS = 1 << 20
ROWS = 40_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCKS = "block long, word string, n long"
LINKS = "word string, near string, near_n long"


def runs(docs: DataFrame, key: str = "doc_id", text: str = "text", letters: int = LETTERS) -> DataFrame:
    """doc_id and run: the maximal runs of at least ``letters`` letters in whole texts, A-Z in lower case."""
    low = F.translate(F.col(text), UPPER, LOWER)
    found = F.regexp_extract_all(low, F.lit(f"[a-zÀ-ÿ]{{{letters},}}"), F.lit(0))
    return docs.select(F.col(key).alias("doc_id"), F.explode(found).alias("run"))


def counts(words: Column, rows: DataFrame, letters: int = LETTERS, least: int = COUNT) -> DataFrame:
    """word and n of the words of ``rows`` that are long and frequent enough."""
    found = rows.select(words.alias("word")).where(F.char_length("word") >= letters)
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def parts_for(words: int) -> int:
    """Number of parts of the alphabet for a number of words: one more for each four times as many."""
    return int(np.clip(4 + np.floor(np.log(max(words, 1) / 150_000) / np.log(4)), 4, 9))


def letter_codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words side by side, and the length of each word."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64), sizes


def letter_counts(codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    row = np.repeat(np.arange(len(sizes)), sizes)
    return np.bincount(row * COLUMNS + codes % COLUMNS, minlength=len(sizes) * COLUMNS).reshape(-1, COLUMNS)


def deal_letters(weights: np.ndarray, parts: int) -> np.ndarray:
    """The part of each column: heaviest first, each to the part that is lightest so far."""
    load, part = np.zeros(parts), np.zeros(COLUMNS, np.int64)
    for column in np.argsort(-weights, kind="stable"):
        part[column] = load.argmin()
        load[part[column]] += weights[column] + 1e-9
    return part


def _letter_weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each column: words, sum and sum of squares of its counts; one row for each column and task."""
    total = np.zeros((3, COLUMNS), np.int64)
    for batch in batches:
        table = letter_counts(*letter_codes(batch.column(0).to_pylist()))
        total += np.stack([np.full(COLUMNS, len(table)), table.sum(0), (table**2).sum(0)])
    yield pa.record_batch([pa.array(np.arange(COLUMNS, dtype=np.int32)), *(pa.array(x) for x in total)], ["letter", "rows", "sum", "squares"])


def _blocks(part: np.ndarray, parts: int):
    open_parts = list(itertools.combinations(range(parts), 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = mix(np.arange(COLUMNS, dtype=U64), 71)
        for batch in batches:
            table = letter_counts(*letter_codes(batch.column(0).to_pylist())).astype(U64)
            with np.errstate(over="ignore"):
                by_part = np.stack([table[:, part == p] @ weight[part == p] for p in range(parts)])
                whole = by_part.sum(0)
                keys = [mix(whole - by_part[p] - by_part[q], 100 + k) for k, (p, q) in enumerate(open_parts)]
            for k, key in enumerate(keys):
                # The last byte tells which parts are open.
                key = (key & ~U64(255)) | U64(k)
                yield pa.record_batch([pa.array(key.view(np.int64)), batch.column(0), batch.column(1)], ["block", "word", "n"])

    return run


def _products(order_by: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Start and size of both sides of every product; rows are sorted by (block, length)."""
    block, length = order_by
    new = np.flatnonzero(np.r_[True, (block[1:] != block[:-1]) | (length[1:] != length[:-1])])
    size = np.diff(np.r_[new, len(block)])
    own = np.flatnonzero(size > 1)
    after = np.flatnonzero((block[new[1:]] == block[new[:-1]]) & (length[new[1:]] == length[new[:-1]] + 1))
    left, right = np.r_[own, after], np.r_[own, after + 1]
    return new[left], size[left], new[right], size[right]


def near_counts(table: np.ndarray, block: np.ndarray, length: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one block and adjacent lengths whose letter counts are at a squared distance of ``least`` to 2.

    Products of nearly the same size are padded to one and multiplied together, about ``CELLS`` cells at a time.
    """
    a_from, a_size, b_from, b_size = _products([block, length])
    table = table.astype(np.float64)
    square = (table**2).sum(1)
    # Sums below 2^24 are exact in single precision; above 2^53, a bound on the rounding errors is allowed for.
    loose = 0.0 if square.max(initial=0) < 2**50 else float(square.max()) * 2.0**-48
    if square.max(initial=0) < 2**22:
        table, square = table.astype(np.float32), square.astype(np.float32)
    padded = lambda n: 1 << np.ceil(np.log2(n)).astype(np.int64)
    shapes = padded(np.maximum(a_size, 1)) << 32 | padded(np.maximum(b_size, 1))
    for shape in np.unique(shapes):
        same = np.flatnonzero(shapes == shape)
        p, q = int(shape >> 32), int(shape & 0xFFFFFFFF)
        step = max(1, CELLS // (p * q + (p + q) * table.shape[1]))
        for low in range(0, len(same), step):
            at = same[low : low + step]
            i, j = a_from[at][:, None] + np.arange(p), b_from[at][:, None] + np.arange(q)
            fits_i, fits_j = np.arange(p) < a_size[at][:, None], np.arange(q) < b_size[at][:, None]
            i, j = np.where(fits_i, i, 0), np.where(fits_j, j, 0)
            # Rows that only fill up are at no small distance from any.
            distance = table[i] @ table[j].transpose(0, 2, 1)
            distance *= -2
            distance += np.where(fits_i, square[i], np.inf)[:, :, None]
            distance += np.where(fits_j, square[j], np.inf)[:, None, :]
            hit = distance <= 2 + loose
            which, x, y = np.nonzero(hit)
            hit = (distance[which, x, y] >= least - loose) & (i[which, x] < j[which, y])
            yield i[which, x][hit], j[which, y][hit]


def one_edit(codes: np.ndarray, start: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words a and b, of which b is no shorter and at most one longer, differ by exactly one edit."""
    out = np.zeros(len(a), bool)
    order = np.argsort(size[b], kind="stable")
    low = 0
    while low < len(order):
        width = int(size[b[order[low]]])
        # The words are padded to the longest of the portion; one pair is always taken.
        high = int(np.searchsorted(size[b[order]], 2 * width, "right"))
        high = min(high, low + max(1, CELLS // max(1, 2 * width)))
        some = order[low:high]
        x, y = a[some], b[some]
        wide = int(size[y].max(initial=1))
        place = np.arange(wide)
        grid = lambda w, shift: np.where(place + shift < size[w][:, None], codes[np.minimum(start[w][:, None] + place + shift, len(codes) - 1)], -1)
        short, long, shifted = grid(x, 0), grid(y, 0), grid(y, 1)
        differs = short != long
        first = np.where(differs.any(1), differs.argmax(1), wide)
        replaced = (size[x] == size[y]) & (differs.sum(1) == 1)
        rest = ((short == shifted) | (place < first[:, None])).all(1)
        out[some] = replaced | ((size[x] + 1 == size[y]) & rest)
        low = high
    return out


def _links(part: np.ndarray, parts: int):
    open_parts = np.array(list(itertools.combinations(range(parts), 2)))
    weight = mix(np.arange(COLUMNS, dtype=U64), 73).view(np.int64)

    def compare(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = rows.combine_chunks()
        words, n = (rows[c].combine_chunks() for c in ("word", "n"))
        codes, sizes = letter_codes(words.to_pylist())
        starts = np.cumsum(sizes) - sizes
        used, column = np.unique(codes % COLUMNS, return_inverse=True)
        cells = np.repeat(np.arange(len(sizes)), sizes) * len(used) + column
        table = np.bincount(cells, minlength=len(sizes) * len(used)).reshape(len(sizes), len(used)).astype(np.int32)
        own_part = part[used]
        block, first, second, own = (rows[c].to_numpy() for c in ("block", "first", "second", "own"))
        group = np.cumsum(np.r_[True, (block[1:] != block[:-1]) | (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
        order = np.lexsort((sizes, group))
        least = 0 if len(codes) and codes.max() > 255 else 1
        # One column for each part, in which the counts of two words are the same or not.
        marks = np.stack([table[:, own_part == p].astype(np.int64) @ weight[used][own_part == p] for p in range(parts)], 1)
        for i, j in near_counts(table[order], group[order], sizes[order], least):
            i, j = order[i], order[j]
            # Of two portions, only pairs across them; of the blocks a pair meets in, the first that opens all it differs in.
            some = (first[i] == second[i]) | (own[i] != own[j])
            i, j = i[some], j[some]
            by_part = marks[i] != marks[j]
            number = by_part.sum(1)
            open_ = open_parts[(block[i] & 255).astype(np.int64)]
            held = number == np.take_along_axis(by_part, open_, 1).sum(1)
            lowest = np.where(number == 0, (open_ == [0, 1]).all(1), np.where(by_part[:, 0], open_[:, 1] == 1, open_[:, 0] == 0))
            mine = held & ((number == 2) | lowest)
            i, j = i[mine], j[mine]
            i, j = np.where(sizes[i] <= sizes[j], i, j), np.where(sizes[i] <= sizes[j], j, i)
            good = one_edit(codes, starts, sizes, i, j)
            i, j = pa.array(np.r_[i[good], j[good]]), pa.array(np.r_[j[good], i[good]])
            yield pa.record_batch([words.take(i), words.take(j), n.take(j)], ["word", "near", "near_n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new])
            if held.num_rows < ROWS:
                continue
            # Rows are sorted by block: the last group may go on in the next batch.
            ends = [held[c].to_numpy() for c in ("block", "first", "second")]
            last = np.logical_and.reduce([x == x[-1] for x in ends])
            cut = len(last) - int(np.argmin(last[::-1])) if not last.all() else 0
            if cut:
                yield from compare(held.slice(0, cut))
                held = held.slice(cut).combine_chunks()
        if held is not None:
            yield from compare(held)

    return run


def links(words: DataFrame, parts: int | None = None) -> DataFrame:
    """word, near and near_n of every two words of the table (word, n) that are one edit apart, both ways round.

    The table is read several times, so pass a written one.
    """
    # COLUMNS rows, whatever the table holds.
    weights = (
        words.select("word").mapInArrow(_letter_weights, "letter int, rows long, sum long, squares long")
        .groupBy("letter").agg(*[F.sum(c).alias(c) for c in ("rows", "sum", "squares")]).orderBy("letter").collect()
    )
    number = weights[0]["rows"] if weights else 0
    spread = np.zeros(COLUMNS)
    for r in weights:
        spread[r["letter"]] = r["squares"] / max(number, 1) - (r["sum"] / max(number, 1)) ** 2
    parts = parts or parts_for(number)
    part = deal_letters(spread, parts)
    dealt = words.select("word", "n").mapInArrow(_blocks(part, parts), BLOCKS)
    sizes = dealt.groupBy("block").agg(F.count(F.lit(1)).alias("many")).where("many > 1")
    portions = F.ceil(F.col("many") / PORTION).cast("int")
    named = dealt.join(sizes, "block").select("block", "word", "n", F.pmod(F.xxhash64("word"), portions).cast("int").alias("own"), portions.alias("portions"))
    other = F.explode(F.sequence(F.lit(0), F.col("portions") - 1))
    met = named.select("block", "word", "n", "own", other.alias("other")).select(
        "block", F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"), "own", "word", "n"
    )
    keys = ["block", "first", "second"]
    return met.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_links(part, parts), LINKS)


def roots(forms: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word and root of a table (word, form, n of the form): forms are followed to the last by doubling.

    A form is at least ``ratio`` times as frequent as its word, so a chain is no longer than the logarithm of the largest n.
    """
    most = forms.agg(F.max("n")).first()[0]
    steps = forms.select("word", F.col("form").alias("root"))
    if most is None:
        return steps
    length = max(1, int(np.ceil(np.log(float(most)) / np.log(ratio))))
    for _ in range(int(np.ceil(np.log2(length))) + 1):
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = stored(steps.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root")))
    return steps


def group(counted: DataFrame, ratio: int = RATIO, parts: int | None = None) -> DataFrame:
    """word, form, root, n, n_near and form_n of every row of a table (word, n); ``ratio`` is 2 at least."""
    words = stored(counted)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    near = links(words, parts).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    led = -F.col("best.less") >= ratio * F.col("n")
    named = stored(
        words.join(near, "word", "left").select(
            "word",
            F.when(led, F.col("best.form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(led, -F.col("best.less")).alias("form_n"),
        )
    )
    ends = roots(named.where("form is not null").select("word", "form", F.col("form_n").alias("n")), ratio)
    return named.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
