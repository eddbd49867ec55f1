"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A document's set holds the hashes of its distinct word shingles. The sketch is filled in rounds: in round i every element
goes into a hashed bin with a hashed value, a bin keeps the least value of the first round that reached it, and after t
rounds each remaining bin gets a round of its own, so all t coordinates are filled. Two sets agree in a coordinate with
the probability of their similarity, with concentration as for independent samples. 40 bands of 5 coordinates miss a
pair at similarity 0.8 with probability below 2e-7; a pair found is confirmed on the full sets.

Equal sets are one class and only classes are compared, so copies make no pairs. Each class of a shared bucket is first
compared with the bucket's smallest one; that joins most of a large group with few pairs. Where several components are left
in a bucket of at most ``SMALL`` classes, the pairs across them are tried. Larger such
buckets that overlap are one pool of classes; a pool is cut into portions of bounded size and every two portions are
compared side by side in one task, from which only links come out. So a class's set is sent once for each portion of its
pool, not once for each pair or bucket, and no link between different components is lost.
Before sets are sent, a pair must agree in ``AGREE`` of the 200 coordinates' marks of one byte; at similarity 0.8 fewer
agree with probability below 1e-7.

Edge cases: a text that is null or has no word has no shingles and links with nothing; one with fewer words than a shingle
is one shingle; repeated rows belong to one class and each gets its row back; a null id is kept as it is, and a class's
smallest id ignores nulls; extra columns are ignored. Elements are 64-bit hashes. ``keep_one`` knows a row by its id and
its text: unlike texts under one id, or without an id, are documents of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.llm.common import U64, Slice, fold, mix, slices, stored, words
from tokenloom.llm.graph import components

BANDS, BAND_ROWS = 40, 5
COORDINATES = BANDS * BAND_ROWS
AGREE = 125
SMALL = 32
SIEVE = 1 << 25
PORTION_CLASSES, PORTION_ELEMENTS = 1024, 1 << 20
UNSET = U64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(part: Slice, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a slice, sorted within each row, and their number in each row."""
    found = words(part)
    rows = len(part.bounds) - 1
    if not len(found.hash):
        return np.zeros(0, U64), np.zeros(rows, np.int64)
    first = np.cumsum(found.counts) - found.counts
    # A row with fewer words than the width gives one shingle of all of them.
    number = np.where(found.counts >= width, found.counts - width + 1, np.minimum(found.counts, 1))
    row = np.repeat(np.arange(rows), number)
    start = np.repeat(first, number) + np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
    length = np.minimum(width, found.counts[row])
    code = mix(length.astype(U64), 3)
    with np.errstate(over="ignore"):
        for k in range(width):
            some = length > k
            code[some] = mix(code[some] + found.hash[start[some] + k], 5)
    order = np.lexsort((code, row))
    code, row = code[order], row[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (row[1:] != row[:-1])
    return code[new], np.bincount(row[new], minlength=rows)


def sketch(elements: np.ndarray, sizes: np.ndarray, t: int = COORDINATES) -> np.ndarray:
    """Fast similarity sketch of each set; the sets lie side by side in ``elements`` and must not be empty."""
    n = len(sizes)
    out = np.full(n * t, UNSET, U64)
    row = np.repeat(np.arange(n), sizes)
    x, at = elements, row * t
    for i in range(t):
        value = mix(x, 1000 + i)
        place = at + (value % U64(t)).astype(np.int64)
        open_ = out[place] == UNSET
        if open_.any():
            np.minimum.at(out, place[open_], value[open_])
        left = (out.reshape(n, t) == UNSET).any(axis=1)
        if not left.any():
            return out.reshape(n, t)
        keep = left[at // t]
        x, at = x[keep], at[keep]
    grid = out.reshape(n, t)
    for j in np.flatnonzero((grid == UNSET).any(axis=0)):
        needy = grid[:, j] == UNSET
        mine = needy[at // t]
        value, owner = mix(x[mine], 1000 + t + int(j)), at[mine] // t
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        grid[owner[starts], j] = np.minimum.reduceat(value, starts)
    return grid


def band_keys(grid: np.ndarray) -> np.ndarray:
    """One key for each band of each sketch."""
    keys = np.zeros((len(grid), BANDS), U64) + np.arange(BANDS, dtype=U64)
    with np.errstate(over="ignore"):
        for k in range(BAND_ROWS):
            keys = mix(keys + grid[:, k::BAND_ROWS], 7)
    return keys


def _digest(elements: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    starts = np.cumsum(sizes) - sizes
    pair = np.stack([fold(elements, starts, 21), fold(elements, starts, 22)], axis=1)
    return [x.tobytes() for x in pair]


def _sketches(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1)):
                elements, sizes = shingle_sets(part, width)
                full = np.flatnonzero(sizes)
                digests, bands = np.full(len(sizes), None, object), np.full(len(sizes), None, object)
                if len(full):
                    digests[full] = _digest(elements, sizes[full])
                    keys = band_keys(sketch(elements, sizes[full])).view(np.int64)
                    for i, r in enumerate(full):
                        bands[r] = keys[i]
                yield pa.record_batch(
                    [
                        batch.column(0).slice(part.first, len(sizes)),
                        pa.array(sizes, pa.int64()),
                        pa.array(digests.tolist(), pa.binary()),
                        pa.array(bands.tolist(), pa.list_(pa.int64())),
                        batch.column(2).slice(part.first, len(sizes)),
                    ],
                    ["doc_id", "n_shingles", "digest", "bands", "row"],
                )

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(0)):
                elements, sizes = shingle_sets(part, width)
                full = sizes[sizes > 0]
                if len(full):
                    packed = [x.tobytes() for x in np.split(elements, np.cumsum(full)[:-1])]
                    marks = [x.tobytes() for x in sketch(elements, full).astype(np.uint8)]
                    columns = [pa.array(x, pa.binary()) for x in (_digest(elements, full), packed, marks)]
                    yield pa.record_batch(columns, ["digest", "elements", "marks"])

    return run


def _agreeing(percent: int):
    """Pairs whose marks agree often enough for the similarity asked for."""
    least = AGREE * percent // 80

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, COORDINATES) for k in (2, 3))
                keep = pa.array((x == y).sum(axis=1) >= least)
                yield pa.record_batch([batch.column(0), batch.column(1)], ["a", "b"]).filter(keep)

    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for left, right in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(left.as_buffer(), U64), np.frombuffer(right.as_buffer(), U64)
                both = np.concatenate([x, y])
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                good.append(100 * shared >= percent * (len(both) - shared))
            keep = pa.array(good, pa.bool_())
            yield pa.record_batch([batch.column(0), batch.column(1)], ["a", "b"]).filter(keep)

    return run


def _block(percent: int):
    """Links between the components of one block, a group of at most two portions of a pool."""

    def run(group: pa.Table) -> pa.Table:
        names = group["digest"].to_pylist()
        portion = group["own"].to_numpy()
        label = np.unique(np.array([x.hex() for x in group["label"].to_pylist()]), return_inverse=True)[1]
        sets = [np.frombuffer(x, U64) for x in group["elements"].to_pylist()]
        sizes = np.array([len(x) for x in sets])
        element, at = np.unique(np.concatenate(sets), return_inverse=True)
        row = np.repeat(np.arange(len(sets)), sizes)
        shared = np.bincount(at)[at] > 1
        column, at = np.unique(at[shared], return_inverse=True)
        found: list[tuple[bytes, bytes]] = []
        if len(column) and label.min() < label.max():
            left, right = np.flatnonzero(portion == portion.min()), np.flatnonzero(portion == portion.max())
            common = np.zeros((len(left), len(right)), np.float32)
            for low in range(0, len(column), 4096):
                grid = np.zeros((len(sets), 4096), np.float32)
                inside = (at >= low) & (at < low + 4096)
                grid[row[shared][inside], at[inside] - low] = 1
                common += grid[left] @ grid[right].T
            union = sizes[left][:, None] + sizes[right][None, :] - common
            good = (100 * common >= percent * union) & (label[left][:, None] != label[right][None, :])
            found = [(names[left[i]], names[right[j]]) for i, j in zip(*np.nonzero(good))]
        return pa.table([pa.array([x[k] for x in found], pa.binary()) for k in (0, 1)], names=["a", "b"])

    return run


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left, right = (sets.select(F.col("digest").alias(k), F.col("marks").alias(m)) for k, m in (("a", "x"), ("b", "y")))
    marked = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    likely = stored(marked.mapInArrow(_agreeing(percent), "a binary, b binary"))
    left, right = (sets.select(F.col("digest").alias(k), F.col("elements").alias(e)) for k, e in (("a", "x"), ("b", "y")))
    return likely.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(_confirm(percent), "a binary, b binary")


def _open(members: DataFrame, parts: DataFrame) -> DataFrame:
    """Members of the buckets that still hold several components, and the component of each."""
    labelled = members.join(parts, members["digest"] == parts["node"], "left").select(
        "band", "many", "pivot", "digest", "n", F.coalesce("component", "digest").alias("label")
    )
    mixed = labelled.groupBy("band").agg((F.min("label") < F.max("label")).alias("mixed")).where("mixed").select("band")
    return stored(labelled.join(mixed, "band"))


def _across(small: DataFrame, percent: int) -> DataFrame:
    """Pairs across the components of buckets of at most ``SMALL`` classes."""
    x, y = small.alias("x"), small.alias("y")
    pairs = x.join(
        y,
        (F.col("x.band") == F.col("y.band"))
        & (F.col("x.digest") < F.col("y.digest"))
        & (F.col("x.label") != F.col("y.label"))
        # The intersection is no larger than the smaller set, the union no smaller than the larger one.
        & (100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n")),
    )
    return pairs.select(F.col("x.digest").alias("a"), F.col("y.digest").alias("b")).distinct()


def _pooled(large: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links across the components of larger buckets: overlapping buckets are a pool, compared in blocks of two portions."""
    pools = components(large.select(F.col("pivot").alias("a"), F.col("digest").alias("b")))
    classes = large.select("digest", "label", "n").distinct()
    pooled = stored(classes.join(pools, classes["digest"] == pools["node"]).select("component", "digest", "label", "n"))
    portions = F.greatest(F.ceil(F.count(F.lit(1)) / PORTION_CLASSES), F.ceil(F.sum("n") / PORTION_ELEMENTS)).cast("int")
    sizes = pooled.groupBy("component").agg(portions.alias("portions"))
    own = F.pmod(F.xxhash64("digest"), F.col("portions")).cast("int")
    spread = pooled.join(sizes, "component").select(
        "component", "digest", "label", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("portions") - 1)).alias("other")
    )
    blocks = spread.join(sets.select("digest", "elements"), "digest").select(
        "component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "label", "digest", "elements"
    )
    return blocks.groupBy("component", "i", "j").applyInArrow(_block(percent), "a binary, b binary")


def _sifted(source: DataFrame, members: DataFrame) -> DataFrame:
    """Texts of the members' first documents and perhaps a few more, found without a shuffle of texts.

    The ids are set in a bitmap of ``SIEVE`` bits, at most SIEVE / 64 rows of 16 bytes, whatever the number of ids.
    """
    word, bit = (lambda c: F.shiftright(F.pmod(F.xxhash64(c), F.lit(SIEVE)), 6)), (lambda c: F.pmod(F.xxhash64(c), F.lit(64)).cast("int"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit("first"))
    sieve = members.select(word("first").alias("word"), one.alias("one")).groupBy("word").agg(F.bit_or("one").alias("bits"))
    found = source.withColumn("word", word("doc_id")).join(F.broadcast(sieve), "word")
    return found.where(F.getbit("bits", bit("doc_id")) == 1).select("text")


def _labelled(source: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, row, the component's name (null without shingles) and its smallest id, for (doc_id, text, row)."""
    rows = stored(source.mapInArrow(_sketches(width), "doc_id long, n_shingles long, digest binary, bands array<long>, row binary"))
    classes = rows.where("digest is not null").groupBy("digest").agg(
        F.min("doc_id").alias("first"), F.any_value("n_shingles").alias("n"), F.any_value("bands").alias("bands")
    )
    banded = classes.select("digest", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count(F.lit(1)).alias("many")).where("many > 1")
    found = stored(banded.join(shared, "band"))
    pivots = found.groupBy("band").agg(F.min("digest").alias("pivot"))
    members = stored(found.join(pivots, "band").join(classes.select("digest", "first", "n"), "digest"))

    sets = stored(
        _sifted(source, members).mapInArrow(_sets(width), "digest binary, elements binary, marks binary")
        .join(members.select("digest").distinct(), "digest", "left_semi")
        .dropDuplicates(["digest"])
    )
    tried = stored(members.where("digest <> pivot").select(F.col("pivot").alias("a"), F.col("digest").alias("b")).distinct())
    stars = stored(linked(tried, sets, percent))

    parts = components(stars)
    left = _open(members, parts)
    rest = stored(_across(left.where(F.col("many") <= SMALL), percent).join(tried, ["a", "b"], "left_anti"))
    more = linked(rest, sets, percent).union(_pooled(left.where(F.col("many") > SMALL), sets, percent))

    final = components(parts.selectExpr("node as a", "component as b").union(more))
    named = classes.select("digest", "first").join(final, classes["digest"] == final["node"], "left").select(
        "digest", "first", F.coalesce("component", "digest").alias("component")
    )
    lowest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    labels = named.join(lowest, "component").select("digest", "component", "component_id")
    return rows.drop("bands").join(labels, "digest", "left").drop("digest")


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 2, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), F.lit(None).cast("binary").alias("row"))
    return (
        _labelled(source, width, percent)
        .select("doc_id", "n_shingles", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 2, percent: int = 80) -> DataFrame:
    """One document of each group, with its own columns: the one of smallest id; repeated rows leave one row."""
    parts = (F.coalesce(F.concat(F.lit("="), c), F.lit("")) for c in (F.col(key).cast("string"), F.col(text)))
    row = F.unhex(F.sha2(F.concat_ws(":", *parts), 256))
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), row.alias("row"))
    found = _labelled(source, width, percent)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row"))["row"]
    kept = found.groupBy(F.coalesce("component", "row")).agg(first.alias("row")).select("row").distinct()
    own = [docs[c] for c in docs.columns]
    named = docs.select(F.struct(*own).alias("own"), row.alias("row"))
    return named.join(kept, "row", "left_semi").dropDuplicates(["row"]).select("own.*")
