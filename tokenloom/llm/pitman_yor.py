"""Hierarchical Pitman-Yor language model of words, fitted by Gibbs sampling, and document scores under it.

Every context (the word before) has a restaurant in which the training tokens that follow it are customers and the words
are dishes. All context restaurants share one parent, the restaurant of words without context: each table of a context
sends one customer to the parent, and the parent's base is uniform over the V known words and one for all unknown ones.
A word that follows a context once sits alone, so only pairs seen twice or more have a seating to sample. The first sweep
seats the customers one block after the other; each later sweep takes customers out and seats them anew (``RESEATS`` of
each dish), with the probabilities of the Chinese restaurant process. Of a dish's seating the number of tables is kept: the
chance that a customer sits alone is that of a random seating with this many tables. Within a sweep all restaurants work
in parallel with the table counts of its beginning. The model's probability is the mean over the sweeps after ``BURN``.

Words are dealt by their hash. Contexts are hashed to ``CONTEXTS`` restaurants, a parameter that bounds what is broadcast
(two numbers a restaurant and sweep); pairs and words are never collected. The seating is drawn from generators seeded by
bucket and sweep, so it can be computed again from the counts wherever it is needed and nothing of it is stored.

Edge cases: a null text is empty and has the end token only; a null id is not held out; repeated rows are learnt from and
scored each; without training text every probability is the uniform base; extra columns are ignored. Words are told apart
by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import U64, mix, slices, stored, words
from tokenloom.llm.language import held_out

CONTEXTS_BITS = 20
CONTEXTS = 1 << CONTEXTS_BITS
SWEEPS, BURN, RESEATS = 4, 2, 3
STRENGTH = 1.0
FLUSH_TOKENS = 1_500_000
END, START = mix(np.array([1, 2], U64), 501)
EXACT = 256

DEALT = "bucket int, word binary, size binary, context binary, value binary, doc_row binary, doc_train binary, direct binary, lot long"
COUNTED = (
    "bucket int, tokens long, words long, ones long, twos long, word_ones long, word_twos long, single binary, word binary, "
    "context binary, count binary, seen_context binary, seen binary, seen_single binary"
)
SUMMED = "lot long, direct binary, doc_row binary, known binary, base binary, score binary"
PART = "doc_row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _press(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x).tobytes())


def _read(cell, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(cell.as_py()), kind)


def _pack(rows: list[list]) -> pa.Array:
    return pa.array(rows, pa.binary())


def tokens(part) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word, context and row of every token of a slice; each row ends with the end token."""
    found = words(part)
    rows = len(part.bounds) - 1
    size = found.counts + 1
    last = np.cumsum(size) - 1
    code = np.empty(size.sum(), U64)
    code[last] = END
    inner = np.ones(len(code), bool)
    inner[last] = False
    code[inner] = found.hash
    before = np.empty(len(code), U64)
    before[1:] = code[:-1]
    before[last - found.counts] = START
    return code, (mix(before, 502) >> U64(64 - CONTEXTS_BITS)).astype(np.uint32), np.repeat(np.arange(rows), size)


def bucket_of(word: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of the hash, so a table sorted by word is sorted by bucket."""
    return ((word >> U64(40)) * U64(buckets) >> U64(24)).astype(np.int64)


def _deal(buckets: int, with_docs: bool):
    """Tokens of the documents packed by bucket; pairs with counts, or every occurrence with its document."""

    def flush(held) -> Iterator[pa.RecordBatch]:
        word, context, row = (np.concatenate(x) for x in list(zip(*held))[:3])
        docs, trains = (np.concatenate(x) for x in list(zip(*held))[3:5])
        order = np.argsort(word, kind="stable")
        word, context, row = word[order], context[order], row[order]
        cuts = np.searchsorted(bucket_of(word, buckets), np.arange(buckets + 1))
        for b in range(buckets):
            at = slice(cuts[b], cuts[b + 1])
            w, c, r = word[at], context[at], row[at]
            if not len(w):
                continue
            value = np.zeros(0, np.uint32)
            if not with_docs:
                inner = np.lexsort((c, w))
                w, c = w[inner], c[inner]
                first = np.flatnonzero(np.r_[True, (w[1:] != w[:-1]) | (c[1:] != c[:-1])])
                value = np.diff(np.r_[first, len(w)]).astype(np.uint32)
                w, c = w[first], c[first]
            else:
                used, r = np.unique(r, return_inverse=True)
                value = r.astype(np.uint32)
            first = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
            size = np.diff(np.r_[first, len(w)]).astype(np.uint32)
            # Contexts and values by byte planes, of which the high ones are nearly empty.
            planes = [np.ascontiguousarray(x).view(np.uint8).reshape(-1, 4).T for x in (size, c, value)]
            cells = [_press(w[first]), *(_press(p) for p in planes)]
            cells += [_press(docs[used]), _press(trains[used])] if with_docs else [b"", b""]
            yield pa.record_batch([pa.array([b], pa.int32()), *(_pack([x]) for x in cells), _pack([None]), pa.array([docs[0]])], _names(DEALT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, count, held, waiting = TaskContext.get().partitionId() << 33, 0, [], 0
        for batch in batches:
            for part in slices(batch.column(2)):
                word, context, row = tokens(part)
                n = part.last - part.first
                trains = ~batch.column(1).slice(part.first, n).to_numpy(zero_copy_only=False).astype(bool)
                number = base + count + np.arange(n)
                # A lot is what is dealt at once; its documents are numbered on from its own number.
                lot = int(held[0][3][0]) if held else int(number[0])
                held.append((word, context, row + sum(len(x[3]) for x in held), number, trains))
                count, waiting = count + n, waiting + len(word)
                if with_docs:
                    # What is known of the documents goes along with any bucket.
                    known = pa.record_batch([pa.array(number), batch.column(0).slice(part.first, n), pa.array(~trains), pa.array(np.bincount(row, minlength=n))], _names(PART)[:4])
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, known.schema) as out:
                        out.write_batch(known)
                    yield pa.record_batch([pa.array([int(count) % buckets], pa.int32()), *(_pack([None]) for _ in range(6)), _pack([sink.getvalue().to_pybytes()]), pa.array([lot])], _names(DEALT))
                if waiting >= FLUSH_TOKENS:
                    yield from flush(held)
                    held, waiting = [], 0
        if held:
            yield from flush(held)

    return run


@dataclass
class Chunk:
    """A packed row, kept compressed until its turn: distinct words with run lengths, and a context and value a token."""

    lot: int
    cells: dict[str, pa.Scalar]

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        return _read(self.cells["word"], U64), self._planes("size")

    def context(self) -> np.ndarray:
        return self._planes("context")

    def value(self) -> np.ndarray:
        return self._planes("value")

    def docs(self) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers of the documents that values point to, and whether they are learnt from."""
        return _read(self.cells["doc_row"], np.int64), _read(self.cells["doc_train"], np.bool_)

    def _planes(self, name: str) -> np.ndarray:
        return np.ascontiguousarray(_read(self.cells[name], np.uint8).reshape(4, -1).T).view(np.uint32).ravel()


def gathered(batches: Iterator[pa.RecordBatch], buckets_seen: dict[int, list[Chunk]]) -> Iterator[tuple[int, bytes]]:
    """Collect packed rows by bucket, still compressed; documents' facts are passed on with their lot."""
    for batch in batches:
        for i in range(batch.num_rows):
            lot, direct = batch.column("lot")[i].as_py(), batch.column("direct")[i].as_py()
            if direct is not None:
                yield lot, direct
                continue
            # Cells are copied, so that the batch they came in can be freed.
            cells = {c: pa.scalar(batch.column(c)[i].as_py(), pa.binary()) for c in _names(DEALT)[1:7]}
            buckets_seen.setdefault(batch.column("bucket")[i].as_py(), []).append(Chunk(lot, cells))


def summed_pairs(chunks: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (word, context) in order with the sum of their counts; parts are merged as they grow."""
    held: list[tuple] = []
    size, merged = 0, 0
    for chunk in chunks:
        held.append(chunk)
        size += len(chunk[0])
        if size > 2 * merged + FLUSH_TOKENS:
            held = [_merged(held)]
            size = merged = len(held[0][0])
    return _merged(held)


def _merged(held: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    word, context, count = (np.concatenate(x) for x in zip(*held))
    order = np.lexsort((context, word))
    word, context, count = word[order], context[order], count[order]
    first = np.flatnonzero(np.r_[True, (word[1:] != word[:-1]) | (context[1:] != context[:-1])])
    return word[first], context[first], np.add.reduceat(count, first)


@dataclass
class Pairs:
    """Training counts of a bucket: of each known word its single contexts, and the pairs seen twice or more."""

    word: np.ndarray  # hashes of known words, sorted
    single: np.ndarray  # contexts in which a word was seen once
    of: np.ndarray  # of each pair: its word's place
    context: np.ndarray
    count: np.ndarray

    @classmethod
    def of_counts(cls, word: np.ndarray, context: np.ndarray, count: np.ndarray) -> Pairs:
        """``word`` and ``context`` sorted and distinct, counts above zero."""
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(word) else np.zeros(0, np.int64)
        place = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(word)]))
        more = count > 1
        return cls(word[first], np.bincount(place[~more], minlength=len(first)), place[more], context[more].astype(np.int64), count[more].astype(np.int64))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training counts of the buckets of a partition."""
    held: dict[int, list] = {}
    for _ in gathered(batches, held):
        pass
    for bucket in sorted(held):
        chunks = held.pop(bucket)
        word, context, count = summed_pairs((np.repeat(*x.words()), x.context(), x.value().astype(np.int64)) for x in chunks)
        del chunks
        pairs = Pairs.of_counts(word, context, count)
        dishes = np.bincount(pairs.of, minlength=len(pairs.word)) + pairs.single
        seen, at = np.unique(context, return_inverse=True)
        numbers = [count.sum(), len(pairs.word), (count == 1).sum(), (count == 2).sum(), (dishes == 1).sum(), (dishes == 2).sum()]
        cells = [
            pairs.single.astype(np.int32),
            pairs.of.astype(np.int32),
            pairs.context.astype(np.int32),
            pairs.count,
            seen.astype(np.int32),
            np.bincount(at, count).astype(np.int64),
            np.bincount(at).astype(np.int32),
        ]
        yield pa.record_batch(
            [pa.array([bucket], pa.int32()), *(pa.array([int(n)], pa.int64()) for n in numbers), *(_pack([_press(x)]) for x in cells)], _names(COUNTED)
        )


def alone_table(discount: float, size: int = EXACT) -> np.ndarray:
    """Chance that a customer sits alone, for c customers at t tables: a ratio of generalised Stirling numbers.

    With S(c, t) = S(c-1, t-1) + (c-1 - t d) S(c-1, t), the ratio x(c, t) = S(c-1, t-1) / S(c, t) follows from the one
    before by y = S(c-1, t) / S(c-1, t-1), so no large number is formed.
    """
    out = np.zeros((size + 1, size + 1))
    log = np.full((size + 1, size + 1), -np.inf)
    log[0, 0] = 0.0
    for c in range(1, size + 1):
        t = np.arange(1, c + 1)
        with np.errstate(divide="ignore"):
            log[c, 1 : c + 1] = np.logaddexp(log[c - 1, t - 1], np.log(np.maximum(c - 1 - t * discount, 0)) + log[c - 1, t])
            out[c, 1 : c + 1] = np.exp(log[c - 1, t - 1] - log[c, t])
    return out


@dataclass
class Level:
    discount: float
    alone: np.ndarray

    @classmethod
    def fitted(cls, ones: int, twos: int) -> Level:
        discount = min(0.95, max(0.05, (ones + 0.5) / (ones + 2 * twos + 1)))
        return cls(discount, alone_table(discount))

    def chance_alone(self, count: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Exact up to ``EXACT`` customers; beyond, that of the same share of tables."""
        short = np.minimum(count, EXACT)
        scaled = np.where(count > EXACT, np.maximum(1, np.rint(table * (EXACT / np.maximum(count, 1)))), table).astype(np.int64)
        return self.alone[short, np.minimum(scaled, short)]

    def seat(self, draw, tables: np.ndarray, have: np.ndarray, want: np.ndarray, pull: np.ndarray) -> np.ndarray:
        """Tables after customers ``have`` + 1 to ``want`` have come; ``pull`` is the weight of a new table.

        One by one at first, then in blocks of a sixteenth of those seated.
        """
        tables, have = tables.copy(), have.copy()
        active = np.flatnonzero(have < want)
        while len(active):
            n, t = have[active], tables[active]
            block = np.minimum(np.maximum(1, n // 16), want[active] - n)
            chance = pull[active] / (pull[active] + np.maximum(n - self.discount * t, 0))
            chance = np.where(n == 0, 1.0, chance)
            tables[active] = t + draw.binomial(block, np.clip(chance, 0, 1))
            have[active] = n + block
            active = active[have[active] < want[active]]
        return tables

    def leave(self, draw, tables: np.ndarray, have: np.ndarray, want: np.ndarray) -> np.ndarray:
        """Tables after have - want customers have gone, in blocks of a sixteenth of those seated."""
        tables, have = tables.copy(), have.copy()
        active = np.flatnonzero(have > want)
        while len(active):
            n, t = have[active], tables[active]
            block = np.minimum(np.maximum(1, n // 16), n - want[active])
            gone = draw.binomial(block, self.chance_alone(n, t))
            tables[active] = np.maximum(t - gone, np.minimum(1, n - block))
            have[active] = n - block
            active = active[have[active] > want[active]]
        return tables

    def reseat(self, draw, tables: np.ndarray, count: np.ndarray, pull: np.ndarray, times: int) -> np.ndarray:
        """Take a customer of each dish out and seat it again, ``times`` times."""
        for _ in range(times):
            gone = draw.random(len(tables)) < self.chance_alone(count, tables)
            tables = tables - gone
            chance = pull / (pull + np.maximum(count - 1 - self.discount * tables, 0))
            tables = tables + (draw.random(len(tables)) < chance)
        return tables


class Packed:
    """An array that is pickled compressed, as broadcasts are files on every machine."""

    def __init__(self, values: np.ndarray) -> None:
        self.values = values

    def __getstate__(self):
        return str(self.values.dtype), zstandard.ZstdCompressor(level=3).compress(self.values.tobytes())

    def __setstate__(self, state) -> None:
        kind, body = state
        self.values = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), kind)


@dataclass
class Sweep:
    """Totals after a sweep: tables of each context (a broadcast array), and customers and tables of the parent."""

    shared: object
    customers: int
    root_tables: int

    @property
    def tables(self) -> np.ndarray:
        return self.shared.value.values


@dataclass
class Model:
    """What every task needs: counts and discounts of both levels, and the totals after each sweep so far."""

    tokens: int
    words: int
    shared: object  # customers of each context, a broadcast array
    pair: Level
    root: Level
    sweeps: list[Sweep] = field(default_factory=list)

    @property
    def customers(self) -> np.ndarray:
        return self.shared.value.values

    def word_chance(self, customers: np.ndarray, tables: np.ndarray, sweep: Sweep) -> np.ndarray:
        base = 1.0 / (self.words + 1)
        spare = (STRENGTH + self.root.discount * sweep.root_tables) / (STRENGTH + sweep.customers)
        return np.maximum(customers - self.root.discount * tables, 0) / (STRENGTH + sweep.customers) + spare * base

    def chain(self, bucket: int, pairs: Pairs) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """After each sweep: tables of each pair, and customers and tables of each word in the parent."""
        tables = np.ones(len(pairs.count), np.int64)
        n = len(pairs.word)
        served = pairs.single + np.bincount(pairs.of, tables, n).astype(np.int64)
        seated = np.ones(n, np.int64)
        for number, sweep in enumerate(self.sweeps):
            draw = np.random.default_rng([bucket, number])
            new_root = (STRENGTH + self.root.discount * sweep.root_tables) / (self.words + 1)
            pull_root = np.full(n, new_root)
            if number == 0:
                seated = self.root.seat(draw, seated, np.ones(n, np.int64), served, pull_root)
            chance = self.word_chance(served, seated, sweep)
            pull = (STRENGTH + self.pair.discount * sweep.tables[pairs.context]) * chance[pairs.of]
            if number == 0:
                tables = self.pair.seat(draw, tables, np.ones(len(tables), np.int64), pairs.count, pull)
            else:
                tables = self.pair.reseat(draw, tables, pairs.count, pull, RESEATS)
            now = pairs.single + np.bincount(pairs.of, tables, n).astype(np.int64)
            seated = self.root.leave(draw, seated, served, np.minimum(served, now))
            seated = self.root.seat(draw, seated, np.minimum(served, now), now, pull_root)
            served = now
            seated = self.root.reseat(draw, seated, served, pull_root, RESEATS)
            yield tables, served, seated


def _sweep(model: Model):
    """Totals of the newest sweep: tables of contexts, and a row with context -1 for the parent's tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                single = _read(batch.column("single")[i], np.int32).astype(np.int64)
                of, context = (_read(batch.column(c)[i], np.int32).astype(np.int64) for c in ("word", "context"))
                pairs = Pairs(np.zeros(len(single), U64), single, of, context, _read(batch.column("count")[i], np.int64))
                for tables, _, seated in model.chain(batch.column("bucket")[i].as_py(), pairs):
                    pass
                used, at = np.unique(context, return_inverse=True)
                # A pair has one table at least; what goes beyond is reported.
                extra = np.bincount(at, tables - 1, len(used)).astype(np.int64)
                keep = extra > 0
                columns = [pa.array(np.r_[used[keep], -1].astype(np.int32)), pa.array(np.r_[extra[keep], seated.sum()].astype(np.int64))]
                yield pa.record_batch(columns, ["context", "n"])

    return run


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            cells = [_read(batch.column(c)[i], k) for c, k in (("seen_context", np.int32), ("seen", np.int64), ("seen_single", np.int32))]
            yield pa.record_batch([pa.array(cells[0]), pa.array(cells[1]), pa.array(cells[2].astype(np.int64))], ["context", "customers", "dishes"])


def fit(train: DataFrame) -> Model:
    """Counts by bucket, then one pass over them for each sweep. ``train``: doc_id, held_out, text."""
    spark = train.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = train.mapInArrow(_deal(buckets, False), DEALT).repartition(buckets, "bucket")
    counted = stored(dealt.mapInArrow(_count, COUNTED))
    sums = counted.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _names(COUNTED)[1:7]]).first()
    seen = counted.mapInArrow(_contexts, "context int, customers long, dishes long").groupBy("context").agg(F.sum("customers").alias("n"), F.sum("dishes").alias("d"))
    found = seen.toArrow()  # at most CONTEXTS rows
    customers, dishes = np.zeros(CONTEXTS, np.int64), np.zeros(CONTEXTS, np.int64)
    at = found["context"].to_numpy()
    customers[at], dishes[at] = found["n"].to_numpy(), found["d"].to_numpy()
    send = lambda values: spark.sparkContext.broadcast(Packed(values))
    model = Model(sums["tokens"], sums["words"], send(customers), Level.fitted(sums["ones"], sums["twos"]), Level.fitted(sums["word_ones"], sums["word_twos"]))
    model.sweeps.append(Sweep(send(dishes), int(dishes.sum()), model.words))
    for _ in range(SWEEPS):
        part = counted.select("bucket", "single", "word", "context", "count").mapInArrow(_sweep(model), "context int, n long")
        total = part.groupBy("context").agg(F.sum("n").alias("n")).toArrow()  # at most CONTEXTS + 1 rows
        context, n = total["context"].to_numpy(), total["n"].to_numpy()
        tables = dishes.copy()
        inside = context >= 0
        tables[context[inside]] += n[inside]
        model.sweeps.append(Sweep(send(tables), int(tables.sum()), int(n[~inside].sum())))
    return model


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for lot, direct in gathered(batches, held):
            yield pa.record_batch([pa.array([lot]), _pack([direct]), *(_pack([None]) for _ in range(4))], _names(SUMMED))
        for bucket in sorted(held):
            chunks = held.pop(bucket)
            word, context, count = summed_pairs(_learnt(x) for x in chunks)
            context = context.astype(np.int64)
            learnt = count > 0
            pairs = Pairs.of_counts(word[learnt], context[learnt], count[learnt])
            place = np.searchsorted(pairs.word, word)
            inside = np.minimum(place, max(0, len(pairs.word) - 1))
            is_known = pairs.word[inside] == word if len(pairs.word) else np.zeros(len(word), bool)
            total = np.zeros(len(word))
            more = np.flatnonzero(count > 1)
            discount, customers = model.pair.discount, model.customers[context]
            used = 0
            for number, (tables, served, seated) in zip(range(1, len(model.sweeps)), model.chain(bucket, pairs)):
                if number <= BURN:
                    continue
                used += 1
                after = model.sweeps[number]
                chance = np.append(model.word_chance(served, seated, after), model.word_chance(np.zeros(1), np.zeros(1), after))
                word_p = chance[np.where(is_known, inside, len(pairs.word))]
                own = np.where(learnt, 1.0 - discount, 0.0)
                own[more] = count[more] - discount * tables
                spare = STRENGTH + discount * after.tables[context]
                total += np.where(customers > 0, (own + spare * word_p) / (STRENGTH + customers), word_p)
            seen = np.bincount(place[is_known], count[is_known], len(pairs.word) + 1)[np.where(is_known, place, len(pairs.word))]
            base = np.log10((seen + 1) / (model.tokens + model.words + 1))
            gain = np.log10(total / used)
            # The chunks are read again, one at a time, and give the sums of their documents.
            names, at = np.unique(word, return_inverse=True)
            code = (at << CONTEXTS_BITS) | context
            for chunk in chunks:
                found, size = chunk.words()
                token = np.repeat(np.searchsorted(names, found) << CONTEXTS_BITS, size) | chunk.context()
                token = np.searchsorted(code, token)
                of, docs = chunk.value(), chunk.docs()[0]
                sums = [np.bincount(of, x[token], len(docs)) for x in (is_known, base, gain)]
                yield pa.record_batch([pa.array([chunk.lot]), _pack([None]), *(_pack([_press(x)]) for x in (docs, *sums))], _names(SUMMED))

    return run


def _learnt(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (word, context) of a chunk and how often each stands in a document that is learnt from."""
    word, size = chunk.words()
    code = np.repeat(np.arange(len(word)) << CONTEXTS_BITS, size) | chunk.context()
    code, at = np.unique(code, return_inverse=True)
    count = np.bincount(at, chunk.docs()[1][chunk.value()], len(code)).astype(np.int64)
    return word[code >> CONTEXTS_BITS], (code & (CONTEXTS - 1)).astype(np.uint32), count


def _by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Facts and sums of the documents of the lots of a partition; only the sums of a lot are held, not its parts."""
    facts: dict[int, list[pa.RecordBatch]] = {}
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for i in range(batch.num_rows):
            lot, direct = batch.column("lot")[i].as_py(), batch.column("direct")[i].as_py()
            if direct is not None:
                facts.setdefault(lot, []).append(pa.ipc.open_stream(direct).read_next_batch())
                continue
            at = _read(batch.column("doc_row")[i], np.int64) - lot
            total = sums.get(lot, np.zeros((3, 0)))
            if at.max() >= total.shape[1]:
                total = np.pad(total, ((0, 0), (0, int(at.max()) + 1 - total.shape[1])))
            # Documents are distinct within a part.
            total[:, at] += [_read(batch.column(c)[i], np.float64) for c in ("known", "base", "score")]
            sums[lot] = total
    for lot, held in facts.items():
        known, base, gain = sums[lot]
        for rows in held:
            at = rows.column(0).to_numpy() - lot
            yield pa.record_batch([*rows.columns, pa.array(known[at].astype(np.int64)), pa.array(base[at]), pa.array(gain[at])], _names(PART))


def score(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select(docs[key].cast("long").alias("doc_id"), held_out(docs[key], 7).alias("held_out"), docs[text].alias("text"))
    model = fit(keyed.where(~F.col("held_out")))
    dealt = keyed.mapInArrow(_deal(buckets, True), DEALT).repartition(buckets, "bucket")
    parts = dealt.mapInArrow(_score(model), SUMMED).repartition(buckets, "lot")
    found = parts.mapInArrow(_by_document, PART)
    return found.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score")
