"""Phrase collocations by HAT-trie counting.

Every task counts its phrases in a trie a few levels deep whose leaves are hash containers (``Container``, an open-addressed
table of packed word ids). The path is made of digits of the hash of a phrase's first two words, the prefix; a container
that grows past ``BURST`` entries bursts into ``FAN`` children, and past ``DEEP`` levels its digits come from the third word.
When a task holds more than ``BUDGET`` entries, whole subtrees of the root, largest first, are spilled as sorted runs of
phrases with counts. Runs go to the partition their prefix belongs to and are merged there, one partition at a time. So
memory follows the budget and the size of one prefix partition; a word that begins a third of all phrases is spread by its
second words, and a phrase found everywhere is one entry of each run.

Word ids are those of a task's own dictionary, so no two words are ever taken for one; runs hold the words themselves.

Score: a candidate of frequency a, cut into a first part (frequency l) and a rest (r), has floor(SCALE * a * a / (l * r)); the
lowest-scoring cut counts, of equal ones the earliest. Decimals of 38 digits keep it exact for a below 10^16. A candidate
whose words lie inside a longer candidate of at least ``ABSORBED`` percent of its frequency is dropped.

Edge cases: a null or empty text has no words; a null lang is ``und``; a phrase never crosses a document or one of
``.,;:!?`` and the bytes 10 to 13; repeated rows count each; ids and extra columns are ignored; without candidates the
result has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.llm.common import U64, QuickHash, Slice, mix, ragged, slices, stored

LONGEST = 3
LEAST = 10
TOP = 2000
SCALE = 1_000_000
ABSORBED = 50
ID_BITS = 21
FAN_BITS, DEEP = 6, 4
FAN = 1 << FAN_BITS
BURST = 32_768
BUDGET = 800_000
WORDS = 500_000
PARTS = 8
SPILL = 100_000
HELD = 1_000_000
SLICE_BYTES = 2 << 20
RUNS = "part int, lang string, phrases binary, n binary"
COUNTS = "lang string, phrase string, words int, f long"

# Bytes that part words, and bytes that end a piece of text.
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09]] = True
BREAK = np.zeros(256, bool)
BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32


class Container:
    """Counts by 64-bit key (0 is no key) in an open-addressed table, filled a batch at a time."""

    def __init__(self, room: int = 64) -> None:
        self.keys, self.counts, self.size = np.zeros(room, U64), np.zeros(room, np.int64), 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Add the counts of distinct keys."""
        if (self.size + len(keys)) * 5 > len(self.keys) * 3:
            old_keys, old_counts = self.entries()
            room = 1 << int((self.size + len(keys)) * 5 // 2).bit_length()
            self.keys, self.counts, self.size = np.zeros(room, U64), np.zeros(room, np.int64), 0
            self._put(old_keys, old_counts)
        self._put(keys, counts)

    def _put(self, keys: np.ndarray, counts: np.ndarray) -> None:
        mask = len(self.keys) - 1
        slot = (mix(keys, 81) & U64(mask)).astype(np.int64)
        while len(keys):
            there = self.keys[slot]
            free = there == 0
            # Of the keys that want one free slot the last one gets it; the others go on.
            self.keys[slot[free]] = keys[free]
            mine = self.keys[slot] == keys
            self.counts[slot[mine]] += counts[mine]
            self.size += int((mine & free).sum())
            keys, counts, slot = keys[~mine], counts[~mine], (slot[~mine] + 1) & mask

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        used = self.keys != 0
        return self.keys[used], self.counts[used]


class Node:
    """A container, or after its burst ``FAN`` nodes one level deeper."""

    def __init__(self, depth: int) -> None:
        self.depth, self.size = depth, 0
        self.held: Container | None = Container()
        self.children: list[Node] = []

    def add(self, keys: np.ndarray, counts: np.ndarray, path) -> int:
        """Add distinct keys; returns how many of them are new."""
        before = self.size
        if self.held is not None:
            self.held.add(keys, counts)
            self.size = self.held.size
            # The path has ten digits; a container at its end grows on.
            if self.size > BURST and self.depth < 10:
                keys, counts = self.held.entries()
                self.held, self.size = None, 0
                self.children = [Node(self.depth + 1) for _ in range(FAN)]
                self._deal(keys, counts, path)
        else:
            self._deal(keys, counts, path)
        return self.size - before

    def _deal(self, keys: np.ndarray, counts: np.ndarray, path) -> None:
        digit = path(keys, self.depth)
        order = np.argsort(digit, kind="stable")
        cuts = np.searchsorted(digit[order], np.arange(FAN + 1))
        for d in np.flatnonzero(np.diff(cuts)):
            at = order[cuts[d] : cuts[d + 1]]
            self.size += self.children[d].add(keys[at], counts[at], path)

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        if self.held is not None:
            return self.held.entries()
        found = [c.entries() for c in self.children if c.size]
        return np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])


class Counter:
    """The tries of one task, one for each language, over one dictionary of words."""

    def __init__(self, parts: int) -> None:
        self.parts = parts
        self._reset()

    def _reset(self) -> None:
        self.ids: dict[bytes, int] = {}
        self.words: list[bytes] = [b""]
        self.hashes = np.zeros(1, U64)
        self.tries: dict[str, Node] = {}
        self.size = 0

    def number(self, column: pa.Array) -> np.ndarray:
        """The ids of words, new ones included."""
        coded = column.dictionary_encode()
        words = coded.dictionary.to_pylist()
        known = [self.ids.get(word, 0) for word in words]
        fresh = [k for k, at in enumerate(known) if not at]
        if fresh:
            first = len(self.words)
            for at, k in enumerate(fresh, first):
                known[k] = self.ids[words[k]] = at
            new = [words[k] for k in fresh]
            self.words += new
            bounds = np.cumsum([0, *map(len, new)])
            hashed = QuickHash(np.frombuffer(b"".join(new), np.uint8))(bounds[:-1], bounds[1:])
            self.hashes = np.concatenate([self.hashes, mix(hashed, 83)])
        return np.array(known, np.int64)[coded.indices.to_numpy(zero_copy_only=False)]

    def prefix(self, keys: np.ndarray) -> np.ndarray:
        """Hash of the first two words, the same in every task."""
        mask = U64((1 << ID_BITS) - 1)
        first, second = keys >> U64(2 * ID_BITS), (keys >> U64(ID_BITS)) & mask
        with np.errstate(over="ignore"):
            return mix(self.hashes[first] * U64(3) + self.hashes[second], 85)

    def path(self, keys: np.ndarray, depth: int) -> np.ndarray:
        hashed = self.prefix(keys)
        if depth >= DEEP:
            with np.errstate(over="ignore"):
                hashed = mix(hashed + self.hashes[keys & U64((1 << ID_BITS) - 1)], 87)
        return ((hashed >> U64(64 - FAN_BITS * (depth + 1))) & U64(FAN - 1)).astype(np.uint8)

    def add(self, lang: str, keys: np.ndarray) -> None:
        trie = self.tries.setdefault(lang, Node(0))
        self.size += trie.add(*np.unique(keys, return_counts=True), self.path)

    def overflow(self) -> Iterator[pa.RecordBatch]:
        """Spill what is too much: the largest subtrees, or everything where the dictionary is full."""
        if len(self.words) > WORDS:
            yield from self.finish()
        elif self.size > BUDGET:
            # A trie that has not burst is a subtree of its own.
            subtrees = [(c.size, lang, t, d) for lang, t in self.tries.items() for d, c in enumerate(t.children or [t]) if c.size]
            spilled: dict[str, list[Node]] = {}
            for size, lang, trie, d in sorted(subtrees, key=lambda x: -x[0]):
                if self.size <= BUDGET // 2:
                    break
                spilled.setdefault(lang, []).append(trie.children[d] if trie.children else trie)
                if trie.children:
                    trie.children[d] = Node(1)
                    trie.size -= size
                else:
                    self.tries[lang] = Node(0)
                self.size -= size
            for lang, trees in spilled.items():
                yield from self.run(lang, trees)

    def finish(self) -> Iterator[pa.RecordBatch]:
        for lang, trie in self.tries.items():
            if trie.size:
                yield from self.run(lang, [trie])
        self._reset()

    def run(self, lang: str, trees: list[Node]) -> Iterator[pa.RecordBatch]:
        """Whole subtrees as sorted runs, one for each prefix partition.

        The order is that of the words' hashes, the same in every task, so a run needs no comparison of texts.
        """
        keys, counts = (np.concatenate(x) for x in zip(*(t.entries() for t in trees)))
        prefix = self.prefix(keys)
        order = np.lexsort((self.hashes[keys & U64((1 << ID_BITS) - 1)], prefix))
        for low in range(0, len(order), SPILL):
            yield self._written(lang, keys[order[low : low + SPILL]], counts[order[low : low + SPILL]], prefix[order[low : low + SPILL]])

    def _written(self, lang: str, keys: np.ndarray, counts: np.ndarray, prefix: np.ndarray) -> pa.RecordBatch:
        part = (prefix >> U64(32)) * U64(self.parts) >> U64(32)
        ids = np.stack([keys >> U64(2 * ID_BITS), (keys >> U64(ID_BITS)) & U64((1 << ID_BITS) - 1), keys & U64((1 << ID_BITS) - 1)], 1).astype(np.int64)
        used = np.zeros(len(self.words), bool)
        used[ids] = True
        number = np.cumsum(used) - 1
        local = number[ids]
        # A word is written with a blank after it, and the last blank of a phrase becomes a line end; id 0 writes nothing.
        spelt = [self.words[i] + b" " if i else b"" for i in np.flatnonzero(used).tolist()]
        size = np.fromiter(map(len, spelt), np.int64, len(spelt))
        start, data = np.cumsum(size) - size, np.frombuffer(b"".join(spelt), np.uint8)
        length = size[local]
        ends = np.cumsum(length.sum(1))
        cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True])
        flat = length.ravel()
        written = data[np.repeat(start[local].ravel(), flat) + ragged(flat)]
        written[ends - 1] = 10
        bounds = np.r_[0, ends][cuts]
        texts = pa.BinaryArray.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(written)])
        numbers = pa.BinaryArray.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * 8).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(counts))])
        columns = [pa.array(part[cuts[:-1]].astype(np.int32)), pa.array([lang] * len(texts), pa.string()), texts, numbers]
        return pa.record_batch(columns, ["part", "lang", "phrases", "n"])


def split_words(part: Slice) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Lower-cased words of a slice, the row of each, and the number of its piece."""
    data, n = LOWERED[part.data], len(part.data)
    ends_piece = BREAK[data]
    solid = ~(BLANK[data] | ends_piece)
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    inner = part.bounds[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    first[inner] |= solid[inner]
    last[inner - 1] |= solid[inner - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    row = np.searchsorted(part.bounds, start, "right") - 1
    piece = np.cumsum(ends_piece)[start] if n else start
    size = end - start
    offsets = np.concatenate([[0], np.cumsum(size)])
    kept = data[solid]
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(kept))])
    return column, row, piece


def phrase_keys(ids: np.ndarray, row: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed ids of all phrases of one to three words, and the place of each one's first word."""
    ids = ids.astype(U64)
    together = (row[1:] == row[:-1]) & (piece[1:] == piece[:-1])
    two = np.flatnonzero(together)
    three = np.flatnonzero(together[1:] & together[:-1])
    shift, shift2 = U64(ID_BITS), U64(2 * ID_BITS)
    keys = [ids << shift2, ids[two] << shift2 | ids[two + 1] << shift, ids[three] << shift2 | ids[three + 1] << shift | ids[three + 2]]
    return np.concatenate(keys), np.concatenate([np.arange(len(ids)), two, three])


def _count(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(parts)
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            names = langs.dictionary.to_pylist()
            lang_of = langs.indices.to_numpy(zero_copy_only=False)
            for part in slices(batch.column(1), SLICE_BYTES):
                column, row, piece = split_words(part)
                if not len(row):
                    continue
                keys, place = phrase_keys(counter.number(column), row, piece)
                lang = lang_of[part.first + row[place]]
                for k in np.unique(lang):
                    counter.add(names[k], keys[lang == k])
                yield from counter.overflow()
        yield from counter.finish()

    return run


def _merge(least: int):
    """Runs, sorted by partition, to the frequent phrases; a row without a phrase holds a partition's words in all."""

    def summed(held: list[pa.Table]) -> pa.Table:
        table = pa.concat_tables(held).group_by(["lang", "phrase"], use_threads=False).aggregate([("n", "sum")])
        return table.rename_columns(["lang", "phrase", "n"])

    def result(held: list[pa.Table], names: list[str]) -> pa.RecordBatch:
        table = summed(held).combine_chunks()
        phrases, n, lang = table["phrase"].combine_chunks(), table["n"].to_numpy(), table["lang"].to_numpy()
        bounds = np.frombuffer(phrases.buffers()[1], np.int64)[phrases.offset : phrases.offset + len(phrases) + 1]
        blanks = np.flatnonzero(np.frombuffer(phrases.buffers()[2], np.uint8)[: bounds[-1]] == 32)
        words = np.diff(np.searchsorted(blanks, bounds)) + 1
        single = words == 1
        totals = np.bincount(lang[single], weights=n[single], minlength=len(names)).astype(np.int64)
        every = np.flatnonzero(totals)
        at = np.flatnonzero(n >= least)
        # The line end goes.
        text = pa.array([p[:-1].decode() for p in phrases.take(pa.array(at)).to_pylist()] + [None] * len(every), pa.string())
        langs = pa.array(names, pa.string()).take(pa.array(np.r_[lang[at], every]))
        columns = [langs, text, pa.array(np.r_[words[at], np.zeros(len(every))].astype(np.int32)), pa.array(np.r_[n[at], totals[every]])]
        return pa.record_batch(columns, ["lang", "phrase", "words", "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size, current, names = 0, None, {}
        for batch in batches:
            parts = batch.column(0).to_numpy()
            for i in range(batch.num_rows):
                if parts[i] != current and held:
                    yield result(held, list(names))
                    held, size, names = [], 0, {}
                current = parts[i]
                data = np.frombuffer(batch.column(2)[i].as_buffer(), np.uint8)
                n = np.frombuffer(batch.column(3)[i].as_buffer(), np.int64)
                lang = names.setdefault(batch.column(1)[i].as_py(), len(names))
                bounds = np.r_[0, np.flatnonzero(data == 10) + 1]
                phrases = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
                held.append(pa.table([pa.array(np.full(len(n), lang, np.int32)), phrases, pa.array(n)], ["lang", "phrase", "n"]))
                size += len(n)
                if size > HELD:
                    held = [summed(held)]
                    size = held[0].num_rows
        if held:
            yield result(held, list(names))

    return run


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST) -> DataFrame:
    """lang, phrase, words and f of every phrase of one to three words that occurs at least ``least`` times.

    A row of 0 words and no phrase holds a number of words; their sum over a lang is the number of all its words.
    """
    source = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    # A fixed number of parts for each task that merges, so that a spilled subtree makes no more rows as the input grows.
    parts = PARTS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = source.mapInArrow(_count(parts), RUNS)
    return runs.repartition("part").sortWithinPartitions("part").mapInArrow(_merge(least), COUNTS)


def scored(counts: DataFrame) -> DataFrame:
    """lang, phrase, words, a, l, r and score of every phrase of two and more words, by its lowest-scoring cut."""
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    whole = counts.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"), cut)
    head = F.call_function("substring_index", F.col("phrase"), F.lit(" "), F.col("k"))
    cuts = whole.withColumn("head", head).withColumn("tail", F.substring("phrase", F.char_length("head") + 2, F.char_length("phrase")))
    firsts = counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    rests = counts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    joined = cuts.join(firsts, ["lang", "head"]).join(rests, ["lang", "tail"])
    product = F.call_function("div", exact("a") * exact("a") * F.lit(SCALE), exact("l") * exact("r"))
    least = F.min(F.struct(product.cast("long").alias("score"), "k", "l", "r")).alias("best")
    return joined.groupBy("lang", "phrase", "words", "a").agg(least).select("lang", "phrase", "words", "a", "best.l", "best.r", "best.score")


def absorbed(counts: DataFrame, percent: int = ABSORBED) -> DataFrame:
    """lang and phrase of the phrases that lie inside a longer one of at least ``percent`` of their frequency."""
    words = F.split("phrase", " ")
    longer = counts.where("words > 2").select("lang", "words", F.col("f").alias("longer"), words.alias("all"))
    sized = longer.select("lang", "words", "longer", "all", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size"))
    placed = sized.select("lang", "longer", "all", "size", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)).alias("at"))
    inner = placed.select("lang", "longer", F.array_join(F.slice("all", F.col("at"), F.col("size")), " ").alias("phrase"))
    most = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    return counts.join(most, ["lang", "phrase"]).where(100 * F.col("longer") >= percent * F.col("f")).select("lang", "phrase")


def mine(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of two and three words of each lang: lang, rank, phrase, a, l, r, n and score."""
    found = stored(phrase_counts(docs, text, lang, least))
    totals = found.where("words = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    counts = found.where("words > 0")
    kept = scored(counts).join(absorbed(counts), ["lang", "phrase"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
