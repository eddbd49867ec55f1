"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built of labelled text. A text is parsed into phrases, each the longest match in
that language's text from where the last one ended. A phrase is named by its place in a training text of n characters, which
takes log2(n) bits; the language that needs the fewest bits wins. So languages with more training text, whose phrases are
longer for that alone, have no advantage.

The training text is a bounded sample of whole labelled documents: for each language those of up to ``SAMPLE_CHARS``
characters first, then those of up to twice as many, and so on, by the least hash of their id, at most ``SAMPLE_ROWS`` of them
and ``SAMPLE_ROWS * SAMPLE_CHARS`` characters in all (one document at least). So the automata have a size set by parameters
and are broadcast. Every text
is parsed whole, in segments of ``SEGMENT`` characters side by side; a phrase ends at the end of a segment.

The score is the runner-up's number of bits over the sum of the two best (0.5 for a tie up to 1); it is 1 with one
language. Ties go to the language that sorts first.

Edge cases: a text that is null or has no letter is ``und`` with score 0, as is every text where no label was learnt from;
a null id counts as the text of nothing and is not held out; repeated rows get the same answer; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.llm.common import slices

SAMPLE_ROWS = 32
SAMPLE_CHARS = 1_000
SEGMENT = 512
MOST_LANGUAGES = 64
UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+").findall
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


def held_out(key: Column, of: int = 4) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % of == 2, F.lit(False))


def suffix_automaton(text: str) -> list[dict[str, int]]:
    """Transitions of the states of the smallest automaton that reads exactly the substrings of ``text``."""
    moves: list[dict[str, int]] = [{}]
    link, longest, last = [-1], [0], 0
    for c in text:
        new = len(moves)
        moves.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if longest[p] + 1 == longest[q]:
                link[new] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                longest.append(longest[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return moves


def folded(text: str) -> str:
    """Lower-case letters, and one blank for all between them."""
    return " ".join(LETTERS(text.lower()))


class Model:
    """Automata of all languages as tables: next state by state and symbol, 0 where there is none."""

    def __init__(self, samples: dict[str, list[str]]) -> None:
        self.languages = sorted(samples)
        texts = {name: "\n".join(folded(t) for t in samples[name]) for name in self.languages}
        alphabet = sorted({c for t in texts.values() for c in t} - {"\n"})
        # Symbol 0 is every character that no sample has; it also parts the sample's documents.
        self.symbol = np.zeros(0x110000, np.uint16)
        for i, c in enumerate(alphabet):
            self.symbol[ord(c)] = i + 1
        self.width = len(alphabet) + 1
        self.tables = [self._table(texts[name]) for name in self.languages]
        self.bits = np.array([np.log2(max(2, len(texts[name]))) for name in self.languages])
        self.space = int(self.symbol[32])

    def _table(self, text: str) -> np.ndarray:
        moves = suffix_automaton(text)
        table = np.zeros((len(moves), self.width), np.int32)
        for state, row in enumerate(moves):
            for c, to in row.items():
                if c != "\n":
                    table[state, self.symbol[ord(c)]] = to
        return table.ravel()

    def phrases(self, symbols: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Phrases of each segment in each language."""
        out = np.zeros((len(self.tables), len(start)), np.int64)
        # The longest first, so those still being read are the first ones.
        order = np.argsort(-size, kind="stable")
        at, left = start[order], size[order]
        lengths = np.arange(int(left[0]) if len(left) else 0)
        active = np.searchsorted(-left, -lengths, "left")
        for which, table in enumerate(self.tables):
            count = np.zeros(len(at), np.int64)
            state = np.zeros(len(at), np.int64)
            for i, n in zip(lengths, active):
                symbol = symbols[at[:n] + i]
                to = table[state[:n] * self.width + symbol]
                stuck = np.flatnonzero(to == 0)
                if len(stuck):
                    # A phrase ends before a character that cannot follow; a character that cannot begin one is one.
                    count[stuck] += state[stuck] > 0
                    again = table[symbol[stuck]]
                    count[stuck] += again == 0
                    to[stuck] = again
                state[:n] = to
            count += state > 0
            out[which, order] = count
        return out


def _characters(text: str, model: Model) -> tuple[np.ndarray, bool]:
    plain = folded(text)
    return model.symbol[np.frombuffer(plain.encode("utf-32-le"), np.uint32)], any(map(str.isalpha, plain))


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for batch in batches:
            for part in slices(batch.column(2)):
                texts = [t or "" for t in batch.column(2).slice(part.first, part.last - part.first).to_pylist()]
                coded = [_characters(t, model) for t in texts]
                sizes = np.array([len(c) for c, _ in coded], np.int64)
                symbols = np.concatenate([c for c, _ in coded]).astype(np.int64)
                pieces = -(-sizes // SEGMENT)
                row = np.repeat(np.arange(len(texts)), pieces)
                shift = (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * SEGMENT
                start = np.repeat(np.cumsum(sizes) - sizes, pieces) + shift
                counted = model.phrases(symbols, start, np.minimum(SEGMENT, sizes[row] - shift))
                totals = np.stack([np.bincount(row, c, len(texts)) for c in counted], axis=1) * model.bits
                best = totals.argmin(axis=1)
                two = np.sort(totals, axis=1)[:, :2]
                score = two[:, 1] / np.maximum(two.sum(axis=1), 1e-9) if len(model.languages) > 1 else np.ones(len(texts))
                known = np.array([letter for _, letter in coded])
                names = [model.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
                held = [batch.column(i).slice(part.first, len(texts)) for i in (0, 1)]
                yield pa.record_batch([*held, pa.array(names), pa.array(np.where(known, score, 0.0))], ["doc_id", "held_out", "lang_pred", "score"])

    return run


def samples(docs: DataFrame, key: str, text: str, lang: str, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> dict[str, list[str]]:
    """Training text of each language; its size is bounded by the parameters."""
    letters = F.col(text).rlike("\\p{L}")
    learnt = docs.where(F.col(lang).isNotNull() & letters & F.col(key).isNotNull() & ~held_out(F.col(key)))
    # Documents are chosen by length and id alone; only the chosen ones' texts are fetched.
    sized = learnt.select(F.col(key).alias("__key"), F.col(lang).alias("__lang"), F.char_length(text).alias("__length"))
    doublings = F.ceil(F.log2(F.greatest("__length", F.lit(chars)) / chars))
    order = Window.partitionBy("__lang").orderBy(doublings, F.xxhash64("__key"), "__key", "__length")
    first = sized.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= rows)
    upto = F.sum("__length").over(Window.partitionBy("__lang").orderBy("__n"))
    chosen = first.withColumn("__upto", upto).where((F.col("__upto") <= rows * chars) | (F.col("__n") == 1))
    # At most ``rows`` rows of a language, of at most MOST_LANGUAGES languages.
    chosen = F.broadcast(chosen.orderBy("__lang", "__n").limit(rows * MOST_LANGUAGES + 1))
    same = (F.col(key) == F.col("__key")) & (F.col(lang) == F.col("__lang")) & (F.char_length(text) == F.col("__length"))
    picked = learnt.join(chosen, same).groupBy("__lang", "__n").agg(F.min(text).alias("__text"))
    found: dict[str, list[str]] = {}
    for name, body in picked.orderBy("__lang", "__n").select("__lang", "__text").collect():
        found.setdefault(name, []).append(body)
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages; train on fewer labels")
    return found


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document, learnt from the labelled ones that are not held out."""
    keyed = docs.select(docs[key].cast("long").alias("doc_id"), held_out(docs[key]).alias("held_out"), docs[text].alias("text"))
    found = samples(docs, key, text, lang)
    if not found:
        return keyed.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    return keyed.mapInArrow(_predict(docs.sparkSession.sparkContext.broadcast(Model(found))), SCHEMA)
