"""Vocabulary building."""

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions import alphabet, kernels
from tokenloom.functions.text import words
from tokenloom.session import discard, written

# Merges are learnt in batches; this many candidate pairs come back to the driver per pass.
CANDIDATES = 512
# After this many merges the words are written with the merges applied.
REWRITE = 64
WORD_IDS = "ids binary, n long"
PAIRS = "left_id int, right_id int, n long"


@dataclass
class Vocabulary:
    """Tokens by id, merges in rank order as (left id, right id, merged id), and the literals that are matched whole.

    ``tokens`` may have gaps (None). ``specials`` maps each literal to its id and ``roles`` a role (pad, eos, bos) to its
    literal; a vocabulary without a pad literal pads with end-of-text. Literals without an id are ordinary text.
    """

    tokens: list[str | None] = field(default_factory=lambda: [alphabet.PAD, alphabet.EOS, *sorted(alphabet.stand_ins())])
    merges: list[tuple[int, int, int]] = field(default_factory=list)
    specials: dict[str, int] | None = None
    roles: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.specials is None:
            self.specials = {t: i for i, t in enumerate(self.tokens) if t in (alphabet.PAD, alphabet.EOS)}
        end = alphabet.EOS if alphabet.EOS in self.specials else None
        own = {"eos": end, "bos": end, "pad": alphabet.PAD if alphabet.PAD in self.specials else end}
        self.roles = {role: t for role, t in {**own, **self.roles}.items() if t is not None}

    def role_id(self, role: str) -> int:
        return self.specials[self.roles[role]]

    def byte_ids(self) -> np.ndarray:
        """Token id of each byte by its printable stand-in; a byte without a token gets the id past the last one."""
        known = {t: i for i, t in enumerate(self.tokens) if t is not None}
        return np.array([known.get(c, len(self.tokens)) for c in alphabet.stand_ins()], np.int32)

    def byte_strings(self) -> list[bytes]:
        """What each id stands for: the bytes of a token's stand-ins; a special literal is its own text."""
        back = {c: b for b, c in enumerate(alphabet.stand_ins())}
        special = set(self.specials.values())
        return [
            b"" if t is None else t.encode() if i in special or not back.keys() >= set(t) else bytes(back[c] for c in t)
            for i, t in enumerate(self.tokens)
        ]

    def merge_table(self) -> kernels.Merges:
        # Where a pair stands twice in the list, the later rule holds, as in a table read line by line.
        rules = {(a, b): (rank, m) for rank, (a, b, m) in enumerate(self.merges)}
        return kernels.Merges(list(rules), [m for _, m in rules.values()], len(self.tokens) + 1, [r for r, _ in rules.values()])

    def tables(self, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
        """``vocab(token_id, token)`` and ``merges(rank, left, right)``; T5 is ``vocab.count()``."""
        vocab = spark.createDataFrame([(i, t) for i, t in enumerate(self.tokens) if t is not None], "token_id int, token string")
        rules = [(rank, self.tokens[a], self.tokens[b]) for rank, (a, b, _) in enumerate(self.merges)]
        return vocab, spark.createDataFrame(rules, "rank int, left string, right string")

    @classmethod
    def from_tables(cls, vocab: DataFrame, merges: DataFrame, specials: DataFrame | None = None) -> "Vocabulary":
        """Read a vocabulary; its size is what its own tables hold, a bound known before any text is read.

        ``specials(token_id, token)`` names the literals matched whole; without it, the pad and end-of-text literals that
        have an id. A literal may stand in ``vocab`` as well or only here.
        """
        ids = {r.token: r.token_id for r in vocab.collect()}
        literals = None if specials is None else {r.token: r.token_id for r in specials.collect()}
        ids |= literals or {}
        tokens: list[str | None] = [None] * (1 + max(ids.values(), default=-1))
        for token, i in ids.items():
            tokens[i] = token
        rules = merges.orderBy("rank").collect()
        return cls(tokens, [(ids[r.left], ids[r.right], ids[r.left + r.right]) for r in rules], literals)


def word_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Every pre-tokenised word and how often it occurs. Lines keep their newline, as in a line-wise file read."""
    line = F.explode(F.split(F.col(text), "(?<=\n)")).alias("line")
    word = F.explode(words("line")).alias("word")
    return df.select(line).select(word).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def learn_merges(
    counts: DataFrame, vocab_size: int = alphabet.BYTE_VOCAB_SIZE, min_frequency: int = 1
) -> Vocabulary:
    """T4: learn byte-pair merges from ``word_counts``: most frequent pair first, ties to the lowest id pair.

    The distinct words (as ids) and the totals of all pairs are written tables. A pass applies the merges learnt since then
    to the words they touch, adds what that changes to the totals, and brings back the best few hundred pairs. From that
    list all merges that cannot influence each other are taken at once, so the result is the one-by-one result in far fewer
    passes. After ``REWRITE`` merges both tables are written anew and the superseded ones deleted, so a pass costs the same
    however many merges there are.
    """
    vocabulary = Vocabulary()
    if vocab_size <= len(vocabulary.tokens):
        return vocabulary
    source = counts.select(F.col("word").cast("binary").alias("word"), F.col("n").cast("long").alias("n"))
    words_ = written(source.mapInArrow(kernels.word_ids(alphabet.byte_ids()), WORD_IDS))
    totals = written(words_.mapInArrow(kernels.pair_counter(), PAIRS).groupBy("left_id", "right_id").agg(F.sum("n").alias("n")))
    known = {t: i for i, t in enumerate(vocabulary.tokens)}
    base = 0
    while len(vocabulary.tokens) < vocab_size:
        fresh = len(vocabulary.merges) - base
        ranked = best_pairs(words_, totals, rules(vocabulary, base), min_frequency)
        if not ranked:
            break
        if fresh and (fresh >= REWRITE or not take_independent(ranked, vocabulary, known, vocab_size, after=fresh)):
            words_, totals = rewritten(words_, totals, rules(vocabulary, base))
            base = len(vocabulary.merges)
            fresh = 0
        if not fresh:
            take_independent(ranked, vocabulary, known, vocab_size)
    discard(words_)
    discard(totals)
    return vocabulary


def rules(vocabulary: Vocabulary, since: int) -> kernels.Merges:
    """The merges from number ``since`` on, in look-up form."""
    some = vocabulary.merges[since:]
    return kernels.Merges([(a, b) for a, b, _ in some], [m for _, _, m in some], len(vocabulary.tokens))


def changed_totals(words_: DataFrame, totals: DataFrame, merges: kernels.Merges) -> DataFrame:
    if not len(merges.keys):
        return totals
    changes = words_.mapInArrow(kernels.pair_changes(merges), PAIRS)
    return totals.union(changes).groupBy("left_id", "right_id").agg(F.sum("n").alias("n"))


def best_pairs(words_: DataFrame, totals: DataFrame, merges: kernels.Merges, min_frequency: int) -> list:
    enough = changed_totals(words_, totals, merges).where(F.col("n") >= max(1, min_frequency))
    return enough.orderBy(F.desc("n"), "left_id", "right_id").limit(CANDIDATES).collect()


def rewritten(words_: DataFrame, totals: DataFrame, merges: kernels.Merges) -> tuple[DataFrame, DataFrame]:
    """Both tables with the merges applied; the old ones go once the new ones are written."""
    new = written(words_.mapInArrow(kernels.merged_words(merges), WORD_IDS)), written(changed_totals(words_, totals, merges).where("n > 0"))
    discard(words_)
    discard(totals)
    return new


def take_independent(ranked: list, vocabulary: Vocabulary, known: dict[str, int], vocab_size: int, after: int = 0) -> int:
    """Take merges from the ranked list for as long as earlier ones leave the next one's rank alone; returns how many.

    Merging (a, b) changes only pairs that end in a or start with b. A new pair made by it holds a fresh, highest id
    and is no more frequent than the pair it replaces, so it cannot overtake a listed pair. The list ends at the
    first changed pair, after a pair of equal ids, and after a merge whose text is already a token. Such a merge makes an
    old id, to which a merge waiting to be written (``after`` of them) could apply, so none may wait when it is taken.
    """
    lefts, rights, taken = set(), set(), 0
    for left, right, _ in ranked:
        if right in lefts or left in rights or len(vocabulary.tokens) >= vocab_size:
            return taken
        text = vocabulary.tokens[left] + vocabulary.tokens[right]
        fresh = text not in known
        if not fresh and after + taken:
            return taken
        if fresh:
            known[text] = len(vocabulary.tokens)
            vocabulary.tokens.append(text)
        vocabulary.merges.append((left, right, known[text]))
        taken += 1
        if left == right or not fresh:
            return taken
        lefts.add(left)
        rights.add(right)
    return taken
