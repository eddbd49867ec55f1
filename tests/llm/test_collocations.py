"""Phrase collocations against counting in one dictionary, with tries that burst and spill at every turn."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.helpers import ODD, documents, lower
from tokenloom.llm import collocations, queries

SMALL = "/root/testdata/sf0.001"


def phrases(rows, least, top):
    """rows: (lang, text)."""
    f, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text)):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            total[lang] += len(words)
            for k in (1, 2, 3):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, n in f.items():
        candidates = {p: a for p, a in n.items() if len(p) > 1 and a >= least}
        ranked = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * b >= 50 * a and p in (q[:2], q[1:]) for q, b in candidates.items()):
                continue
            score, k = min((1_000_000 * a * a // (n[p[:k]] * n[p[k:]]), k) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), n[p[:k]], n[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(ranked)[:top]):
            out.append((lang, rank + 1, p.decode(), -a, left, right, total[lang], -score))
    return Counter(out)


def some_texts(seed, number):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["The", "ÉTÉ", "été", "a\xa0b", "x" * 300]
    ends = [" ", " ", " ", " ", "  \t", ". ", ", ", "\n", "\r\n", "\x0b", "!"]
    return [("".join(draw.choice(words) + draw.choice(ends) for _ in range(draw.randrange(60)))) for _ in range(number)]


@pytest.mark.parametrize("burst, budget, words, held", [(32_768, 1_000_000, 500_000, 2_000_000), (8, 100, 500_000, 50), (20, 400, 10, 10)])
def test_phrases_equal_counting_in_one_dictionary(spark, monkeypatch, burst, budget, words, held):
    for name, value in (("BURST", burst), ("BUDGET", budget), ("WORDS", words), ("HELD", held), ("SLICE_BYTES", 2000)):
        monkeypatch.setattr(collocations, name, value)
    texts = some_texts(burst, 80) + [None, ""]
    rows = [(("en", "de", None)[i % 3], t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(lang, t, i, 1) for i, (lang, t) in enumerate(rows)], "lang string, text string, phrase int, n int").repartition(3)
    got = Counter(tuple(r) for r in collocations.mine(docs, least=3, top=40).collect())
    assert got == phrases(rows, 3, 40)


def test_odd_texts(spark):
    rows = [*ODD, (12, "a b c " * 30), (13, "a b. c " * 30), (14, "x y\x00z " * 12)]
    got = Counter(tuple(r) for r in collocations.mine(documents(spark, rows)).collect())
    assert got == phrases([("en", t) for _, t in rows], 10, 2000)
    assert collocations.mine(documents(spark, [])).collect() == []
    assert collocations.mine(documents(spark, [(1, None)])).collect() == []


def test_scores_past_64_bits(spark):
    big = 4_000_000_000_000
    table = [("en", "a", 1, big), ("en", "b", 1, big + 1), ("en", "a b", 2, big - 1), ("en", "b a", 2, 10)]
    got = {r.phrase: r.score for r in collocations.scored(spark.createDataFrame(table, collocations.COUNTS)).collect()}
    assert got == {"a b": 1_000_000 * (big - 1) ** 2 // (big * (big + 1)), "b a": 0}


def test_containers_count(spark):
    draw = np.random.default_rng(2)
    table, want = collocations.Container(), Counter()
    for _ in range(30):
        keys, counts = np.unique(draw.integers(1, 3000, 500).astype(np.uint64), return_counts=True)
        table.add(keys, counts)
        want.update(dict(zip(keys.tolist(), counts.tolist())))
    keys, counts = table.entries()
    assert dict(zip(keys.tolist(), counts.tolist())) == want and table.size == len(want)


def test_words_are_numbered_exactly():
    counter = collocations.Counter(8)
    import pyarrow as pa

    first = counter.number(pa.array([b"a", b"b", b"a"], pa.binary()))
    second = counter.number(pa.array([b"c", b"b"], pa.binary()))
    assert first.tolist() == [1, 2, 1] and second.tolist() == [3, 2]
    assert len(counter.hashes) == 4


def test_query_against_brute_force(spark):
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("lang", "text").collect()]
    assert Counter(tuple(r) for r in queries.op13_collocations(spark, SMALL).collect()) == phrases(rows, 10, 2000)
