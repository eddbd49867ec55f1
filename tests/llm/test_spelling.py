"""Spelling variants against a search through deletions, block by block and whole."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import ODD, documents, lower
from tokenloom.llm import queries, spelling

SMALL = "/root/testdata/sf0.001"


def variants(counted, ratio=10):
    gaps, near = defaultdict(set), defaultdict(set)
    for w in counted:
        for k in range(len(w)):
            gap = w[:k] + w[k + 1 :]
            gaps[k, gap].add(w)
            if gap in counted:
                near[w].add(gap)
                near[gap].add(w)
    for same in gaps.values():
        for w in same:
            near[w] |= same - {w}
    form = {}
    for w in counted:
        best = min(near[w], key=lambda x: (-counted[x], x), default=None)
        if best and counted[best] >= ratio * counted[w]:
            form[w] = best
    out = []
    for w, n in counted.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), counted[form[w]] if w in form else None))
    return Counter(out)


def found(spark, counted, **options):
    table = spark.createDataFrame(list(counted.items()), "word string, n long")
    return Counter(tuple(r) for r in spelling.group(table, **options).collect())


def edited(draw, word, letters):
    k = draw.randrange(len(word) + 1)
    return draw.choice([word[:k] + word[k + 1 :], word[:k] + draw.choice(letters) + word[k:], word[:k] + draw.choice(letters) + word[k + 1 :]])


@pytest.mark.parametrize("parts, portion", [(4, 2048), (4, 7), (6, 16), (9, 2048)])
def test_groups_equal_a_search_through_deletions(spark, monkeypatch, parts, portion):
    monkeypatch.setattr(spelling, "PORTION", portion)
    draw = random.Random(parts)
    letters = "abcéÀßz"
    counted = {}
    for _ in range(60):
        word = "".join(draw.choice(letters) for _ in range(draw.randrange(1, 9)))
        for _ in range(8):
            counted[word] = 10 ** draw.randrange(6) + draw.randrange(3)
            word = edited(draw, word, letters) or "a"
    assert found(spark, counted, parts=parts) == variants(counted)


def test_letters_that_share_a_column(spark):
    # Code points equal modulo the number of columns look alike to the counts, not to the edits.
    other = chr(ord("a") + 191 * 2)
    counted = {"aaaaaaab": 100, f"aaaaaaa{other}": 5, "aaaaaaaa": 7, f"{other}aaaaaaa": 3, "你好你好你好你": 50, "你好你好你好": 4}
    assert found(spark, counted) == variants(counted)


def test_chains_are_followed_to_the_last_form(spark):
    counted = {"aaaaaaa": 1, "aaaaaab": 10, "aaaaabb": 100, "aaaabbb": 1000, "aaabbbb": 10_000, "zzzzzzz": 5}
    roots = {r[0]: r[2] for r in found(spark, counted)}
    assert set(roots.values()) == {"aaabbbb", "zzzzzzz"}
    assert found(spark, counted) == variants(counted)


def test_very_long_words(spark):
    counted = {"x" * 70_000: 30, "x" * 70_001: 2, "y" + "x" * 69_999: 3, "short": 9, "": 1}
    assert found(spark, counted) == variants(counted)


def test_words_of_odd_texts(spark):
    docs = documents(spark, [*ODD, (11, "Naïvetés naïvetés ÉCLAIRS éclairs abc-defghij_klmnopq×uvw")])
    want = Counter((i, r) for i, t in [*ODD, (11, "Naïvetés naïvetés ÉCLAIRS éclairs abc-defghij_klmnopq×uvw")] for r in re.findall("[A-Za-zÀ-ÿ]{7,}", t or "") for r in [lower(r)])
    assert Counter(tuple(r) for r in spelling.runs(docs).collect()) == want
    assert spelling.group(spelling.counts(F.col("run"), spelling.runs(documents(spark, [])))).collect() == []


def test_edits_one_by_one():
    words = ["abc", "abd", "ab", "abcd", "xabc", "cba", "abc", "", "a", "aab", "aabc"]
    codes, sizes = spelling.letter_codes(words)
    starts = np.cumsum(sizes) - sizes
    for i, x in enumerate(words):
        for j, y in enumerate(words):
            if 0 <= len(y) - len(x) <= 1:
                same = len(x) == len(y) and sum(a != b for a, b in zip(x, y)) == 1
                longer = len(y) == len(x) + 1 and any(y[:k] + y[k + 1 :] == x for k in range(len(y)))
                assert spelling.one_edit(codes, starts, sizes, np.array([i]), np.array([j]))[0] == (same or longer), (x, y)


def test_query_against_brute_force(spark):
    counted = Counter()
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            word = lower(run)
            check = zlib.crc32(f"{r.doc_id}:{word}".encode())
            if check % 31 == 0:
                k = check % len(word)
                word = word[:k] + word[k + 1 :]
            counted[word] += 1
    counted = {w: n for w, n in counted.items() if len(w) >= 7 and n >= 2}
    assert Counter(tuple(r) for r in queries.op11_spelling(spark, SMALL).collect()) == variants(counted)
