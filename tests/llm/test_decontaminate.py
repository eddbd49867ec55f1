"""Recall of the passage search at the limit for items of all lengths, short items exactly, and the edit distance."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.helpers import documents, words
from tokenloom.llm import decontaminate
from tokenloom.llm.common import slices


def edited(draw, body, edits, mixed):
    """Exactly at the limit by replaced words; an inserted or deleted word costs two in a window of the item's length."""
    body = list(body)
    if not mixed:
        for at in draw.sample(range(len(body)), edits):
            body[at] = f"zz{draw.randrange(9999)}"
        return body
    for _ in range(edits // 2):
        at = draw.randrange(len(body))
        kind = draw.randrange(3)
        body[at : at + (kind != 1)] = [] if kind == 2 else [f"zz{draw.randrange(9999)}"]
    return body


@pytest.mark.parametrize("mixed", [False, True])
@pytest.mark.parametrize("size", [5, 10, 20, 40, 100, 300, 1000])
def test_recall_at_the_limit(size, mixed):
    draw = random.Random(size)
    number = 100 if size <= 300 else 40
    items = [[f"w{draw.randrange(2000)}" for _ in range(size)] for _ in range(number)]
    block = decontaminate.Items(list(range(number)), [" ".join(i) for i in items], decontaminate.PERCENT)
    around = lambda: [f"w{draw.randrange(2000)}" for _ in range(30)]
    texts = [" ".join(around() + edited(draw, i, size // 5, mixed) + around()) for i in items]
    got = set()
    for part in slices(pa.array(texts, pa.large_string())):
        row, item, _, far = block.search(part)
        assert (far <= size // 5).all()
        got |= set(zip((row + part.first).tolist(), item.tolist()))
    assert sum((i, i) in got for i in range(number)) >= 0.9 * number


def test_bits_are_drawn_once_for_each_walk(monkeypatch):
    """They were drawn anew for every step and length class."""
    draw = random.Random(5)
    items = [" ".join(f"w{draw.randrange(50)}" for _ in range(n)) for n in (10, 12, 15, 20, 30, 60)]
    block = decontaminate.Items(list(range(len(items))), items, decontaminate.PERCENT)
    drawn, one = [], decontaminate.mix
    monkeypatch.setattr(decontaminate, "mix", lambda x, seed=0: drawn.append(seed) or one(x, seed))
    (part,) = slices(pa.array([" ".join(items)], pa.large_string()))
    row, item, start, far = block.search(part)
    begins = np.r_[0, np.cumsum([len(i.split()) for i in items])[:-1]].tolist()
    assert {(i, begins[i], 0) for i in range(len(items))} <= set(zip(item.tolist(), start.tolist(), far.tolist()))
    steps = [seed for seed in drawn if seed >= 9000]
    assert len(steps) == len(set(steps)) <= decontaminate.REPETITIONS


def far_from(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_short_items_are_found_exactly(spark):
    draw = random.Random(8)
    letters = "a b c d".split()
    items = [(i, " ".join(draw.choice(letters) for _ in range(1 + i % 7))) for i in range(40)]
    docs = [(i, " ".join(draw.choice([*letters, "x"]) for _ in range(draw.randrange(12)))) for i in range(60)]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.distance, r.start_word) for r in decontaminate.findings(documents(spark, docs), table).collect()}
    want = {}
    for i, text in docs:
        has = words(text)
        for item, body in items:
            need = words(body)
            found = min(((far_from(need, has[s : s + len(need)]), s) for s in range(len(has))), default=None)
            if found and found[0] <= len(need) // 5:
                want[i, item] = found
    assert got == want


def test_distances_in_portions(monkeypatch):
    draw = np.random.default_rng(4)
    a, b = draw.integers(0, 3, 400).astype(np.uint64), draw.integers(0, 3, 400).astype(np.uint64)
    a_size, b_size = draw.integers(0, 30, 50), draw.integers(0, 30, 50)
    a_at, b_at = draw.integers(0, 370, 50), draw.integers(0, 370, 50)
    want = [far_from(a[x : x + m].tolist(), b[y : y + n].tolist()) for x, m, y, n in zip(a_at, a_size, b_at, b_size)]
    for cells in (1, 100, 1 << 21):
        monkeypatch.setattr(decontaminate, "CELLS", cells)
        assert decontaminate.distances(a, a_at, a_size, b, b_at, b_size).tolist() == want


def test_very_long_items(spark):
    draw = random.Random(1)
    body = [f"w{draw.randrange(5000)}" for _ in range(4000)]
    changed = edited(draw, body, 300, False)
    table = spark.createDataFrame([(1, " ".join(body))], "item_id long, text string")
    docs = documents(spark, [(1, " ".join(["x"] * 50 + changed)), (2, " ".join(body[::-1]))])
    assert [(r.doc_id, r.start_word, r.distance) for r in decontaminate.findings(docs, table).collect()] == [(1, 50, len([1 for x, y in zip(body, changed) if x != y]))]
