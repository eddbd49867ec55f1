"""Filters over rows of merged contexts against the same filters over flat candidates, and their size."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tokenloom.functions import decoding, sampling

N_IDS = 12


def model_table(draw, grams):
    rows = []
    for g in range(1, grams + 1):
        contexts = range(N_IDS ** (g - 1)) if g < 3 else draw.sample(range(N_IDS ** (g - 1)), 60)
        for ctx in contexts:
            ids = sorted(draw.sample(range(1, N_IDS), draw.choice([1, 3, 9])))
            rows.append((g, ctx, ids, [draw.choice([0.05, 0.1, 0.1, 0.4]) for _ in ids]))
    kinds = [("gram", pa.int32()), ("ctx", pa.int64()), ("ids", pa.list_(pa.int32())), ("shares", pa.list_(pa.float64()))]
    return pa.Table.from_pylist([dict(zip([k for k, _ in kinds], r)) for r in rows], pa.schema(kinds))


def one_after_the_other(table, prompts, names, options, grams):
    """Final histories by the flat filters, one step of all prompts after the other."""
    model = [decoding.Contexts(table.filter(pa.compute.equal(table["gram"], g))) for g in range(grams, 0, -1)]
    state = {n: list(p) for n, p in zip(names, prompts)}
    going = list(names)
    for step in range(options.max_new_tokens):
        if not going:
            break
        offsets = np.cumsum([0, *(len(state[n]) for n in going)])
        held = decoding.Prompts.of(offsets, np.array([i for n in going for i in state[n]], np.int64), N_IDS, 1)
        levels = [m.of(held.context(grams - k, N_IDS)) for k, m in enumerate(model)]
        new = decoding.next_ids(levels, held, options, np.array(going), np.full(len(going), step))
        for n, i in zip(going, new.tolist()):
            if i not in (-1, sampling.EOS_ID):
                state[n].append(i)
        going = [n for n, i in zip(going, new.tolist()) if i not in (-1, sampling.EOS_ID)]
    return state


@pytest.mark.parametrize("kept", [1 << 22, 40])
@pytest.mark.parametrize(
    "options",
    [
        sampling.Options(max_new_tokens=25),
        sampling.Options(max_new_tokens=25, top_k=3, no_repeat_ngram_size=2),
        sampling.Options(max_new_tokens=25, top_p=1.0, no_repeat_ngram_size=1, repetition_penalty=1.0),
        sampling.Options(max_new_tokens=25, do_sample=False, no_repeat_ngram_size=3),
    ],
)
def test_merged_contexts_give_the_same_continuations(monkeypatch, options, kept):
    monkeypatch.setattr(decoding, "KEPT_CELLS", kept)
    monkeypatch.setattr(decoding, "CELLS", 700)
    draw, grams = random.Random(5), 3
    table = model_table(draw, grams)
    prompts = [[draw.randrange(2, N_IDS) for _ in range(draw.choice([0, 1, 2, 7, 30]))] for _ in range(120)]
    names = list(range(7, 7 + len(prompts)))
    start = pa.table({"prompt_id": pa.array(names, pa.int64()), "history": pa.array(prompts, pa.list_(pa.int32()))})
    got = decoding.all_steps(options, grams, N_IDS)(start, table).to_pylist()
    want = one_after_the_other(table, prompts, names, options, grams)
    assert {r["prompt_id"]: r["history"] for r in got} == want
    assert all(r["n_new"] == len(r["history"]) - len(p) for r, p in ((r, prompts[r["prompt_id"] - 7]) for r in got))


def test_levels_of_a_context_are_merged_once(monkeypatch):
    """Merging them for every prompt in every step took most of the time."""
    merged = []
    whole = decoding.merge_levels
    monkeypatch.setattr(decoding, "merge_levels", lambda levels, n: merged.append(n) or whole(levels, n))
    draw = random.Random(6)
    table = model_table(draw, 2)
    start = pa.table({"prompt_id": pa.array(range(500), pa.int64()), "history": pa.array([[2, 3]] * 500, pa.list_(pa.int32()))})
    decoding.all_steps(sampling.Options(max_new_tokens=30), 2, N_IDS)(start, table)
    assert sum(merged) <= N_IDS


def test_memory_of_a_step_follows_the_portion():
    n, n_ids = 20_000, 258
    lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * 90), pa.array(np.tile(np.arange(90, dtype=np.int32), n)))
    shares = pa.ListArray.from_arrays(lists.offsets, pa.array(np.full(n * 90, 1 / 90)))
    batch = pa.record_batch({"prompt_id": pa.array(range(n), pa.int64()), "history": lists, "ids1": lists, "shares1": shares})
    tracemalloc.start()
    try:
        for _ in decoding.stage_rows(sampling.Options(top_k=40), 1, "top_k", n_ids)([batch]):
            pass
        assert tracemalloc.get_traced_memory()[1] < 120e6
    finally:
        tracemalloc.stop()
