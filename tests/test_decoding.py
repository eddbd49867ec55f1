"""The filters over whole batches against the same filters for one prompt."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenloom.functions import alphabet, decoding, sampling
from tokenloom.operators import encode, generate, ngram, vocab

N_IDS = 40


def lists(rows, kind):
    return np.cumsum([0, *map(len, rows)]), np.array([x for r in rows for x in r], kind)


def one_by_one(levels, history, options, upto):
    ids, scores = sampling.merge_levels(levels)
    apply = {
        "penalty": lambda: sampling.penalise(ids, scores, history, options.repetition_penalty),
        "no_repeat": lambda: sampling.ban_repeats(ids, scores, history, options.no_repeat_ngram_size),
        "temperature": lambda: sampling.as_probabilities(ids, scores, options.temperature),
        "top_k": lambda: sampling.keep_top_k(ids, scores, options.top_k),
        "top_p": lambda: sampling.keep_top_p(ids, scores, options.top_p),
    }
    for name in sampling.STAGES[1 : sampling.STAGES.index(upto) + 1]:
        ids, scores = apply[name]()
    return ids, scores


@pytest.mark.parametrize("cells", [1 << 24, 90])
@pytest.mark.parametrize("options", [sampling.Options(top_k=5, no_repeat_ngram_size=2), sampling.Options(temperature=0, no_repeat_ngram_size=1), sampling.Options(top_p=0.3)])
def test_batches_equal_single_prompts(monkeypatch, options, cells):
    monkeypatch.setattr(decoding, "CELLS", cells)
    draw = random.Random(3)
    histories = [[draw.randrange(6) for _ in range(draw.choice([0, 1, 2, 5, 30]))] for _ in range(50)]
    levels = []
    for _ in range(3):
        rows = [draw.sample(range(N_IDS), draw.choice([0, 0, 1, 7, 20])) for _ in histories]
        levels.append((rows, [[draw.choice([0.1, 0.2, 0.5]) for _ in r] for r in rows]))
    offsets, items = lists(histories, np.int64)
    flat = [(*lists(ids, np.int64), lists(shares, float)[1]) for ids, shares in levels]
    for upto in sampling.STAGES:
        got = []
        for low, high in decoding.portions(offsets, N_IDS):
            own, ids = decoding.cut_lists((offsets, items), low, high)
            prompts = decoding.Prompts.of(own, ids, N_IDS, 0)
            c = decoding.filtered([decoding.cut_lists(x, low, high) for x in flat], prompts, options, upto)
            got += [(r + low, i, round(s, 12)) for r, i, s in zip(c.row.tolist(), c.ids.tolist(), c.scores.tolist())]
        want = []
        for n, history in enumerate(histories):
            mine = [(np.array(ids[n], np.int64), np.array(shares[n], float)) for ids, shares in levels]
            found = one_by_one(mine, np.array(history, np.int64), options, upto)
            want += [(n, int(i), round(float(s), 12)) for i, s in zip(*found)]
        assert sorted(got) == sorted(want), upto
    c = decoding.filtered(flat, decoding.Prompts.of(offsets, items, N_IDS, 0), options)
    u = np.array([draw.random() for _ in histories])
    drawn = decoding.draw(c, u)
    for n in range(len(histories)):
        mine = c.row == n
        assert drawn[n] == sampling.draw(c.ids[mine], c.scores[mine], u[n])


def test_contexts_of_prompts():
    prompts = decoding.Prompts.of(np.array([0, 0, 1, 4]), np.array([7, 1, 2, 3]), 10, 2)
    assert prompts.context(1, 10).tolist() == [0, 0, 0]
    assert prompts.context(2, 10).tolist() == [-1, 7, 3]
    assert prompts.context(3, 10).tolist() == [-1, -1, 23]
    prompts.append(np.array([1]), np.array([5]))
    assert prompts.context(3, 10).tolist() == [-1, 75, 23] and prompts.seen[1, 5]


def test_generation_over_a_merged_vocabulary(spark):
    text = "the cat sat on the mat, the cat ran to the hall. "
    lines = spark.createDataFrame([(text * 3,), (text[::-1],)], "text string")
    learnt = vocab.learn_merges(vocab.word_counts(lines), 300)
    n_ids = len(learnt.tokens)
    coded = encode.bpe(lines, learnt).select("input_ids")
    model = generate.written_model(ngram.counts(coded, (1, 2, 3), n_ids=n_ids), 3, n_ids, learnt.role_id("eos"))
    start = generate.prompts(spark.createDataFrame([(1, "the cat"), (2, "<|endoftext|>"), (3, None)], "k long, text string"), F.col("k"), vocabulary=learnt)
    options = generate.Options(max_new_tokens=6)
    rows = {r.prompt_id: r for r in generate.run(start, model, options, vocabulary=learnt).collect()}
    assert sorted(rows) == [1, 2] and rows[1].generated_text.startswith("the cat") and rows[1].n_new > 0
    assert learnt.specials[alphabet.EOS] == rows[2].history[0]
    large = generate.Model(model.tables, {1: False, 2: False, 3: False}, n_ids, model.eos_id)
    assert {r.prompt_id: r.history for r in generate.run(start, large, options, vocabulary=learnt).collect()} == {i: r.history for i, r in rows.items()}
