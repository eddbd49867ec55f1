import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenloom.functions import kernels, sampling
from tokenloom.operators import batches, generate, ngram
from tokenloom.operators.lookup import left_lookup
from tokenloom.session import cut

ROWS = [[5, 6, 7, 5, 6, 7, 5, 6, 8, 1], [5, 6, 9, 9, 9, 9, 1], [7], [], [2, 5, 6, 7, 1]]


def id_rows(spark, rows=ROWS):
    return spark.createDataFrame(list(enumerate(rows)), "doc_id int, input_ids array<int>")


def gram_counter(rows, n):
    return Counter(tuple(r[i : i + n]) for r in rows for i in range(len(r) - n + 1))


def test_counts_equal_brute_force(spark):
    got = ngram.counts(id_rows(spark), (1, 2, 3), n_ids=10).collect()
    for n in (1, 2, 3):
        wanted = {(int("".join(map(str, g[:-1])) or 0), g[-1]): c for g, c in gram_counter(ROWS, n).items()}
        assert {(r.ctx, r.nxt): r.n for r in got if r.gram == n} == wanted
    with pytest.raises(ValueError):
        ngram.counts(id_rows(spark), (5,), n_ids=50_257)


def test_large_key_space_and_groups(spark):
    got = ngram.counts(id_rows(spark), (4,), F.col("doc_id"), n_ids=50_000).collect()
    wanted = Counter((d, *r[i : i + 4]) for d, r in enumerate(ROWS) for i in range(len(r) - 3))
    found = {}
    for r in got:
        a, rest = divmod(r.ctx, 50_000**2)
        found[r.key, a, *divmod(rest, 50_000), r.nxt] = r.n
    assert found == wanted


def test_wide_contexts_equal_brute_force(spark, monkeypatch):
    rows = [[50_000, 3, 50_000, 3, 50_000, 3, 2**31 - 1, 7], [3, 50_000] * 5, [], [9]]
    monkeypatch.setattr(kernels.row_slices, "__defaults__", (4,))
    for by in (None, F.col("doc_id")):
        got = ngram.wide_counts(id_rows(spark, rows), (1, 2, 6), by).collect()
        wanted = Counter()
        for d, r in enumerate(rows):
            for n in (1, 2, 6):
                wanted.update((d if by is not None else None, n, tuple(r[i : i + n])) for i in range(len(r) - n + 1))
        found = Counter()
        for r in got:
            ctx = np.frombuffer(bytes(r.ctx), ">u4").tolist()
            found[r.key if by is not None else None, r.gram, (*ctx, r.nxt)] += r.n
        assert found == wanted


def test_wide_and_narrow_contexts_give_one_model(spark):
    narrow, wide = ngram.counts(id_rows(spark), (1, 2, 3), n_ids=258), ngram.wide_counts(id_rows(spark), (1, 2, 3))
    key = lambda df: sorted((r.gram, r.nxt, r.n, round(r.p, 9)) for r in ngram.probabilities(df).collect())
    assert key(narrow) == key(wide)
    prompts = spark.createDataFrame([(1, [5, 6]), (2, []), (3, [9])], "prompt_id long, history array<int>")
    options = generate.Options(max_new_tokens=4)
    texts = [{r.prompt_id: r.history for r in generate.run(prompts, generate.written_model(m, 3), options).collect()} for m in (narrow, wide)]
    assert texts[0] == texts[1]


def test_loss_by_hand(spark):
    train, test = ROWS[:2], ROWS[4:]
    rows = [("train", r) for r in train] + [("test", r) for r in test]
    df = spark.createDataFrame(rows, "split string, input_ids array<int>")
    out = ngram.evaluate(ngram.counts(df, (2,), F.col("split"), n_ids=10), n_ids=10).first()
    pairs, contexts = gram_counter(train, 2), Counter()
    for (a, _), c in pairs.items():
        contexts[a] += c
    total = sum(-c * math.log((pairs[g] + 0.01) / (contexts[g[0]] + 0.1)) for g, c in gram_counter(test, 2).items())
    assert out.n_pairs == 4 and out.loss == pytest.approx(total / 4)


def test_smoothed_probabilities_sum_to_one(spark):
    model = ngram.probabilities(ngram.counts(id_rows(spark), (2,), n_ids=10), n_ids=10)
    per = model.groupBy("ctx").agg(F.sum("p").alias("p"), F.count("p").alias("k"), F.first("ctx_n").alias("t")).collect()
    assert all(r.p + (10 - r.k) * 0.01 / (r.t + 0.1) == pytest.approx(1) for r in per)


def test_scores_agree_with_broadcast_and_salted_joins(spark, monkeypatch):
    docs = ngram.counts(id_rows(spark), (2,), F.col("doc_id"), n_ids=10)
    model = cut(ngram.counts(id_rows(spark, ROWS[:2]), (2,), n_ids=10))
    small = sorted(ngram.score(docs, model, n_ids=10).collect())
    monkeypatch.setattr(ngram, "is_small", lambda table: False)
    assert [r[:2] for r in sorted(ngram.score(docs, model, n_ids=10).collect())] == [r[:2] for r in small]


def test_salted_lookup_keeps_every_row_of_a_hot_key(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(1).alias("k"))
    table = spark.createDataFrame([(1, "one"), (3, "three")], "k long, v string")
    rows = left_lookup(df, table, ["k"], ["id"], small=False).collect()
    assert len(rows) == 5000
    assert Counter(r.v for r in rows) == left_lookup(df, table, ["k"], ["id"], small=True).groupBy("v").count().rdd.map(tuple).collectAsMap()


def arrays(pairs):
    return np.array([i for i, _ in pairs], np.int64), np.array([s for _, s in pairs], float)


def test_filters_by_hand():
    ids, scores = arrays([(1, math.log(0.4)), (2, math.log(0.2)), (3, math.log(0.2)), (4, math.log(0.15)), (5, math.log(0.05))])
    _, shrunk = sampling.penalise(ids, np.array([-1.0, 2.0, -3.0, -4.0, 0.5]), np.array([1, 2]), 2.0)
    assert shrunk.tolist() == [-2.0, 1.0, -3.0, -4.0, 0.5]
    history = np.array([1, 2, 3, 4, 9, 1, 2, 3])
    assert sampling.ban_repeats(ids, scores, history, 4)[0].tolist() == [1, 2, 3, 5]
    assert sampling.ban_repeats(ids, scores, history[:3], 4)[0].tolist() == [1, 2, 3, 4, 5]
    ranked, shares = sampling.as_probabilities(ids[::-1], scores[::-1], 1.0)
    assert ranked.tolist() == [1, 2, 3, 4, 5] and shares == pytest.approx([0.4, 0.2, 0.2, 0.15, 0.05])
    assert sampling.as_probabilities(ids, scores, 0)[0].tolist() == [1]
    assert sampling.keep_top_k(ranked, shares, 3)[0].tolist() == [1, 2, 3]
    assert sampling.keep_top_k(ranked, shares, 0)[0].tolist() == [1, 2, 3, 4, 5]
    assert sampling.keep_top_p(ranked, shares, 0.39)[0].tolist() == [1]
    assert sampling.keep_top_p(ranked, shares, 0.41)[0].tolist() == [1, 2]
    assert [sampling.draw(ranked, shares, u) for u in (0, 0.41, 0.61, 0.79, 0.81, 0.9999)] == [1, 2, 3, 3, 4, 5]
    assert sampling.draw(ranked[:0], shares[:0], 0.5) == -1


def model_of(spark, rows, n=3):
    return generate.written_model(ngram.counts(id_rows(spark, rows), tuple(range(1, n + 1)), n_ids=258), n)


def test_generation_paths_agree_and_follow_brute_force(spark):
    text = b"the cat sat on the mat. the dog sat on the log. a cat and a dog ran to the hall"
    rows = [[c for c in text], [c for c in text[::-1]]]
    model = model_of(spark, rows)
    starts = [(7, [116, 104, 101]), (8, []), (9, [200]), (10, [99, 97])]
    prompts = spark.createDataFrame(starts, "prompt_id long, history array<int>")
    options = generate.Options(max_new_tokens=12)
    whole = {r.prompt_id: r.history for r in generate.run(prompts, model, options).collect()}
    large = generate.Model(model.tables, {1: True, 2: False, 3: False}, 258)
    stepped = {r.prompt_id: r.history for r in generate.run(prompts, large, options, cut_every=5).collect()}
    assert whole == stepped

    grams = {n: gram_counter(rows, n) for n in (1, 2, 3)}
    for prompt_id, start in starts:
        history = list(start)
        for step in range(options.max_new_tokens):
            scores = {}
            for n in (1, 2, 3):
                if len(history) < n - 1:
                    continue
                ctx = tuple(history[len(history) - n + 1 :]) if n > 1 else ()
                seen = {g[-1]: c for g, c in grams[n].items() if g[:-1] == ctx}
                scores |= {i: math.log(c / sum(seen.values()) * 0.4 ** (3 - n)) for i, c in seen.items()}
            scores = {i: s * 1.1 if i in history else s for i, s in scores.items()}
            fours = {tuple(history[i : i + 4]) for i in range(len(history) - 3)}
            scores = {i: s for i, s in scores.items() if (*history[-3:], i) not in fours}
            top = max(scores.values())
            shares = {i: math.exp((s - top) / 0.7) for i, s in scores.items()}
            mass = sum(shares.values())
            kept, before = [], 0.0
            for i, s in sorted(shares.items(), key=lambda e: (-e[1], e[0])):
                if before < 0.9:
                    kept.append((i, s / mass))
                before += s / mass
            goal, upto = sampling.uniform(42, prompt_id, step) * sum(s for _, s in kept), 0.0
            for i, s in kept:
                upto += s
                if upto > goal:
                    history.append(i)
                    break
        assert whole[prompt_id] == history


def test_generation_stops_at_end_of_text(spark):
    model = model_of(spark, [[10, 11, 1], [20, 21, 22, 1]])
    prompts = spark.createDataFrame([(1, [10, 11])], "prompt_id long, history array<int>")
    row = generate.run(prompts, model, generate.Options(do_sample=False)).first()
    assert (row.history, row.n_new) == ([10, 11], 0)


def test_every_epoch_visits_every_block_once(spark):
    plan = batches.Plan(epochs=3, micro=8, accum=4, log_every=10, eval_every=200, save_every=200)
    out = batches.manifest(spark.range(77).withColumnRenamed("id", "block_no"), ["block_no"], plan).collect()
    orders = []
    for epoch in range(3):
        mine = sorted((r for r in out if r.epoch == epoch), key=lambda r: r.place)
        assert sorted(r.block_no for r in mine) == list(range(77))
        assert Counter(r.step for r in mine) == {0: 32, 1: 32, 2: 13}
        assert max(r.micro_batch for r in mine) == 9
        orders.append([r.block_no for r in mine])
    assert orders[0] != orders[1] != orders[2]
    assert plan.steps(77) == 9


def test_schedule(spark):
    plan = batches.Plan(epochs=1, micro=1, accum=1, log_every=10, eval_every=20, save_every=50, log_first=True)
    rows = batches.schedule(spark, 100, plan).orderBy("step").collect()
    assert len(rows) == 100 and rows[0].rate == 0
    assert rows[10].rate == pytest.approx(3e-4) and rows[5].rate == pytest.approx(1.5e-4)
    assert rows[55].rate == pytest.approx(3e-4 * 0.5 * (1 + math.cos(math.pi * 0.5)))
    assert [r.step for r in rows if r.logs][:3] == [1, 10, 20]
    assert [r.step for r in rows if r.evaluates] == [20, 40, 60, 80, 100]
    assert [r.step for r in rows if r.saves] == [50, 100]
