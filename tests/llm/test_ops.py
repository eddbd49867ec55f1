"""Each operator against a brute-force version, and the odd cases: nulls, empty and long texts, repeated rows, no rows."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import ODD, documents, lower, words
from tokenloom.llm import bpe, chat, decontaminate, language, licences, near, pitman_yor, quality, queries, repeats, sharding

SMALL = "/root/testdata/sf0.001"


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def sample(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]


# quality rules


def base_rules(text):
    found = words(text)
    threes = Counter(zip(found, found[1:], found[2:]))
    covered = {j for i in range(len(found) - 2) if threes[tuple(found[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines, seen, twice = (text or "").split("\n"), set(), 0
    for line in lines:
        if words(line):
            twice += line in seen
            seen.add(line)
    return len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text or ""), twice, len(covered)


def test_quality_rules_equal_brute_force(spark, sample):
    docs = documents(spark, ODD + sample)
    labels = spark.createDataFrame([(i, 1) for i, _ in sample[::2]] + [(None, 1), (3, 0)], "doc_id long, quality int")
    got = quality.score(docs, quality.trusted_ids(labels)).collect()
    want = Counter((i, *base_rules(t)) for i, t in ODD + sample)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert (r.base_failed, r.kept) == (failed, not failed and r.llr >= quality.THRESHOLD)


def test_likelihood_ratio_follows_its_definition(spark):
    buckets = 16
    docs = documents(spark, [(1, "a b"), (2, "c"), (3, "a")])
    trusted = spark.createDataFrame([(1,)], "doc_id long")
    hashed = {}
    for r in spark.sql("select w, xxhash64(w) as h from values ('a'), ('b'), ('c') as t(w)").collect():
        hashed[r.w] = r.h
    pair = spark.sql(f"select xxhash64(cast({hashed['a']} as long), cast({hashed['b']} as long)) as h").first().h
    grams = {1: [hashed["a"], hashed["b"], pair], 2: [hashed["c"]], 3: [hashed["a"]]}
    raw, good = Counter(h % buckets for g in grams.values() for h in g), Counter(h % buckets for h in grams[1])
    for r in quality.score(docs, trusted, buckets=buckets).collect():
        ratio = [math.log((good[h % buckets] + 1) / (3 + buckets)) - math.log((raw[h % buckets] + 1) / (5 + buckets)) for h in grams[r.doc_id]]
        assert r.llr == pytest.approx(sum(ratio) / len(ratio), abs=1e-12)


def test_quality_without_trusted_documents_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long")
    assert {r.llr for r in quality.score(documents(spark, ODD), none).collect()} == {0.0}
    assert rows(quality.score(documents(spark, []), none)) == []
    kept = quality.filter_documents(documents(spark, ODD), none)
    assert kept.columns == documents(spark, []).columns


def test_quality_can_be_filtered(spark, sample):
    docs = documents(spark, sample).withColumns({"words": F.lit(1), "rules": F.lit(2), "own": F.lit(3)})
    none = spark.createDataFrame([], "doc_id long")
    whole = quality.score(docs, none)
    steps = [x._jdf.queryExecution().optimizedPlan().toString().count("zip_with") for x in (whole, whole.where("kept"))]
    assert steps[0] == steps[1]
    kept = quality.filter_documents(docs, none)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in whole.where("kept").collect())


# language


def phrases(text, training):
    """Greedy parse into longest matches, cut at the ends of segments."""
    count = 0
    for low in range(0, len(text), language.SEGMENT):
        part, i = text[low : low + language.SEGMENT], 0
        while i < len(part):
            j = i + 1
            while j <= len(part) and part[i:j] in training:
                j += 1
            i = max(j - 1, i + 1)
            count += 1
    return count


def test_cross_parsing_equals_search_in_the_text(sample):
    training = {"a": [t for _, t in sample[:3]], "b": [t for _, t in sample[10:13]]}
    model = language.Model(training)
    texts = [language.folded(t)[:1500] for _, t in sample[20:26]] + ["", "q"]
    for text in texts:
        symbols = model.symbol[np.frombuffer(text.encode("utf-32-le"), np.uint32)].astype(np.int64)
        start = np.arange(0, len(text), language.SEGMENT)
        got = model.phrases(symbols, start, np.minimum(language.SEGMENT, len(text) - start)).sum(axis=1)
        want = [phrases(text, "\n".join(map(language.folded, training[name]))) for name in model.languages]
        assert got.tolist() == want


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in language.identify(docs).collect()}
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    held = [i for i in got if got[i].held_out]
    assert sum(got[i].lang_pred == truth[i] for i in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_unequal_samples_compete_fairly(spark):
    rows_ = [(r.lang, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("lang", "text").collect()]
    texts = {lang: [t for has, t in rows_ if has == lang and len(t) > 200] for lang in ("en", "fr")}
    counts = {}
    for size in (100, 300, 32_000):
        model = language.Model({"en": [t[:1000] for t in texts["en"][:32]], "fr": ["".join(texts["fr"][:32])[:size]]})
        right = 0
        for lang in ("en", "fr"):
            for text in texts[lang][-40:]:
                symbols, _ = language._characters(text[:600], model)
                size_ = np.array([len(symbols)])
                bits = model.phrases(symbols.astype(np.int64), np.zeros(1, np.int64), size_)[:, 0] * model.bits
                right += model.languages[bits.argmin()] == lang
        counts[size] = right / 80
    assert counts[100] >= 0.9 and min(counts[300], counts[32_000]) >= 0.97


def test_language_of_odd_texts(spark):
    got = language.identify(documents(spark, ODD)).collect()
    assert len(got) == len(ODD)
    assert {r.lang_pred for r in got if r.doc_id in (2, 3, 4)} == {"und"}
    nothing = documents(spark, [(2, "abc")]).selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert rows(language.identify(nothing)) == [(2, False, "und", 0.0)]
    assert rows(language.identify(documents(spark, []))) == []


# sharding


def test_table_is_filled_by_turns_and_moves_little():
    shards = [f"s{i}" for i in range(7)]
    slots = 1009
    owner = [None] * slots
    orders = {}
    for s in shards:
        first, step = sharding.preference(s, slots)
        orders[s] = iter([(first + j * step) % slots for j in range(slots)])
    left = slots
    while left:
        for s in shards:
            if left:
                slot = next(x for x in orders[s] if owner[x] is None)
                owner[slot], left = s, left - 1
    got = [shards[i] for i in sharding.fill(shards, slots)]
    assert got == owner
    assert max(Counter(got).values()) - min(Counter(got).values()) <= 1
    fewer = [s for s in shards if s != "s3"]
    after = [fewer[i] for i in sharding.fill(fewer, slots)]
    assert sum(a != b for a, b in zip(got, after) if a != "s3") < 0.2 * slots


def test_placing_rows(spark):
    docs = documents(spark, ODD)
    got = sharding.place(docs, ["doc_id"], ["a", "b", "c"], slots=101).collect()
    assert len(got) == len(ODD) and len({r.shard for r in got if r.doc_id == 7}) == 1
    table = sharding.fill(["a", "b", "c"], 101)
    assert all(r.shard == "abc"[table[r.slot]] for r in got)
    for wrong in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.fill(wrong, 101)
    with pytest.raises(ValueError):
        sharding.fill(["a"], 100)


# chat


def test_every_participant_gets_a_rendering(spark):
    turns = [
        (1, 0, "system", "be kind", 5),
        (1, 1, "ann", "hi <|bob", 5),
        (1, 2, "bob", None, 5),
        (1, 2, None, "x", 5),
        (1, None, "ann", "first", 5),
        (2, 0, "system", "alone", 5),
        (None, 1, "ann", "lost", 5),
        (1, 300, "bob", "late", 5),
        (1, 300, "bob", "late", 5),
    ]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, start int")
    got = chat.perspectives(table).collect()
    want = Counter()
    for conv in {t[0] for t in turns}:
        said = sorted(
            [(t[1] if t[1] is not None else -1, t[2] or "unknown", t[3] or "", t[1]) for t in turns if t[0] == conv], key=lambda x: x[:3]
        )
        for me in {s for _, s, _, _ in said} - {"system"}:
            at = 0
            for _, speaker, text, turn in said:
                part = "system" if speaker == "system" else "assistant" if speaker == me else "user"
                head = f"<|{part}{' name=' + speaker if part == 'user' else ''}|>\n"
                body = text.replace("<|", "< |")
                segment = head + body + "<|end|>\n"
                mask = (at + len(head), at + len(head) + len(body) + 7) if part == "assistant" else (None, None)
                want[conv, me, turn, part, segment, at, *mask] += 1
                at += len(segment)
    assert Counter(map(tuple, got)) == want
    assert rows(chat.perspectives(table.where("false"))) == []


def test_names_cannot_forge_a_mark(spark):
    names = ["eve|>\nforged", "x<", "y|", "a<|end|>\n<|assistant|>\nhi", "ok"]
    turns = [(1, i, name, "text") for i, name in enumerate(names)]
    got = chat.perspectives(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    for r in got.collect():
        assert r.segment.count("<|") == 2 and r.segment.count("\n") == 2
        assert r.segment.split("\n")[0].count("|>") == 1 and r.segment.split("\n")[0].endswith("|>")


def test_renderings_are_assembled(spark):
    turns = [(1, i, ("ann", "bob", "system")[i % 3], f"text {i} " * (i + 1)) for i in range(9)]
    rows_ = chat.perspectives(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    for chars in (1 << 20, 60):
        got = chat.assembled(rows_, chars).collect()
        for me in ("ann", "bob"):
            mine = sorted((r for r in got if r.perspective == me), key=lambda r: r.chunk)
            assert (len(mine) == 1) == (chars > 60)
            whole = sorted((r.start, r.segment) for r in rows_.collect() if r.perspective == me)
            assert "".join(r.text for r in mine) == "".join(s for _, s in whole)
            said = [r.text[m.start : m.end] for r in mine for m in r.masks]
            assert said == [f"{t}<|end|>" for _, _, who, t in turns if who == me]


# language model


def test_scores_of_documents(spark, sample):
    docs = documents(spark, sample + [(10_001, None), (None, "lost words"), (10_002, "new new")])
    got = pitman_yor.score(docs).collect()
    told = [(i, [*words(lower(t)), None]) for i, t in sample + [(10_001, None), (None, "lost words"), (10_002, "new new")]]
    is_held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    count = Counter(w for i, ws in told if not is_held(i) for w in ws)
    n, v = sum(count.values()), len(count)
    want = Counter((i, is_held(i), len(ws), sum(count[w] > 0 for w in ws), n) for i, ws in told)
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in got) == want
    by_id = dict(told)
    for r in got:
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in by_id[r.doc_id])
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score < 0
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_probabilities_sum_to_one(spark):
    """The model's probabilities of all words after a context, and of an unknown one, add up to one."""
    text = " ".join(random.Random(4).choices("a b c d".split(), [8, 4, 2, 1], k=300))
    train = documents(spark, [(1, text), (3, text[:99])]).selectExpr("doc_id", "false as held_out", "text")
    probes = [(0, f"a {w}") for w in "a b c d zzz".split()] + [(1, "a")]
    model = pitman_yor.fit(train)
    assert model.words == 5 and model.tokens == len(words(text)) + len(words(text[:99])) + 2
    # The seating after the last sweep, whose totals the model holds.
    import pyarrow as pa

    from tokenloom.llm.common import slices
    from tokenloom.llm.pitman_yor import Pairs, tokens

    word, context, _ = (np.concatenate(x) for x in zip(*[tokens(p) for p in slices(pa.array([text, text[:99]]))]))
    order = np.lexsort((context, word))
    word, context = word[order], context[order]
    first = np.flatnonzero(np.r_[True, (word[1:] != word[:-1]) | (context[1:] != context[:-1])])
    count = np.diff(np.r_[first, len(word)])
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bucket = pitman_yor.bucket_of(word[first], buckets)
    after_a = tokens(next(iter(slices(pa.array([probes[0][1]])))))[1][1]
    sweep = model.sweeps[-1]
    total = model.word_chance(np.zeros(1), np.zeros(1), sweep)[0]
    p_total, own_total, tables_here = total, 0.0, 0
    for b in range(buckets):
        mine = bucket == b
        if not mine.any():
            continue
        pairs = Pairs.of_counts(word[first][mine], context[first][mine], count[mine])
        tables, served, seated = list(model.chain(b, pairs))[len(model.sweeps) - 2]
        p_total += model.word_chance(served, seated, sweep).sum()
        here = pairs.context == after_a
        single = (context[first][mine] == after_a) & (count[mine] == 1)
        own_total += (pairs.count[here] - model.pair.discount * tables[here]).sum() + single.sum() * (1 - model.pair.discount)
        tables_here += tables[here].sum() + single.sum()
    assert tables_here == sweep.tables[after_a]
    assert p_total == pytest.approx(1, abs=1e-9)
    customers = model.customers[after_a]
    spare = pitman_yor.STRENGTH + model.pair.discount * sweep.tables[after_a]
    assert (own_total + spare * p_total) / (pitman_yor.STRENGTH + customers) == pytest.approx(1, abs=1e-9)


def test_chance_of_sitting_alone():
    """Against all seatings of a few customers, weighted as the Pitman-Yor process does."""
    d = 0.6
    table = pitman_yor.alone_table(d, 6)

    def seatings(c):
        if c == 0:
            yield [], 1.0
            return
        for sizes, weight in seatings(c - 1):
            yield [*sizes, 1], weight
            for k, n in enumerate(sizes):
                yield [*sizes[:k], n + 1, *sizes[k + 1 :]], weight * (n - d)

    for c in range(1, 7):
        total, alone = defaultdict(float), defaultdict(float)
        for sizes, weight in seatings(c):
            total[len(sizes)] += weight
            alone[len(sizes)] += weight * sizes.count(1) / c
        for t in total:
            assert table[c, t] == pytest.approx(alone[t] / total[t])


def test_language_model_of_nothing(spark):
    assert rows(pitman_yor.score(documents(spark, []))) == []


# decontamination


def edit_distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        last = row
    return last[-1]


def test_passages_against_all_windows(spark, sample):
    draw = random.Random(5)
    items = [(i, " ".join(f"w{draw.randrange(60)}" for _ in range(draw.randrange(8, 40)))) for i in range(25)]
    items += [(90, "too short"), (91, None), (92, "")]
    docs = []
    for n in range(120):
        found = words(items[draw.randrange(25)][1])
        for _ in range(draw.randrange(0, max(1, len(found) // 5) + 1)):
            at = draw.randrange(len(found))
            found[at] = f"zz{draw.randrange(999)}"
        around = [f"u{draw.randrange(99)}" for _ in range(20)]
        docs.append((n, " ".join(around[:draw.randrange(20)] + found + around)))
    got = {(r.doc_id, r.item_id): r.distance for r in decontaminate.findings(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()}
    true = {}
    for i, text in docs:
        has = words(lower(text))
        for item, body in items[:25]:
            need = words(body)
            limit = len(need) // 5
            best = min(
                edit_distance(need, has[s : s + len(need)])
                for s in range(len(has))
                if sum(w not in need for w in has[s : s + len(need)]) <= limit or s == 0
            )
            if best <= limit:
                true[i, item] = best
    assert set(got) <= set(true)
    assert len(got) >= 0.9 * len(true)
    assert all(got[k] >= true[k] for k in got)
    exact = [k for k in true if true[k] == 0]
    assert exact and all(got.get(k) == 0 for k in exact)


def test_decontamination_of_odd_rows(spark):
    items = spark.createDataFrame([(1, "ß é 你好 🙂 café line and more of it"), (2, None)], "item_id long, text string")
    docs = documents(spark, [*ODD, (20, "so ß é 你好 🙂 CAFé line and more of it"), (None, "ß é 你好 🙂 café line and more of it")])
    found = decontaminate.findings(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(20, 1), (None, 1)}
    left = decontaminate.without_contaminated(docs, items)
    assert left.columns == docs.columns and left.count() == len(ODD) - 1 + 0
    assert rows(decontaminate.findings(docs, items.where("false"))) == []
    assert rows(decontaminate.findings(docs.where("false"), items)) == []


# byte-level BPE


def test_ids_equal_the_public_library(spark, sample):
    import tiktoken

    path = public_tokenizers.path(queries.VOCABULARY)
    ranks = bpe.read_ranks(path)
    public = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    draw = random.Random(1)
    alphabet = "ab ZÄßéñ你好🙂\n\t\r  '’sll0123.,! 　́١<|endoftext|>"
    noise = [(1000 + i, "".join(draw.choices(alphabet, k=draw.randrange(200)))) for i in range(200)]
    all_rows = ODD + sample[:60] + noise
    got = bpe.encode(documents(spark, all_rows), path, public_tokenizers.PATTERN).collect()
    assert len(got) == len(all_rows)
    want = Counter((i, np.array(public.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in all_rows)
    assert Counter((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in got) == want
    digest = bpe.digests(documents(spark, all_rows), path, public_tokenizers.PATTERN).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in digest) == Counter(
        (i, len(b) // 4, hashlib.sha256(b).hexdigest(), hashlib.sha256(t).hexdigest()) for i, b, t in want.elements()
    )


def test_perfect_hash_is_minimal():
    codes = np.unique(np.random.default_rng(2).integers(0, 1 << 63, 5000).astype(np.uint64))
    table = bpe.PerfectHash.build(codes, np.arange(len(codes)))
    assert len(table.ids) == len(codes)
    assert (table.lookup(codes) == np.arange(len(codes))).all()


# repeated byte strings


def cut_repeats(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, int)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        mask = np.cumsum(gone[:-1]) > 0
        rest = bytes(b for b, m in zip(t, mask) if not m)
        out.append((len(t), int(mask.sum()), int((np.diff(np.r_[0, mask.astype(int)]) == 1).sum()), rest))
    return out


def test_repeats_equal_brute_force(spark):
    draw = random.Random(3)
    fresh = lambda n: "".join(draw.choices("abcdefgh é", k=n))
    passages = [fresh(n) for n in (150, 199, 200, 201, 260, 400, 900)]
    texts = [fresh(draw.randrange(300)) + draw.choice(passages) + fresh(draw.randrange(300)) + draw.choice(passages) for _ in range(60)]
    texts += ["a" * 500, "ab" * 300, "a" * 199, passages[-1], passages[-1], "x" + passages[4] * 4]
    edited = list(passages[-1] * 2)
    for at in range(0, len(edited), 170):
        edited[at] = "#"
    texts.append("".join(edited))
    every = ODD + [(100 + i, t) for i, t in enumerate(texts)]
    want = Counter((i, *w[:3], hashlib.sha256(w[3]).hexdigest()) for (i, _), w in zip(every, cut_repeats([(t or "").encode() for _, t in every], 200)))
    assert Counter(rows(repeats.spans(documents(spark, every)))) == want
    docs = documents(spark, every)
    cut = repeats.without_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == len(every)
    assert rows(repeats.spans(documents(spark, []))) == []


def test_suffix_sort_is_lexicographic():
    draw = np.random.default_rng(8)
    data = draw.integers(97, 99, 3000).astype(np.uint8)
    data[1000:1400] = data[:400]
    at = np.arange(len(data) - 200)
    got = repeats.Suffixes(data, 200).sort(at)
    body = data.tobytes()
    keys = [body[i : i + 200] for i in got]
    assert sorted(got) == at.tolist() and keys == sorted(keys)


# near-duplicates


def near_groups(docs, width, percent):
    sets = []
    for _, t in docs:
        found = words(lower(t))
        sets.append(frozenset(zip(*[found[k:] for k in range(width)])) if len(found) >= width else frozenset([tuple(found)] if found else []))
    group = list(range(len(docs)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                group[find(a)] = find(b)
    low = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            low[find(i)] = min(doc, low.get(find(i), doc))
    out = []
    for i, (doc, _) in enumerate(docs):
        component = low.get(find(i)) if sets[i] else doc
        out.append((doc, len(sets[i]), component, doc == component))
    return out


@pytest.mark.parametrize("small, portion", [(near.SMALL, near.PORTION_CLASSES), (2, 16)])
def test_near_duplicates_equal_brute_force(spark, sample, monkeypatch, small, portion):
    width = 2
    monkeypatch.setattr(near, "SMALL", small)
    monkeypatch.setattr(near, "PORTION_CLASSES", portion)
    draw = random.Random(6)
    many = []
    for g in range(6):
        base = [f"w{draw.randrange(400)}" for _ in range(60)]
        for _ in range(45):
            copy = list(base)
            for _ in range(draw.randrange(0, 5)):
                copy[draw.randrange(60)] = f"e{draw.randrange(9)}"
            many.append((1000 + len(many), " ".join(copy)))
    every = ODD + sample + many
    assert Counter(rows(near.groups(documents(spark, every), width=width))) == Counter(near_groups(every, width, 80))


def test_sketch_agrees_with_similarity():
    draw = np.random.default_rng(9)
    a = draw.integers(0, 1 << 62, 1000).astype(np.uint64)
    b = a.copy()
    b[:111] = draw.integers(0, 1 << 62, 111)
    for n in (1, 3, 1000):
        grid = near.sketch(np.concatenate([a[:n], b[:n]]), np.array([n, n]))
        assert (grid != near.UNSET).all()
    assert abs((grid[0] == grid[1]).mean() - 889 / 1111) < 0.12


def test_one_document_of_each_group_stays(spark):
    docs = documents(spark, [*ODD, (30, ODD[0][1]), (30, ODD[0][1])])
    kept = near.keep_one(docs, width=5)
    assert kept.columns == docs.columns
    assert sorted([r.doc_id for r in kept.collect()], key=str) == sorted([None, 1, 2, 3, 4, 5, 7, 8, 9], key=str)
    assert rows(near.groups(documents(spark, []))) == []
    shared = [(None, "one two three"), (None, "four five six"), (4, "seven eight"), (4, "nine ten"), (4, "nine ten")]
    assert Counter(r.text for r in near.keep_one(documents(spark, shared)).collect()) == Counter(
        ["one two three", "four five six", "seven eight", "nine ten"]
    )


def thue_morse():
    """Two words that a polynomial hash modulo 2^64 can't tell apart, whatever its base."""
    word = "a"
    for _ in range(10):
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_thue_morse_words_differ(spark):
    one, other = thue_morse()
    docs = documents(spark, [(1, f"{one} tail"), (2, f"{other} tail")])
    assert Counter(rows(near.groups(docs))) == Counter([(1, 1, 1, True), (2, 1, 2, True)])
    bodies = [f"x{one}", f"y{other}"]
    cut = [(i, *c[:3]) for i, c in enumerate(cut_repeats([b.encode() for b in bodies], 200))]
    found = repeats.spans(documents(spark, list(enumerate(bodies)))).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans) for r in found) == cut
    held_out, trained = (next(i for i in range(99) if (zlib.crc32(str(i).encode()) % 7 == 2) == side) for side in (True, False))
    scored = pitman_yor.score(documents(spark, [(trained, one), (held_out, other)])).collect()
    assert {r.doc_id: r.n_known for r in scored} == {trained: 2, held_out: 1}


# licences


MIT_TEXT = """MIT License

Copyright (c) 2021 Some Person

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
APACHE_HEADER = """# Copyright 2020 The Authors. All rights reserved.
#
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
import os
"""


def test_real_licence_texts_are_recognised(spark):
    files = [
        (1, "mit/LICENSE", MIT_TEXT),
        (2, "mit/LICENSE.txt", MIT_TEXT.split("\n\n", 2)[2]),
        (3, "mit/src/a.py", "import os"),
        (4, "apache/COPYING", "                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n\n   TERMS AND CONDITIONS FOR USE"),
        (5, "apache/b.py", APACHE_HEADER),
        (6, "gpl/COPYING", "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software Foundation, Inc."),
        (7, "gpl/c.c", "/* nothing */"),
        (8, "x/d.py", "# SPDX-License-Identifier: MIT\nprint()"),
        (9, "x/e.py", "// SPDX-License-Identifier: GPL-3.0-or-later\n"),
        (10, "x/f.py", "the licence plate of the car was lost, and with it all papers about copyright and more"),
    ]
    # Files of other kinds, so that the words of the notices are as rare as they are.
    files += [(100 + i, f"y/{i}.txt", f"some words of file {i} that say the same to any person of this and that") for i in range(60)]
    got = {r.doc_id: (r.own_licence, r.licence) for r in licences.scan(spark.createDataFrame(files, "doc_id long, path string, text string")).collect()}
    assert {i: got[i][1] for i in range(1, 11)} == {
        1: "MIT", 2: "MIT", 3: "MIT", 4: "Apache-2.0", 5: "Apache-2.0", 6: "GPL-3.0", 7: "GPL-3.0", 8: "MIT", 9: "GPL-3.0", 10: None
    }
    assert got[3][0] is None and got[7][0] is None
    assert {v for i, v in got.items() if i >= 100} == {(None, None)}


def test_licences_are_found_and_inherited(spark):
    files = [
        (1, "a/LICENSE", "Released under the MIT License.\n\nmore words here"),
        (2, "a/b/x.py", "nothing"),
        (3, "a/b/c/y.py", "Licensed under the Apache License, Version 2.0.\ncode"),
        (4, "a/b/c/z.py", None),
        (5, "d/x.py", "no"),
        (6, "d/e/LICENSE.txt", "Licensed under CC BY-NC 4.0."),
        (7, "d/e/f/g.txt", ""),
        (8, None, "x"),
        (9, "top.txt", "the license of this is unknown to all of us and long"),
        (7, "d/e/f/g.txt", ""),
        (10, "LICENSE", "This work is licensed under the GNU General Public License, version 3."),
        (11, "a/b/LICENSE", "empty words"),
    ]
    got = licences.scan(spark.createDataFrame(files, "doc_id long, path string, text string")).collect()
    assert Counter((r.doc_id, r.own_licence, r.licence, r.inherited_from) for r in got) == Counter(
        [
            (1, "MIT", "MIT", None),
            (2, None, "MIT", "a"),
            (3, "Apache-2.0", "Apache-2.0", None),
            (4, None, "MIT", "a"),
            (5, None, "GPL-3.0", ""),
            (6, "CC-BY-NC-4.0", "CC-BY-NC-4.0", None),
            (7, None, "CC-BY-NC-4.0", "d/e"),
            (7, None, "CC-BY-NC-4.0", "d/e"),
            (8, None, None, None),
            (9, None, "GPL-3.0", ""),
            (10, "GPL-3.0", "GPL-3.0", None),
            (11, None, "MIT", "a"),
        ]
    )
    assert all(r.own_score is None or 0.6 <= r.own_score <= 1.000001 for r in got)
    assert rows(licences.scan(spark.createDataFrame([], "doc_id long, path string, text string"))) == []
