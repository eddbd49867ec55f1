"""Batch generation over a prompts table."""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions import decoding
from tokenloom.functions.alphabet import BYTE_VOCAB_SIZE
from tokenloom.functions.sampling import EOS_ID, Options
from tokenloom.functions.text import byte_codes, code_ids
from tokenloom.operators import encode
from tokenloom.operators.lookup import BROADCAST_ROWS, left_lookup
from tokenloom.operators.ngram import followers
from tokenloom.operators.vocab import Vocabulary
from tokenloom.session import cut

STATE = "prompt_id long, history array<int>, n_new int, done boolean"
# Prompts that share a copy of a small model.
GROUP_ROWS = 20_000


def prompts(df: DataFrame, key: Column, text: str = "text", vocabulary: Vocabulary | None = None) -> DataFrame:
    """G1: prompt text as ids, without end-of-text; of the byte vocabulary where no other is given."""
    known = df.where(F.col(text).isNotNull()).select(key.alias("prompt_id"), F.col(text).alias("text"))
    if vocabulary:
        return encode.bpe(known, vocabulary, out="history")
    return known.select("prompt_id", code_ids(byte_codes("text", eos=False)).alias("history"))


def context(history: Column, gram: int, n_ids: int = BYTE_VOCAB_SIZE) -> Column:
    """G1: the last gram-1 ids as one number; null where the history is shorter."""
    number = F.lit(0).cast("long")
    for back in range(gram - 1, 0, -1):
        number = number * n_ids + F.get(history, F.size(history) - back)
    return F.when(F.size(history) >= gram - 1, number)


def wide_context(history: Column, gram: int) -> Column:
    """The last gram-1 ids as BINARY, four bytes each, as ``ngram.wide_counts`` writes them."""
    last = [F.get(history, F.size(history) - back) for back in range(gram - 1, 0, -1)]
    digits = F.concat(F.lit(""), *[F.lpad(F.hex(i), 8, "0") for i in last])
    return F.when(F.size(history) >= gram - 1, F.unhex(digits))


@dataclass(frozen=True)
class Model:
    """The model by context, one table (ctx, ids, shares) per gram, and whether each was counted to be small."""

    tables: dict[int, DataFrame]
    small: dict[int, bool]
    n_ids: int
    eos_id: int = EOS_ID
    wide: bool = False


def written_model(counts: DataFrame, n: int, n_ids: int = BYTE_VOCAB_SIZE, eos_id: int = EOS_ID) -> Model:
    """Write the model once, so that every step reads it and no step refits it.

    Small is counted in candidates, not in contexts, since a context row holds up to a vocabulary of them.
    """
    table = cut(followers(counts))
    sizes = {r.gram: r.size for r in table.groupBy("gram").agg(F.sum(F.size("ids")).alias("size")).collect()}
    tables = {g: table.where(F.col("gram") == g).select("ctx", "ids", "shares") for g in range(1, n + 1)}
    return Model(tables, {g: sizes.get(g, 0) <= BROADCAST_ROWS for g in tables}, n_ids, eos_id, dict(counts.dtypes)["ctx"] == "binary")


def looked_up(state: DataFrame, model: Model) -> DataFrame:
    """Add the entries of every level to each prompt: one look-up of a bounded row per prompt and level.

    Of a table that is not small only the contexts that live prompts have are taken; their rows are then few enough to be
    copied for the prompts that share a context.
    """
    history = F.col("history")
    contexts = {f"ctx{g}": wide_context(history, g) if model.wide else context(history, g, model.n_ids) for g in model.tables}
    keyed = state.withColumns(contexts)
    for gram, table in model.tables.items():
        if not model.small[gram]:
            table = table.join(keyed.select(F.col(f"ctx{gram}").alias("ctx")).distinct(), "ctx", "left_semi")
        named = table.toDF(f"ctx{gram}", f"ids{gram}", f"shares{gram}")
        keyed = left_lookup(keyed, named, [f"ctx{gram}"], ["prompt_id"], model.small[gram])
    entries = []
    for gram in model.tables:
        entries += [
            F.coalesce(f"ids{gram}", F.array().cast("array<int>")).alias(f"ids{gram}"),
            F.coalesce(f"shares{gram}", F.array().cast("array<double>")).alias(f"shares{gram}"),
        ]
    return keyed.select(*state.columns, *entries)


def candidates(state: DataFrame, model: Model, options: Options = Options(), upto: str = "candidates") -> DataFrame:
    """One row per candidate of each prompt after the named filter (see ``sampling.STAGES``)."""
    rows = decoding.stage_rows(options, len(model.tables), upto, model.n_ids)
    found = looked_up(state.select("prompt_id", "history"), model)
    return found.mapInArrow(rows, "prompt_id long, token_id int, score double")


def started(start: DataFrame) -> DataFrame:
    return start.select("prompt_id", "history", F.lit(0).alias("n_new"), F.lit(False).alias("done"))


def step(state: DataFrame, model: Model, options: Options = Options()) -> DataFrame:
    """One more id for every prompt: penalty, n-gram ban, temperature, top-k, top-p, draw."""
    one = decoding.one_step(options, len(model.tables), model.n_ids, model.eos_id)
    return looked_up(state, model).mapInArrow(one, STATE)


def run(
    start: DataFrame, model: Model, options: Options = Options(), cut_every: int = 4, vocabulary: Vocabulary | None = None
) -> DataFrame:
    """At most ``max_new_tokens`` new ids per prompt, then prompt and continuation as text.

    A model counted to be small is copied to groups of prompts by a shuffle, and every prompt of a group runs to its end in
    one pass. A larger one, or one of wide contexts, stays a table: all prompts go step by step, and ended prompts leave the
    loop.
    """
    whole = all(model.small.values()) and not model.wide
    ended = run_by_groups(start, model, options) if whole else run_by_steps(start, model, options, cut_every)
    text = encode.decode("history", vocabulary, skip_special=True)
    return ended.select("prompt_id", "history", "n_new", text.alias("generated_text"))


def run_by_groups(start: DataFrame, model: Model, options: Options) -> DataFrame:
    cores = start.sparkSession.sparkContext.defaultParallelism
    groups = max(cores, -(-start.count() // GROUP_ROWS))
    dealt = start.select("prompt_id", "history", F.pmod(F.xxhash64("prompt_id"), F.lit(groups)).cast("int").alias("part"))
    rows = reduce(DataFrame.unionByName, [t.withColumn("gram", F.lit(g)) for g, t in model.tables.items()])
    copies = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    steps = decoding.all_steps(options, len(model.tables), model.n_ids, model.eos_id)
    return dealt.groupBy("part").cogroup(copies.groupBy("part")).applyInArrow(steps, STATE)


def run_by_steps(start: DataFrame, model: Model, options: Options, cut_every: int) -> DataFrame:
    """The state is written every few steps, so a lost executor costs a few steps and plans stay short."""
    state = cut(started(start))
    ended = []
    for number in range(1, options.max_new_tokens + 1):
        state = step(state, model, options)
        ended.append(state.where("done"))
        state = state.where("not done")
        if number % cut_every == 0 or number == options.max_new_tokens:
            written = cut(reduce(DataFrame.unionByName, ended, state))
            state, ended = written.where("not done"), [written.where("done")]
    return reduce(DataFrame.unionByName, ended, state)
