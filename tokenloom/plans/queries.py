"""The registered queries: each wires operators to the given tables and returns a comparable result."""

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions import alphabet
from tokenloom.functions.text import byte_codes, hash_number, packed_ids, run_name, shuffle_key, unpacked_ids, whole_div
from tokenloom.operators import audit, batches, corpus, encode, generate, ngram, pack, split, vocab
from tokenloom.operators.ordering import hash_segment, range_segment, row_rank
from tokenloom.session import cut, ensure_checkpoint_dir, small_batches, spread, written
from tokenloom.sources import files
from tokenloom.sources import vocabulary as disk

LINE = ("doc_id", "line_no")
SHUFFLED = ("shuffle_key", "doc_id", "line_no")
GRAM = 3
WIDE_GRAMS = (1, 4, 6)
MERGED_VOCAB = 300
READY_VOCAB = "byte_bpe_50k.json"
CURVE_PARTS = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"), "doc_id")


def joined_ids(ids: Column | str) -> Column:
    return F.array_join(ids, ",")


def fingerprint(ids: Column | str) -> Column:
    return F.md5(joined_ids(ids))


# Shared steps


def line_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.lines(documents(spark, sf_dir))


def split_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their split, shuffle key and byte codes (end-of-text included)."""
    sided = split.exact(line_table(spark, sf_dir), LINE)
    return sided.select(*LINE, "shuffle_key", "split", byte_codes("text").alias("codes"))


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pack.by_rows(split_codes(spark, sf_dir), SHUFFLED)
    return pack.blocks(rows, "codes", SHUFFLED, pack.BYTE_BLOCK)


def sized_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batches of ``packed`` with token counts in place of the tokens."""
    sizes = split_codes(spark, sf_dir).select(*SHUFFLED, "split", F.octet_length("codes").alias("n_ids"))
    return pack.by_rows(sizes, SHUFFLED)


def text_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as byte codes with end-of-text, split by document."""
    sided = split.hashed(documents(spark, sf_dir).where("text is not null"), ["doc_id"])
    return sided.select("doc_id", "lang", "split", byte_codes("text").alias("codes"))


def block_output(blocks: DataFrame, ids: str) -> DataFrame:
    out = pack.with_labels(blocks, ids)
    keys = [c for c in out.columns if c not in ("input_ids", "labels")]
    return out.select(
        *keys,
        F.size("input_ids").alias("n_ids"),
        fingerprint("input_ids").alias("ids_md5"),
        (F.col("labels") == F.col("input_ids")).alias("labels_equal"),
    )


# Sources and compilation


def line_scan(spark, sf_dir):
    size = F.char_length("text").alias("n_chars")
    return line_table(spark, sf_dir).select(*LINE, size, F.md5("text").alias("text_md5"))


def run_names(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    tag = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("tag"), "page_id"))
    path = F.regexp_extract("url", r"^([^?#]*)", 1)
    return pages.select("page_id", run_name(path, tag, "byte-").alias("run_name"))


def compile_sources(spark, sf_dir):
    pieces = corpus.compile_corpus(documents(spark, sf_dir), ["source"], "doc_id")
    return pieces.select("source", "ord", "char_offset", F.md5("text").alias("text_md5"))


def compile_conversations(spark, sf_dir):
    pieces = corpus.compile_corpus(table(spark, sf_dir, "conversations"), ["conv_id"], "turn")
    return pieces.select("conv_id", "ord", "char_offset", F.md5("text").alias("text_md5"))


def compile_summary(spark, sf_dir):
    return corpus.summary(table(spark, sf_dir, "documents"), ["source"])


def scratch(spark) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{uuid.uuid4().hex}"


def corpora_readback(spark, sf_dir):
    """All corpora written by one call and read again by line: lines, characters and a sum over the lines of each source."""
    path = scratch(spark)
    files.write_corpora(corpus.compile_corpus(documents(spark, sf_dir), ["source"], "doc_id"), "source", path)
    lines = spark.read.schema("value string, source string").text(path)
    number = hash_number(F.md5("value"))
    return lines.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.char_length("value")).alias("n_chars"), F.sum(number).alias("line_sum")
    )


# Splits


def split_exact(spark, sf_dir):
    return split.exact(line_table(spark, sf_dir), LINE).select(*LINE, "split")


def split_hash(spark, sf_dir):
    return split.hashed(line_table(spark, sf_dir), LINE).select(*LINE, "split")


def split_grouped(spark, sf_dir):
    return split.grouped(line_table(spark, sf_dir), ["doc_id"], LINE).select(*LINE, "split")


def shuffle_order(spark, sf_dir):
    sided = split_codes(spark, sf_dir).drop("codes")
    ranked = row_rank(sided, SHUFFLED, hash_segment("shuffle_key"), ["split"])
    return ranked.select(*LINE, "split", "rn")


# Vocabulary


def byte_vocab(spark, sf_dir):
    used = encode.id_frequency(line_table(spark, sf_dir).select(byte_codes("text").alias("codes")), ids="codes")
    known = alphabet.byte_vocab(spark)
    return known.join(used, "token_id", "left").select("token_id", "token", F.coalesce("n", F.lit(0)).alias("n"))


def special_tokens(spark, sf_dir):
    used = encode.id_frequency(line_table(spark, sf_dir).select(byte_codes("text").alias("codes")), ids="codes")
    roles = alphabet.special_tokens(spark)
    return roles.join(used, "token_id", "left").select("role", "literal", "token_id", F.coalesce("n", F.lit(0)).alias("n"))


def word_counts(spark, sf_dir):
    return vocab.word_counts(documents(spark, sf_dir))


def learnt(spark, sf_dir, size: int = MERGED_VOCAB) -> vocab.Vocabulary:
    return vocab.learn_merges(word_counts(spark, sf_dir), size)


def bpe_merges(spark, sf_dir):
    return learnt(spark, sf_dir).tables(spark)[1]


def bpe_vocab(spark, sf_dir):
    return learnt(spark, sf_dir).tables(spark)[0]


def bpe_encode(spark, sf_dir):
    encoded = encode.bpe(line_table(spark, sf_dir), learnt(spark, sf_dir))
    return encoded.select(*LINE, F.size("input_ids").alias("n_ids"), fingerprint("input_ids").alias("ids_md5"))


def vocab_readback(spark, sf_dir):
    """The learnt vocabulary written as vocab.json and merges.txt and read again: tokens, and the rank of the merge that made each."""
    path = scratch(spark)
    disk.write_json(spark, learnt(spark, sf_dir), path)
    tokens, rules = disk.read_json(spark, path)
    made = rules.select(F.concat("left", "right").alias("token"), "rank")
    return tokens.join(made, "token", "left").select("token_id", "token", "rank")


def ready(spark) -> vocab.Vocabulary:
    """The ready-made vocabulary of 50,257 ids; it pads with end-of-text."""
    import public_tokenizers

    return vocab.Vocabulary.from_tables(*disk.read_tokenizer_json(spark, public_tokenizers.path(READY_VOCAB)))


def ready_vocab(spark, sf_dir):
    """The ready-made vocabulary's special roles and how often each id occurs in the documents."""
    words = ready(spark)
    used = encode.id_frequency(encode.bpe(documents(spark, sf_dir).select("text"), words))
    roles = spark.createDataFrame([(role, t, words.specials[t]) for role, t in sorted(words.roles.items())], "role string, token string, token_id int")
    named = words.tables(spark)[0].withColumn("role", F.lit("word")).join(roles.select("token_id"), "token_id", "left_anti")
    return named.select("role", "token", "token_id").union(roles).join(used, "token_id", "left").select(
        "role", "token", "token_id", F.coalesce("n", F.lit(0)).alias("n")
    )


def bpe_encode_ready(spark, sf_dir):
    """Documents with end-of-text literals inside; the pad literal has no id there and stays text."""
    words = ready(spark)
    encoded = encode.bpe(marked(spark, sf_dir), words)
    back = encode.decode("input_ids", words, skip_special=True)
    return encoded.select(
        "doc_id", F.size("input_ids").alias("n_ids"), fingerprint("input_ids").alias("ids_md5"), F.md5(back).alias("plain_md5")
    )


def bpe_blocks(spark, sf_dir):
    """The ready-made-vocabulary path: encode, cut over-long rows, batch the chunks, pack."""
    sided = split.exact(line_table(spark, sf_dir), LINE)
    chunks = encode.chunk(encode.bpe(sided, learnt(spark, sf_dir)), max_length=pack.WORD_BLOCK)
    order = (*SHUFFLED, "chunk_no")
    # Batching reads its rows twice; they are written, so that they are encoded once.
    coded = written(chunks.select(*order, "split", packed_ids("input_ids").alias("packed")))
    blocks = pack.blocks(pack.by_rows(coded, order), "packed", order, pack.WORD_BLOCK, width=pack.ID_BYTES)
    return block_output(blocks.withColumn("input_ids", unpacked_ids("packed")).drop("packed"), "input_ids")


# Encoding and decoding


def byte_encode(spark, sf_dir):
    encoded = encode.bytes_(line_table(spark, sf_dir))
    return encoded.select(*LINE, F.size("input_ids").alias("n_ids"), fingerprint("input_ids").alias("ids_md5"))


def marked(spark, sf_dir) -> DataFrame:
    """Documents with an end-of-text literal after every sentence and a pad literal at the end."""
    docs = documents(spark, sf_dir)
    text = F.concat(F.replace("text", F.lit(". "), F.lit("." + alphabet.EOS)), F.lit(alphabet.PAD))
    return docs.select("doc_id", text.alias("text"))


def special_literals(spark, sf_dir):
    encoded = encode.bytes_(marked(spark, sf_dir), eos=False)
    return encoded.select("doc_id", F.size("input_ids").alias("n_ids"), fingerprint("input_ids").alias("ids_md5"))


def decode_roundtrip(spark, sf_dir):
    encoded = encode.bytes_(marked(spark, sf_dir), eos=False)
    return encoded.select(
        "doc_id",
        F.md5(encode.decode("input_ids")).alias("text_md5"),
        F.md5(encode.decode("input_ids", skip_special=True)).alias("plain_md5"),
    )


def coverage(spark, sf_dir):
    return encode.coverage_by(documents(spark, sf_dir), ["lang"])


def inspect_encoding(spark, sf_dir):
    items = table(spark, sf_dir, "benchmark").withColumn("shown", F.col("text"))
    return encode.bytes_(items, eos=False).select("item_id", F.col("shown").alias("text"), joined_ids("input_ids").alias("ids"))


def token_stats(spark, sf_dir):
    return encode.stats(table(spark, sf_dir, "documents"), ["lang", "source"])


def id_frequency(spark, sf_dir):
    coded = documents(spark, sf_dir).select("lang", byte_codes("text", eos=False).alias("codes"))
    return encode.id_frequency(coded, "lang", "codes")


def frequent_ids(spark, sf_dir):
    return encode.id_frequency(text_codes(spark, sf_dir), ids="codes").orderBy(F.desc("n"), "token_id").limit(20)


def overflow_chunks(spark, sf_dir):
    encoded = encode.bytes_(documents(spark, sf_dir).select("doc_id", "text"), eos=False)
    chunks = encode.chunk(encoded, max_length=pack.WORD_BLOCK)
    return chunks.select("doc_id", "chunk_no", F.size("input_ids").alias("n_ids"), fingerprint("input_ids").alias("ids_md5"))


# Packing and collation


def pack_blocks(spark, sf_dir):
    return block_output(packed(spark, sf_dir), "codes")


def pack_hash(spark, sf_dir):
    """The scale form: hash split, hash batches, no row numbers."""
    sided = split.hashed(line_table(spark, sf_dir), LINE)
    rows = sided.select(*LINE, "shuffle_key", "split", byte_codes("text").alias("codes"))
    return block_output(pack.blocks(pack.by_hash(rows), "codes", SHUFFLED, pack.BYTE_BLOCK), "codes")


def blocks_readback(spark, sf_dir):
    """The blocks of ``pack_hash`` written by split for trainers, and read again."""
    sided = split.hashed(line_table(spark, sf_dir), LINE)
    rows = sided.select(*LINE, "shuffle_key", "split", byte_codes("text").alias("codes"))
    path = scratch(spark)
    files.write_blocks(pack.with_labels(pack.blocks(pack.by_hash(rows), "codes", SHUFFLED, pack.BYTE_BLOCK), "codes"), path)
    return block_output(spark.read.parquet(path).drop("labels"), "input_ids")


def pack_sources(spark, sf_dir):
    """One batch per source, of any size, in shuffled line order."""
    docs = documents(spark, sf_dir)
    rows = split.with_shuffle_key(corpus.lines(docs, ("doc_id", "source")), LINE)
    rows = rows.select(*LINE, "source", "shuffle_key", byte_codes("text").alias("codes"))
    segment = hash_segment("shuffle_key")
    return block_output(pack.blocks(rows, "codes", SHUFFLED, pack.BYTE_BLOCK, ["source"], segment), "codes")


def pack_document_order(spark, sf_dir):
    """Reading order kept: batches of 1,000 lines as they stand in the corpus."""
    rows = line_table(spark, sf_dir).select(*LINE, byte_codes("text").alias("codes"))
    segment = range_segment(documents(spark, sf_dir), "doc_id", rows=4096)
    rows = pack.by_rows(rows, LINE, by=(), segment=segment)
    return block_output(pack.blocks(rows, "codes", LINE, pack.BYTE_BLOCK, ["batch_id"]), "codes")


def pack_report(spark, sf_dir):
    return pack.report(sized_batches(spark, sf_dir), "n_ids", pack.BYTE_BLOCK)


def map_batches(spark, sf_dir):
    """A user function over batches of 1,000 rows that returns fewer rows than it gets."""

    def longest(batch):
        size = batch["n_ids"].max()
        row = {"split": batch["split"].iloc[0], "batch_id": batch["batch_id"].iloc[0]}
        return type(batch)([{**row, "n_rows": len(batch), "longest": size}])

    narrow = sized_batches(spark, sf_dir).select("split", "batch_id", "n_ids")
    return pack.map_batches(narrow, longest, "split string, batch_id long, n_rows long, longest int")


def collate_pad(spark, sf_dir):
    """Conversation turns in shuffled order, eight to a micro-batch, padded with end-of-text."""
    turn = ("conv_id", "turn")
    turns = split.with_shuffle_key(table(spark, sf_dir, "conversations").select(*turn, "text"), turn)
    ranked = row_rank(turns, ["shuffle_key", *turn], hash_segment("shuffle_key"))
    rows = ranked.select(*turn, "text", whole_div(F.col("rn"), batches.BYTE_PLAN.micro).alias("micro_batch"))
    out = pack.collate(encode.bytes_(rows), ["micro_batch"])
    return out.select(
        *turn,
        "micro_batch",
        fingerprint("input_ids").alias("ids_md5"),
        fingerprint("attention_mask").alias("mask_md5"),
        fingerprint("labels").alias("labels_md5"),
    )


def next_token_pairs(spark, sf_dir):
    rows = encode.bytes_(table(spark, sf_dir, "benchmark"), eos=True)
    pairs = pack.next_token(rows, 4)
    return pairs.select("item_id", "place", joined_ids("context").alias("context"), "target")


# Batch planning


def epoch_manifest(spark, sf_dir):
    """All epochs of the byte plan."""
    keys = ["batch_id", "block_no"]
    blocks = pack.block_keys(pack_report(spark, sf_dir).where("split = 'train'"))
    return batches.manifest(blocks.select(*keys), keys, batches.BYTE_PLAN)


def ready_report(spark, sf_dir) -> DataFrame:
    """Blocks of 512 ids of the ready-made vocabulary, over-long lines cut: sizes only."""
    sided = split.exact(line_table(spark, sf_dir), LINE)
    chunks = encode.chunk_sizes(encode.bpe(sided, ready(spark)), max_length=pack.WORD_BLOCK)
    order = (*SHUFFLED, "chunk_no")
    # Batching reads its rows twice; the sizes are written, so that the lines are encoded once.
    rows = pack.by_rows(written(chunks.select(*order, "split", "n_ids")), order)
    return pack.report(rows, "n_ids", pack.WORD_BLOCK)


def word_manifest(spark, sf_dir):
    """All epochs of the plan for the ready-made vocabulary."""
    keys = ["batch_id", "block_no"]
    blocks = pack.block_keys(ready_report(spark, sf_dir).where("split = 'train'"))
    return batches.manifest(blocks.select(*keys), keys, batches.WORD_PLAN)


def word_schedule(spark, sf_dir):
    n_blocks = ready_report(spark, sf_dir).where("split = 'train'").agg(F.sum("n_blocks")).first()[0]
    plan = batches.schedule(spark, n_blocks, batches.WORD_PLAN)
    return plan.withColumn("rate", F.round(F.col("rate") * 1e6, 6))


def lr_schedule(spark, sf_dir):
    n_blocks = pack_report(spark, sf_dir).where("split = 'train'").agg(F.sum("n_blocks")).first()[0]
    plan = batches.schedule(spark, n_blocks, batches.BYTE_PLAN)
    return plan.withColumn("rate", F.round(F.col("rate") * 1e6, 6))


# Next-token model


def gram_counts(spark, sf_dir, grams=(GRAM,), by=None, side="train") -> DataFrame:
    rows = text_codes(spark, sf_dir).where(F.col("split") == side)
    return ngram.counts(rows, grams, by, "codes")


def ngram_counts(spark, sf_dir):
    return gram_counts(spark, sf_dir, (1, 2, 3))


def ngram_probs(spark, sf_dir):
    out = ngram.probabilities(gram_counts(spark, sf_dir, (1, 2, 3)))
    return out.select("gram", "ctx", "nxt", "n", "ctx_n", F.round("share", 6).alias("share"), F.round("p", 6).alias("p"))


def rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("loss", F.round("loss", 6)).withColumn("perplexity", F.round("perplexity", 4))


def heldout_loss(spark, sf_dir):
    """Fit on the train blocks, measure on the test blocks."""
    sides = ngram.counts(packed(spark, sf_dir), (GRAM,), F.col("split"), "codes")
    return rounded(ngram.evaluate(sides))


def heldout_loss_ready(spark, sf_dir):
    """Orders 1, 4 and 6 over the ready-made vocabulary: fit on the train documents, measured on the test ones."""
    words = ready(spark)
    sided = split.hashed(documents(spark, sf_dir).where("text is not null"), ["doc_id"]).select("doc_id", "split", "text")
    # Splitting, encoding and counting have a Python worker each.
    with small_batches(spark):
        sides = ngram.wide_counts(encode.bpe(sided, words), WIDE_GRAMS, F.col("split"), packed=True)
        losses = cut(ngram.evaluate(sides, len(words.tokens)))
    return rounded(losses)


def learning_curve(spark, sf_dir):
    part = F.pmod(hash_number(shuffle_key(7, "doc_id")), F.lit(CURVE_PARTS))
    key = F.when(F.col("split") == "test", -1).otherwise(part)
    sides = ngram.counts(text_codes(spark, sf_dir), (GRAM,), key, "codes")
    return rounded(ngram.learning_curve(sides, CURVE_PARTS))


def scored(spark, sf_dir) -> DataFrame:
    model = cut(gram_counts(spark, sf_dir))
    docs = gram_counts(spark, sf_dir, by=F.col("doc_id"), side="test")
    return ngram.score(docs, model).withColumnRenamed("key", "doc_id")


def doc_scores(spark, sf_dir):
    return rounded(scored(spark, sf_dir))


def worst_documents(spark, sf_dir):
    return rounded(scored(spark, sf_dir)).orderBy(F.desc("loss"), "doc_id").limit(20)


def label_loss(spark, sf_dir):
    """Held-out loss by quality label."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    by_doc = scored(spark, sf_dir).join(labels, "doc_id")
    mean = F.sum(F.col("loss") * F.col("n_pairs")) / F.sum("n_pairs")
    return by_doc.groupBy("quality").agg(F.sum("n_pairs").alias("n_pairs"), F.round(mean, 6).alias("loss"))


# Generation


def model_tables(spark, sf_dir):
    return generate.written_model(gram_counts(spark, sf_dir, tuple(range(1, GRAM + 1))), GRAM)


def prompt_table(spark, sf_dir) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return generate.prompts(turns, F.call_function("shiftleft", F.col("conv_id").cast("long"), F.lit(32)) + F.col("turn"))


def prompt_context(spark, sf_dir):
    found = prompt_table(spark, sf_dir)
    return found.select(
        "prompt_id",
        F.size("history").alias("n_ids"),
        *[generate.context(F.col("history"), g).alias(f"ctx{g}") for g in range(1, GRAM + 1)],
    )


STEP_OPTIONS = generate.Options(top_k=40)


def stage_rows(spark, sf_dir, upto: str) -> DataFrame:
    """Candidates left after the named filter of a generation step."""
    rows = generate.candidates(prompt_table(spark, sf_dir), model_tables(spark, sf_dir), STEP_OPTIONS, upto)
    return rows.select("prompt_id", "token_id", F.round("score", 6).alias("score"))


def stepped(spark, sf_dir, options: generate.Options) -> DataFrame:
    state = generate.step(generate.started(prompt_table(spark, sf_dir)), model_tables(spark, sf_dir), options)
    last = F.get("history", F.size("history") - 1)
    return state.select("prompt_id", "done", F.when(~F.col("done"), last).alias("token_id"))


def sample_step(spark, sf_dir):
    return stepped(spark, sf_dir, STEP_OPTIONS)


def greedy_step(spark, sf_dir):
    return stepped(spark, sf_dir, generate.Options(do_sample=False))


def generate_text(spark, sf_dir):
    """The text, with U+FFFD for partial characters, and the bytes it comes from, as hex digits."""
    out = generate.run(prompt_table(spark, sf_dir), model_tables(spark, sf_dir))
    raw = encode.decoded_bytes("history", skip_special=True)
    return out.select("prompt_id", "n_new", F.hex(raw).alias("generated_hex"), F.is_valid_utf8(raw.cast("string")).alias("whole_characters"))


def generate_ids(spark, sf_dir):
    out = generate.run(prompt_table(spark, sf_dir), model_tables(spark, sf_dir))
    return out.select("prompt_id", "n_new", fingerprint("history").alias("ids_md5"))


# Bundle audit


LISTED = (
    *audit.REQUIRED,
    audit.VOCAB_FILE,
    audit.MERGES_FILE,
    "pytorch_model.bin",
    "weights.pt",
    "runs/events.log",
    "__pycache__/x.pyc",
    "onnx/decoder.onnx",
)


def listing(spark, sf_dir) -> DataFrame:
    """A bundle listing derived from the documents: every document stands for one file of a 40-document bundle."""
    docs = table(spark, sf_dir, "documents")
    names = F.array(*[F.lit(n) for n in LISTED])
    pick = F.pmod(hash_number(shuffle_key(3, "doc_id")), F.lit(len(LISTED))).cast("int")
    bundle = F.concat(F.lit("bundle-"), F.call_function("div", F.col("doc_id"), F.lit(40)))
    return docs.select(bundle.alias("bundle"), F.get(names, pick).alias("rel_path"), F.col("n_chars").alias("length"))


def bundle_audit(spark, sf_dir):
    return audit.check(listing(spark, sf_dir))


def bundle_missing(spark, sf_dir):
    return audit.missing(listing(spark, sf_dir))


def bundle_upload(spark, sf_dir):
    kept = audit.upload_set(listing(spark, sf_dir))
    return kept.groupBy("bundle").agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("length"))


def bundle_export(spark, sf_dir):
    kept = audit.keep_list(listing(spark, sf_dir))
    return kept.groupBy("bundle", "rel_path").agg(F.count(F.lit(1)).alias("n_files"))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    plain = [
        line_scan, run_names, compile_sources, compile_conversations, compile_summary, corpora_readback,
        split_exact, split_hash, split_grouped, shuffle_order,
        byte_vocab, special_tokens, word_counts, bpe_merges, bpe_vocab, bpe_encode, bpe_blocks,
        ready_vocab, bpe_encode_ready, vocab_readback,
        byte_encode, special_literals, decode_roundtrip, coverage, inspect_encoding, token_stats,
        id_frequency, frequent_ids, overflow_chunks,
        pack_blocks, pack_hash, blocks_readback, pack_sources, pack_document_order, pack_report, map_batches, collate_pad,
        next_token_pairs, epoch_manifest, lr_schedule, word_manifest, word_schedule,
        ngram_counts, ngram_probs, heldout_loss, heldout_loss_ready, learning_curve, doc_scores, worst_documents, label_loss,
        prompt_context, sample_step, greedy_step, generate_ids,
        bundle_audit, bundle_missing, bundle_upload, bundle_export,
    ]
    found = {fn.__name__: fn for fn in plain}
    for name in ("candidates", "penalty", "no_repeat", "temperature", "top_k", "top_p"):
        found[name] = lambda spark, sf_dir, name=name: stage_rows(spark, sf_dir, name)
    found["generate"] = generate_text
    return found
