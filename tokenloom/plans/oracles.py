"""DuckDB SQL for the registered queries, written per row and per token, apart from how Spark computes them."""

NL = "chr(10)"

# Lines of a text, as a line reader gives them.
LINES = f"""
unixtext as (select *, regexp_replace(text, '\\r\\n?', {NL}, 'g') as t from documents where text is not null),
linelists as (
  select *, string_split(case when ends_with(t, {NL}) then left(t, length(t) - 1) else t end, {NL}) as ls
  from unixtext where t <> ''),
lines as (
  select doc_id, source, unnest(range(len(ls)))::int as line_no, unnest(ls) as text from linelists),
keyed as (
  select *, md5('42:' || doc_id || ':' || line_no) as h from lines)
"""

EXACT = """
sided as (
  select *, case when row_number() over (order by h, doc_id, line_no) <= ceil(0.1::double * count(*) over ())
            then 'test' else 'train' end as split
  from keyed)
"""

HASHED = """
sided as (
  select *, case when ('0x' || substr(h, 1, 8))::bigint < 0.1::double * 4294967296 then 'test' else 'train' end as split
  from keyed)
"""

ID_OF_BYTE = """case when {b} between 33 and 126 then {b} - 31 when {b} between 161 and 172 then {b} - 65
 when {b} >= 174 then {b} - 66 when {b} <= 32 then {b} + 190 when {b} = 127 then 223
 when {b} = 173 then 257 else {b} + 96 end"""


def ids_of(text: str) -> str:
    """A list expression: the token ids of a text column's bytes."""
    one = ID_OF_BYTE.format(b="b")
    as_bytes = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::int)"
    return f"list_transform({as_bytes}, lambda b: ({one})::int)"


def ids_md5(ids: str = "ids") -> str:
    return f"md5(array_to_string({ids}, ','))"


def encoded(source: str, text: str = "text", eos: bool = True, name: str = "coded") -> str:
    ids = ids_of(text)
    return f"{name} as (select *, {f'list_append({ids}, 1)' if eos else ids} as ids from {source})"


def with_(*parts: str) -> str:
    return "with " + ",\n".join(p.strip() for p in parts) + "\n"


def with_recursive(*parts: str) -> str:
    return "with recursive " + ",\n".join(p.strip() for p in parts) + "\n"


def blocks(rows: str, keys: str, order: str, size: int) -> str:
    """Blocks per token: number the tokens of a batch, group them by block, keep the full ones."""
    return f"""
toks as (select {keys}, {order}, unnest(ids) as id, unnest(range(len(ids))) as p from {rows}),
placed as (select {keys}, id, row_number() over (partition by {keys} order by {order}, p) - 1 as k from toks),
packed as (
  select {keys}, k // {size} as block_no, list(id order by k) as ids from placed
  group by {keys}, k // {size} having count(*) = {size})
"""


BLOCK_OUT = f"block_no, len(ids)::int as n_ids, {ids_md5()} as ids_md5, true as labels_equal"

BY_ROWS = """
batched as (
  select *, (row_number() over (partition by split order by h, doc_id, line_no) - 1) // 1000 as batch_id from coded)
"""

PACKED = (LINES, EXACT, encoded("sided"), BY_ROWS, blocks("batched", "split, batch_id", "h, doc_id, line_no", 256))

MARKED = "marked as (select doc_id, replace(text, '. ', '.<|endoftext|>') || '<|pad|>' as text from documents)"

# Literals first: every piece between end-of-text literals, then the literal's id.
MARKED_IDS = f"""
pieces as (
  select doc_id, unnest(string_split(left(text, length(text) - 7), '<|endoftext|>')) as piece,
         unnest(range(len(string_split(left(text, length(text) - 7), '<|endoftext|>')))) as p from marked),
piece_ids as (select doc_id, p, {ids_of("piece")} as ids from pieces),
coded as (
  select doc_id, list_append(list_concat(flatten(list(case when p = 0 then ids else list_prepend(1, ids) end order by p)), []), 0) as ids
  from piece_ids group by doc_id)
"""

DOC_SPLIT = """
docsplit as (
  select *, case when ('0x' || substr(md5('42:' || doc_id), 1, 8))::bigint < 0.1::double * 4294967296
            then 'test' else 'train' end as split
  from documents where text is not null)
"""

DOC_TOKENS = f"""
{encoded("docsplit")},
toks as (select doc_id, split, unnest(ids) as id, unnest(range(len(ids))) as p from coded),
win as (
  select doc_id, split, p, id as a3, lag(id) over w as a2, lag(id, 2) over w as a1
  from toks window w as (partition by doc_id order by p))
"""

MODEL = """
grams as (
  select split, doc_id, 1 as gram, 0::bigint as ctx, a3 as nxt from win
  union all select split, doc_id, 2, a2::bigint, a3 from win where p >= 1
  union all select split, doc_id, 3, a1::bigint * 258 + a2, a3 from win where p >= 2),
model as materialized (
  select gram::int as gram, ctx, nxt, count(*) as n, sum(count(*)) over (partition by gram, ctx) as ctx_n
  from grams where split = 'train' group by gram, ctx, nxt)
"""

SCORED = """
test as (select doc_id, ctx, nxt, count(*) as n from grams where split = 'test' and gram = 3 group by all),
totals as (select distinct ctx, ctx_n from model where gram = 3),
pairs as (
  select t.doc_id, t.n, (coalesce(m.n, 0) + 0.01::double) / (coalesce(c.ctx_n, 0) + 2.58::double) as p
  from test t left join model m on m.gram = 3 and m.ctx = t.ctx and m.nxt = t.nxt left join totals c on c.ctx = t.ctx),
scored as (
  select doc_id, sum(n)::bigint as n_pairs, sum(-n * ln(p)) / sum(n) as loss from pairs group by doc_id)
"""

LOSS_OUT = "n_pairs, round(loss, 6) as loss, round(exp(loss), 4) as perplexity"

PROMPTS = f"""
prompts as (
  select conv_id::bigint * 4294967296 + turn as prompt_id, {ids_of("text")} as h from conversations where text is not null),
contexts as (
  select prompt_id, h, 0::bigint as c1, case when len(h) >= 1 then h[len(h)]::bigint end as c2,
         case when len(h) >= 2 then h[len(h) - 1]::bigint * 258 + h[len(h)] end as c3 from prompts)
"""

# Each stage of a generation step, in order; every one reads the one before.
STAGES = {
    "candidates": """
levels as (
  select prompt_id, h, m.nxt as id, m.gram, ln(m.n / m.ctx_n * 0.4::double ** (3 - m.gram)) as s
  from contexts c join model m
    on (m.gram = 3 and m.ctx = c.c3) or (m.gram = 2 and m.ctx = c.c2) or (m.gram = 1 and m.ctx = c.c1)),
candidates as (
  select prompt_id, id, arg_max(s, gram) as s from levels group by prompt_id, id)""",
    "penalty": """
seen as (select distinct prompt_id, unnest(h) as id from prompts),
penalty as (
  select c.prompt_id, c.id, case when x.id is null then s when s > 0 then s / 1.1::double else s * 1.1::double end as s
  from candidates c left join seen x on x.prompt_id = c.prompt_id and x.id = c.id)""",
    "no_repeat": """
fours as (
  select prompt_id, h[i:i + 2] as three, h[i + 3] as id
  from (select prompt_id, h, unnest(range(1, len(h) - 2)) as i from prompts)),
banned as (
  select distinct f.prompt_id, f.id from fours f join prompts p on p.prompt_id = f.prompt_id
  where f.three = p.h[len(p.h) - 2:len(p.h)]),
no_repeat as (
  select * from penalty c where not exists (
    select 1 from banned b where b.prompt_id = c.prompt_id and b.id = c.id))""",
    "temperature": """
raised as (
  select prompt_id, id, exp((s - max(s) over (partition by prompt_id)) / 0.7::double) as e from no_repeat),
temperature as (
  select prompt_id, id, e / sum(e) over (partition by prompt_id) as s from raised)""",
    "top_k": """
top_k as (
  select prompt_id, id, s from temperature
  qualify row_number() over (partition by prompt_id order by s desc, id) <= 40)""",
    "top_p": """
masses as (
  select *, coalesce(sum(s) over (partition by prompt_id order by s desc, id
                                  rows between unbounded preceding and 1 preceding), 0) as before,
         sum(s) over (partition by prompt_id) as whole from top_k),
top_p as (select prompt_id, id, s from masses where before < 0.9::double * whole)""",
}


def stage(upto: str) -> tuple[str, ...]:
    names = list(STAGES)
    return (DOC_SPLIT, DOC_TOKENS, MODEL, PROMPTS, *(STAGES[n] for n in names[: names.index(upto) + 1]))


def stage_rows(upto: str) -> str:
    return with_(*stage(upto)) + f"\nselect prompt_id, id as token_id, round(s, 6) as score from {upto}"


SAMPLED = """
drawn as (
  select prompt_id, id, row_number() over w as r, sum(s) over w as upto, sum(s) over (partition by prompt_id) as whole,
         ('0x' || substr(md5('42:' || prompt_id || ':0'), 1, 12))::bigint / 281474976710656.0::double as u
  from top_p window w as (partition by prompt_id order by s desc, id rows between unbounded preceding and current row)),
chosen as (select prompt_id, arg_min(id, r) as token_id from drawn where upto > u * whole group by prompt_id)
"""

WHITE = "[\\t-\\r\\x{85}\\p{Z}]"
BLACK = "[^\\t-\\r\\x{85}\\p{Z}]"

# DuckDB's regular expressions have no look-ahead: a mark set before the last space of a run that ends at a word
# splits the run where the look-ahead would.
def words_of(text: str) -> str:
    marked = f"regexp_replace({text}, '({WHITE})({WHITE}{BLACK})', '\\1' || chr(1) || '\\2', 'g')"
    other = "[^\\x01\\t-\\r\\x{85}\\p{Z}\\p{L}\\p{N}]+"
    pattern = f"''s|''t|''re|''ve|''m|''ll|''d| ?\\p{{L}}+| ?\\p{{N}}+| ?{other}|{WHITE}+"
    return f"regexp_extract_all({marked}, '{pattern}')"


WORDS = f"""
withends as (
  select unnest(regexp_extract_all(text, '[^\\n]*\\n|[^\\n]+')) as line from documents where text is not null),
words as (select unnest({words_of("line")}) as word from withends)
"""

LINE_WORDS = f"""
wordlists as (select doc_id, line_no, {words_of("text")} as ws from lines),
linewords as (select doc_id, line_no, unnest(ws) as word, unnest(range(len(ws))) as pos from wordlists)
"""

# 42 merges, one at a time: a word is a string with one character per token, the best pair is found over all words and
# replaced in all of them. Words that only occur in encoding ride along with count 0.
MERGED = """
counted as (
  select word, sum(n)::bigint as n from (
    select word, count(*) as n from words group by word union all select distinct word, 0 from linewords) group by word),
learned as (
  with recursive run as (
    select 0 as step, word, n, '' as pair,
      array_to_string(list_transform(regexp_extract_all(hex(encode(word)), '..'),
                                     lambda x: chr(65536 + byte_id[1 + ('0x' || x)::int])), '') as form
    from counted, (select list(token_id order by b) as byte_id from alphabet)
    union all
    select step + 1, word, n, best.pair, replace(form, best.pair, chr(65536 + 258 + step))
    from run, (
      select arg_min(pair, (-c, pair)) as pair from (
        select substr(form, i, 2) as pair, sum(n) as c
        from (select form, n, unnest(range(1, length(form))) as i from run) group by 1)) best
    where step < 42)
  select * from run),
rules as materialized (
  select distinct step, unicode(pair[1]) - 65536 as l, unicode(pair[2]) - 65536 as r from learned where step > 0),
tokens as (
  with recursive grown as (
    select 0 as step, list(token order by token_id) as toks from known
    union all
    select g.step + 1, list_append(toks, toks[l + 1] || toks[r + 1]) from grown g join rules on rules.step = g.step + 1)
  select toks from grown order by step desc limit 1),
forms as (
  select word, list_transform(range(1, length(form) + 1), lambda i: (unicode(substr(form, i, 1)) - 65536)::int) as ids
  from learned where step = 42)
"""

MERGED_LINES = """
joined as (
  select doc_id, line_no, flatten(list(ids order by pos)) as ids from linewords join forms using (word)
  group by doc_id, line_no)
"""


def ready_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def ready_rules(path: str) -> str:
    """The ready-made vocabulary's file as tables: ids by token, ids of the bytes, and merge rules by pair of ids."""
    return f"""
file as (select content::json as j from read_text('{path}')),
vocab as materialized (
  select unnest(map_keys(m)) as token, unnest(map_values(m)) as token_id
  from (select cast(json_extract(j, '$.model.vocab') as map(varchar, int)) as m from file)),
listed as (
  select unnest(r) as r, unnest(range(len(r))) as rank from (select json_extract(j, '$.model.merges[*]') as r from file)),
pairs as (
  select rank, case when json_type(r) = 'ARRAY' then json_extract_string(r, '$[0]') else string_split(json_extract_string(r, '$'), ' ')[1] end as a,
    case when json_type(r) = 'ARRAY' then json_extract_string(r, '$[1]') else string_split(json_extract_string(r, '$'), ' ')[2] end as b
  from listed),
ready_rules as materialized (
  select rank, chr(65536 + x.token_id) || chr(65536 + y.token_id) as pair, chr(65536 + z.token_id) as made
  from pairs join vocab x on x.token = a join vocab y on y.token = b join vocab z on z.token = a || b),
ready_bytes as (
  select list(v.token_id order by b) as byte_id from (
    select range as b, case when range between 33 and 126 or range between 161 and 172 or range >= 174 then chr(range::int)
      when range <= 32 then chr((256 + range)::int) when range between 127 and 160 then chr((256 + range - 94)::int) else chr(323) end as c
    from range(256)) s join vocab v on v.token = s.c)
"""


def ready_words(texts: str) -> str:
    """Every piece between literals as words, and every distinct word as its ids: one character for each id."""
    return f"""
pieces as (
  select doc_id, unnest(string_split(text, '<|endoftext|>')) as piece, unnest(range(len(string_split(text, '<|endoftext|>')))) as k
  from {texts} where text is not null),
piecewords as (select doc_id, k, {words_of("piece")} as ws from pieces),
docwords as (select doc_id, k, unnest(ws) as word, unnest(range(len(ws))) as pos from piecewords),
run as (
    select word, 0 as step, array_to_string(list_transform(regexp_extract_all(hex(encode(word)), '..'),
      lambda x: chr(65536 + byte_id[1 + ('0x' || x)::int])), '') as form
    from (select distinct word from docwords), ready_bytes
    union all
    select word, step, replace(form, best[1], best[2]) from (
      select word, step + 1 as step, form, arg_min([pair, made], rank) as best
      from (select word, step, form, unnest(list_transform(range(1, length(form)), lambda i: substr(form, i, 2))) as p from run)
      join ready_rules on pair = p group by word, step, form)),
readyforms as (select word, arg_max(form, step) as form from run group by word),
readydocs as (
  select p.doc_id, p.k, coalesce(string_agg(form, '' order by pos), '') as form
  from pieces p left join (docwords join readyforms using (word)) d on d.doc_id = p.doc_id and d.k = p.k group by all),
readycodes as (
  select doc_id, string_agg(form, chr(65536 + 50256) order by k) as form from readydocs group by doc_id),
readyids as (
  select doc_id, list_transform(range(1, length(form) + 1), lambda i: (unicode(substr(form, i, 1)) - 65536)::int) as ids
  from readycodes)
"""


# Hex digits of the bytes of the ids from 2 on.
BYTE_OF_ID = f"""
byte_of_id as (
  select list(upper(lpad(format('{{:x}}', b), 2, '0')) order by i) as hexes
  from (select range as b, {ID_OF_BYTE.format(b="range")} as i from range(256)))
"""


def visits(epochs: int, micro: int, accum: int) -> str:
    """Every block of ``planned`` in every epoch: blocks are numbered, and each epoch permutes the numbers."""
    def mixed(x: str, turn: int, size: str) -> str:
        y = f"(({x} + (7919 * 42 + 104729 * epoch + 1299709 * {turn}) % 2147483647) % 2147483647)"
        return f"({y} * {y} % 2147483647 * {y} % 2147483647 * 48271 % 2147483647) % {size}"

    permuted = f"""
    select batch_id, block_no, epoch, n, a, b, x // b as l0, x % b as r0, (l0 + {mixed("r0", 1, "a")}) % a as l1,
      (r0 + {mixed("l1", 2, "b")}) % b as r1, (l1 + {mixed("r1", 3, "a")}) % a as l2, (r1 + {mixed("l2", 4, "b")}) % b as r2,
      l2 * b + r2 as place from"""
    keep = "select batch_id, block_no, epoch, n, a, b, place from"
    return f"""
numbered as (
  select batch_id, block_no, row_number() over (order by md5('42:' || batch_id || ':' || block_no), batch_id, block_no) - 1 as x,
    count(*) over () as n from planned),
sides as (
  select *, ceil(n / a)::bigint as b from (
    select *, (case when floor(sqrt(n - 1)) ^ 2 > n - 1 then floor(sqrt(n - 1)) - 1 else floor(sqrt(n - 1)) end)::bigint + 1 as a from numbered)),
walk as (
  {keep} ({permuted} (select s.*, unnest(range({epochs}))::int as epoch from sides s))
  union all
  {keep} ({permuted} (select batch_id, block_no, epoch, n, a, b, place as x from walk where place >= n))),
epoch_places as (
  select batch_id, block_no, epoch, place, place // {micro} as micro_batch, place // {micro} // {accum} as step from walk where place < n)
"""


LISTING = """
listing as (
  select 'bundle-' || (doc_id // 40) as bundle, n_chars as length,
    ['config.json', 'tokenizer.json', 'tokenizer_config.json', 'special_tokens_map.json', 'onnx/model.onnx',
     'vocab.json', 'merges.txt', 'pytorch_model.bin', 'weights.pt', 'runs/events.log', '__pycache__/x.pyc',
     'onnx/decoder.onnx'][1 + ('0x' || substr(md5('3:' || doc_id), 1, 8))::bigint % 12] as rel_path
  from documents)
"""

REQUIRED = """
required as (
  select unnest(['config.json', 'tokenizer.json', 'tokenizer_config.json', 'special_tokens_map.json',
                 'onnx/model.onnx']) as path, unnest(range(5)) as nr)
"""

BYTE_ALPHABET = f"""
alphabet as (
  select b, {ID_OF_BYTE.format(b="b")} as token_id,
    chr((case when b between 33 and 126 or b between 161 and 172 or b >= 174 then b
         when b <= 32 then 256 + b when b = 127 then 289 when b = 173 then 323 else 162 + b end)::int) as token
  from (select unnest(range(256))::int as b)),
known as (
  select token_id::int as token_id, token from alphabet
  union all select 0, '<|pad|>' union all select 1, '<|endoftext|>')
"""


# All steps of generation: the stages above with the default options, once per step over the prompts still going.
GENERATED = """
gen as (
  with recursive run as (
    select prompt_id, h, 0 as step, false as done from prompts
    union all
    select r.prompt_id, case when c.token_id is null or c.token_id = 1 then r.h else list_append(r.h, c.token_id) end,
           r.step + 1, c.token_id is null or c.token_id = 1
    from run r left join (
      with going as (select prompt_id, h, step, h[len(h) - 2:len(h)] as ending from run where not done),
      levels as (
        select prompt_id, m.nxt as id, 3 as gram, ln(m.n / m.ctx_n) as s from going join model m
          on m.gram = 3 and len(h) >= 2 and m.ctx = h[len(h) - 1]::bigint * 258 + h[len(h)]
        union all
        select prompt_id, m.nxt, 2, ln(m.n / m.ctx_n * 0.4::double) from going join model m
          on m.gram = 2 and len(h) >= 1 and m.ctx = h[len(h)]::bigint
        union all
        select prompt_id, m.nxt, 1, ln(m.n / m.ctx_n * (0.4::double * 0.4::double)) from going join model m
          on m.gram = 1 and m.ctx = len(h) * 0),
      found as (select prompt_id, id, arg_max(s, gram) as s from levels group by prompt_id, id),
      seen as (select distinct prompt_id, unnest(h) as id from going),
      fours as (
        select prompt_id, ending, h[i:i + 2] as three, h[i + 3] as id
        from (select prompt_id, h, ending, unnest(range(1, len(h) - 2)) as i from going)),
      banned as (select distinct prompt_id, id from fours where three = ending),
      shrunk as (
        select f.prompt_id, f.id, case when x.id is null then s when s > 0 then s / 1.1::double else s * 1.1::double end as s
        from found f left join seen x on x.prompt_id = f.prompt_id and x.id = f.id
        left join banned b on b.prompt_id = f.prompt_id and b.id = f.id where b.id is null),
      raised as (
        select prompt_id, id, exp((s - max(s) over (partition by prompt_id)) / 0.7::double) as e from shrunk),
      shares as (select prompt_id, id, e / sum(e) over (partition by prompt_id) as s from raised),
      masses as (
        select *, coalesce(sum(s) over (partition by prompt_id order by s desc, id
                                        rows between unbounded preceding and 1 preceding), 0) as before,
               sum(s) over (partition by prompt_id) as whole from shares),
      top_p as (select prompt_id, id, s from masses where before < 0.9::double * whole),
      drawn as (
        select t.prompt_id, id, row_number() over w as r, sum(s) over w as upto,
               sum(s) over (partition by t.prompt_id) as whole,
               ('0x' || substr(md5('42:' || t.prompt_id || ':' || g.step), 1, 12))::bigint / 281474976710656.0::double as u
        from top_p t join going g on g.prompt_id = t.prompt_id
        window w as (partition by t.prompt_id order by s desc, id rows between unbounded preceding and current row))
      select prompt_id, arg_min(id, r) as token_id from drawn where upto > u * whole group by prompt_id
    ) c on c.prompt_id = r.prompt_id
    where not r.done and r.step < 80)
  select prompt_id, arg_max(h, step) as h from run group by prompt_id)
"""


def line_tokens() -> tuple[str, ...]:
    return (LINES, encoded("lines"), "used as (select id, count(*) as n from (select unnest(ids) as id from coded) group by id)")


def registry() -> dict[str, str]:
    merging = (LINES, WORDS, LINE_WORDS, BYTE_ALPHABET, MERGED)
    found = {
        "line_scan": with_(LINES)
        + "select doc_id, line_no, length(text)::int as n_chars, md5(text) as text_md5 from lines",
        "run_names": """
select page_id, 'byte-' || coalesce(case when page_id % 3 = 0 then 'tag' || page_id end,
  regexp_extract(regexp_extract(url, '^([^?#]*)', 1), '([^/]+?)(\\.[^./]*)?$', 1)) as run_name from pages""",
        "compile_sources": f"""
with t as (select source, doc_id as ord, regexp_replace(text, '\\r\\n?', {NL}, 'g') as text
           from documents where text is not null)
select source, ord, coalesce(sum(length(text) + 2) over (partition by source order by ord
  rows between unbounded preceding and 1 preceding), 0)::bigint as char_offset, md5(text) as text_md5 from t""",
        "compile_conversations": f"""
with t as (select conv_id, turn as ord, regexp_replace(text, '\\r\\n?', {NL}, 'g') as text
           from conversations where text is not null)
select conv_id, ord, coalesce(sum(length(text) + 2) over (partition by conv_id order by ord
  rows between unbounded preceding and 1 preceding), 0)::bigint as char_offset, md5(text) as text_md5 from t""",
        "compile_summary": f"""
select source, count(text) as kept, count(*) - count(text) as rejected,
  strlen(string_agg(regexp_replace(text, '\\r\\n?', {NL}, 'g'), {NL} || {NL}))::bigint as bytes
from documents group by source""",
        "split_exact": with_(LINES, EXACT) + "select doc_id, line_no, split from sided",
        "split_hash": with_(LINES, HASHED) + "select doc_id, line_no, split from sided",
        "split_grouped": with_(LINES)
        + """select doc_id, line_no, case when ('0x' || substr(md5('42:' || doc_id), 1, 8))::bigint
        < 0.1::double * 4294967296 then 'test' else 'train' end as split from lines""",
        "shuffle_order": with_(LINES, EXACT)
        + """select doc_id, line_no, split,
        row_number() over (partition by split order by h, doc_id, line_no) - 1 as rn from sided""",
        "byte_vocab": with_(*line_tokens(), BYTE_ALPHABET)
        + "select token_id, token, coalesce(n, 0) as n from known left join used on id = token_id",
        "special_tokens": with_(*line_tokens())
        + """select role, literal, token_id, coalesce(n, 0) as n
        from (values ('pad', '<|pad|>', 0), ('eos', '<|endoftext|>', 1), ('bos', '<|endoftext|>', 1))
          roles(role, literal, token_id) left join used on id = token_id""",
        "word_counts": with_(WORDS) + "select word, count(*) as n from words group by word",
        "bpe_merges": with_(*merging)
        + """select (step - 1)::int as rank, toks[l + 1] as left, toks[r + 1] as right from rules, tokens""",
        "bpe_vocab": with_(*merging)
        + "select unnest(range(len(toks)))::int as token_id, unnest(toks) as token from tokens",
        "bpe_encode": with_(*merging, MERGED_LINES)
        + f"""select doc_id, line_no, coalesce(len(ids), 0)::int as n_ids, {ids_md5("coalesce(ids, [])")} as ids_md5
        from lines left join joined using (doc_id, line_no)""",
        "bpe_blocks": with_(
            *merging,
            EXACT,
            MERGED_LINES,
            """rowids as (select s.*, coalesce(j.ids, []) as ids from sided s left join joined j using (doc_id, line_no)),
cuts as (select *, unnest(range(greatest(1, ceil(len(ids) / 512)::bigint))) as chunk_no from rowids),
chunks as (
  select split, h, doc_id, line_no, chunk_no, ids[chunk_no * 512 + 1:chunk_no * 512 + 512] as ids from cuts),
batched as (
  select *, (row_number() over (partition by split order by h, doc_id, line_no, chunk_no) - 1) // 1000 as batch_id
  from chunks)""",
            blocks("batched", "split, batch_id", "h, doc_id, line_no, chunk_no", 512),
        )
        + f"select split, batch_id, {BLOCK_OUT} from packed",
        "byte_encode": with_(LINES, encoded("lines"))
        + f"select doc_id, line_no, len(ids)::int as n_ids, {ids_md5()} as ids_md5 from coded",
        "special_literals": with_(MARKED, MARKED_IDS)
        + f"select doc_id, len(ids)::int as n_ids, {ids_md5()} as ids_md5 from coded",
        "decode_roundtrip": with_(MARKED)
        + """select doc_id, md5(text) as text_md5,
        md5(replace(replace(text, '<|endoftext|>', ''), '<|pad|>', '')) as plain_md5 from marked""",
        "coverage": "select lang, count(text) as n_rows, 0::bigint as n_broken from documents group by lang",
        "inspect_encoding": with_(encoded("benchmark", eos=False))
        + "select item_id, text, array_to_string(ids, ',') as ids from coded",
        "token_stats": """
select lang, source, count(text) as n_rows, sum(strlen(text))::bigint as n_tokens,
  sum(length(text))::bigint as n_chars, max(strlen(text)) as max_tokens
from documents group by rollup (lang, source)""",
        "id_frequency": with_(encoded("documents", eos=False))
        + "select lang, token_id, count(*) as n from (select lang, unnest(ids) as token_id from coded) group by all",
        "frequent_ids": with_(encoded("documents"))
        + """select token_id, count(*) as n from (select unnest(ids) as token_id from coded) group by token_id
        order by n desc, token_id limit 20""",
        "overflow_chunks": with_(
            encoded("documents", eos=False),
            "cuts as (select doc_id, ids, unnest(range(greatest(1, ceil(len(ids) / 512)::bigint))) as c from coded)",
            "chunks as (select doc_id, c::int as chunk_no, ids[c * 512 + 1:c * 512 + 512] as ids from cuts)",
        )
        + f"select doc_id, chunk_no, len(ids)::int as n_ids, {ids_md5()} as ids_md5 from chunks",
        "pack_blocks": with_(*PACKED) + f"select split, batch_id, {BLOCK_OUT} from packed",
        "pack_hash": with_(
            LINES,
            HASHED,
            encoded("sided"),
            """batched as (
  select *, ('0x' || substr(h, 1, 12))::bigint % ceil(count(*) over () / 1000)::bigint as batch_id from coded)""",
            blocks("batched", "split, batch_id", "h, doc_id, line_no", 256),
        )
        + f"select split, batch_id, {BLOCK_OUT} from packed",
        "pack_sources": with_(LINES, encoded("keyed"), blocks("coded", "source", "h, doc_id, line_no", 256))
        + f"select source, {BLOCK_OUT} from packed",
        "pack_document_order": with_(
            LINES,
            encoded("lines"),
            "batched as (select *, (row_number() over (order by doc_id, line_no) - 1) // 1000 as batch_id from coded)",
            blocks("batched", "batch_id", "doc_id, line_no", 256),
        )
        + f"select batch_id, {BLOCK_OUT} from packed",
        "pack_report": with_(LINES, EXACT, encoded("sided"), BY_ROWS)
        + """select split, batch_id, sum(len(ids))::bigint as n_tokens, (sum(len(ids)) // 256)::bigint as n_blocks,
        (sum(len(ids)) // 256 * 256)::bigint as kept, (sum(len(ids)) % 256)::bigint as dropped
        from batched group by split, batch_id""",
        "map_batches": with_(LINES, EXACT, encoded("sided"), BY_ROWS)
        + """select split, batch_id, count(*) as n_rows, max(len(ids))::int as longest
        from batched group by split, batch_id""",
        "collate_pad": with_(
            """turns as (
  select *, (row_number() over (order by md5('42:' || conv_id || ':' || turn), conv_id, turn) - 1) // 8 as micro_batch
  from conversations where text is not null)""",
            encoded("turns"),
            "sized as (select *, (max(len(ids)) over (partition by micro_batch) - len(ids))::bigint as gap from coded)",
            "padded as (select *, list_concat(ids, list_transform(range(gap), lambda i: 1)) as full_ids from sized)",
        )
        + f"""select conv_id, turn, micro_batch, {ids_md5("full_ids")} as ids_md5,
        md5(array_to_string(list_concat(list_transform(ids, lambda i: 1), list_transform(range(gap), lambda i: 0)), ','))
          as mask_md5,
        md5(array_to_string(list_transform(full_ids, lambda i: case when i = 1 then -100 else i end), ',')) as labels_md5
        from padded""",
        "next_token_pairs": with_(
            encoded("benchmark"),
            "places as (select item_id, ids, unnest(range(greatest(0, len(ids) - 3)))::int as place from coded)",
        )
        + """select item_id, place, array_to_string(ids[place + 1:place + 3], ',') as context,
        ids[place + 4] as target from places""",
        "epoch_manifest": with_recursive(
            *PACKED,
            "planned as (select batch_id, block_no from packed where split = 'train')",
            visits(30, 8, 4),
        )
        + "select batch_id, block_no, epoch, place, micro_batch, step from epoch_places",
        "lr_schedule": with_(
            LINES,
            EXACT,
            encoded("sided"),
            BY_ROWS,
            """sizes as (select sum(len(ids)) // 256 as n from batched where split = 'train' group by batch_id),
run as (select 30 * ceil(ceil(sum(n) / 8) / 4)::bigint as t, ceil(0.1::double * t)::bigint as w from sizes),
steps as (select t, w, unnest(range(t)) as s from run)""",
        )
        + """select s + 1 as step, round(1e6::double * 3e-4::double * case when s < w then s / greatest(1, w)
          else greatest(0, 0.5::double * (1 + cos(pi() * ((s - w) / greatest(1, t - w))))) end, 6) as rate,
        (s + 1) % 10 = 0 as logs, (s + 1) % 200 = 0 as evaluates, (s + 1) % 200 = 0 as saves from steps""",
        "ngram_counts": with_(DOC_SPLIT, DOC_TOKENS, MODEL) + "select gram, ctx, nxt, n from model",
        "ngram_probs": with_(DOC_SPLIT, DOC_TOKENS, MODEL)
        + """select gram, ctx, nxt, n, ctx_n::bigint as ctx_n, round(n / ctx_n, 6) as share,
        round((n + 0.01::double) / (ctx_n + 2.58::double), 6) as p from model""",
        "heldout_loss": with_(
            *PACKED,
            """flat as (select split, batch_id, block_no, unnest(ids) as id, unnest(range(256)) as q from packed),
tri as (
  select split, q, lag(id, 2) over w * 258 + lag(id) over w as ctx, id as nxt from flat
  window w as (partition by split, batch_id, block_no order by q)),
train as (
  select ctx, nxt, count(*) as n, sum(count(*)) over (partition by ctx) as ctx_n
  from tri where split = 'train' and q >= 2 group by ctx, nxt),
totals as (select distinct ctx, ctx_n from train),
test as (select ctx, nxt, count(*) as n from tri where split = 'test' and q >= 2 group by ctx, nxt),
pairs as (
  select t.n, (coalesce(m.n, 0) + 0.01::double) / (coalesce(c.ctx_n, 0) + 2.58::double) as p
  from test t left join train m on m.ctx = t.ctx and m.nxt = t.nxt left join totals c on c.ctx = t.ctx),
scored as (select sum(n)::bigint as n_pairs, sum(-n * ln(p)) / sum(n) as loss from pairs)""",
        )
        + f"select {LOSS_OUT} from scored",
        "learning_curve": with_(
            DOC_SPLIT,
            DOC_TOKENS,
            """tri as (
  select split, (('0x' || substr(md5('7:' || doc_id), 1, 8))::bigint % 4)::int as part, a1 * 258 + a2 as ctx, a3 as nxt
  from win where p >= 2),
parts as (select unnest(range(4))::int as part),
train as (select part, ctx, nxt, count(*) as n from tri where split = 'train' group by all),
fits as (
  select s.part, ctx, nxt, sum(n) as n from parts s join train t on t.part <= s.part group by s.part, ctx, nxt),
totals as (select part, ctx, sum(n) as ctx_n from fits group by part, ctx),
test as (select ctx, nxt, count(*) as n from tri where split = 'test' group by all),
pairs as (
  select s.part, t.n, (coalesce(m.n, 0) + 0.01::double) / (coalesce(c.ctx_n, 0) + 2.58::double) as p
  from parts s cross join test t left join fits m on m.part = s.part and m.ctx = t.ctx and m.nxt = t.nxt
  left join totals c on c.part = s.part and c.ctx = t.ctx),
scored as (select part, sum(n)::bigint as n_pairs, sum(-n * ln(p)) / sum(n) as loss from pairs group by part)""",
        )
        + f"select part, {LOSS_OUT} from scored",
        "doc_scores": with_(DOC_SPLIT, DOC_TOKENS, MODEL, SCORED) + f"select doc_id, {LOSS_OUT} from scored",
        "worst_documents": with_(DOC_SPLIT, DOC_TOKENS, MODEL, SCORED)
        + f"select doc_id, {LOSS_OUT} from scored order by round(loss, 6) desc, doc_id limit 20",
        "label_loss": with_(DOC_SPLIT, DOC_TOKENS, MODEL, SCORED)
        + """select quality, sum(n_pairs)::bigint as n_pairs, round(sum(loss * n_pairs) / sum(n_pairs), 6) as loss
        from scored join labels using (doc_id) group by quality""",
        "prompt_context": with_(PROMPTS)
        + "select prompt_id, len(h)::int as n_ids, c1 as ctx1, c2 as ctx2, c3 as ctx3 from contexts",
        "sample_step": with_(*stage("top_p"), SAMPLED)
        + """select p.prompt_id, coalesce(token_id, -1) in (-1, 1) as done,
        case when token_id <> 1 then token_id end as token_id from prompts p left join chosen c on c.prompt_id = p.prompt_id""",
        "greedy_step": with_(
            *stage("no_repeat"),
            "chosen as (select prompt_id, id as token_id from no_repeat"
            " qualify row_number() over (partition by prompt_id order by s desc, id) = 1)",
        )
        + """select p.prompt_id, coalesce(token_id, -1) in (-1, 1) as done,
        case when token_id <> 1 then token_id end as token_id from prompts p left join chosen c on c.prompt_id = p.prompt_id""",
        "generate_ids": with_(DOC_SPLIT, DOC_TOKENS, MODEL, PROMPTS, GENERATED)
        + f"""select prompt_id, (len(g.h) - len(p.h))::int as n_new, {ids_md5("g.h")} as ids_md5
        from gen g join prompts p using (prompt_id)""",
        "bundle_audit": with_(
            LISTING,
            REQUIRED,
            "bundles as (select bundle, list(rel_path) as paths from listing group by bundle)",
            """judged as (
  select bundle, array_to_string((select list(path order by nr) from required where not list_contains(paths, path)), ',')
           as gaps, list_contains(paths, 'vocab.json') as has_vocab, list_contains(paths, 'merges.txt') as has_merges
  from bundles)""",
        )
        + """select bundle, coalesce(gaps, '') as missing, has_vocab, has_merges,
        case when coalesce(gaps, '') <> '' or (has_merges and not has_vocab) then 'error'
             when not has_merges and not has_vocab then 'warning' else 'ok' end as status from judged""",
        "bundle_missing": with_(LISTING, REQUIRED)
        + """select b.bundle, path as missing from (select distinct bundle from listing) b cross join required r
        where not exists (select 1 from listing l where l.bundle = b.bundle and l.rel_path = r.path)""",
        "bundle_upload": with_(LISTING)
        + """select bundle, count(*) as n_files, sum(length)::bigint as length from listing
        where not (ends_with(rel_path, '.pt') or ends_with(rel_path, '.bin') or starts_with(rel_path, '__pycache__/')
                   or starts_with(rel_path, 'runs/')) group by bundle""",
        "bundle_export": with_(LISTING)
        + """select bundle, rel_path, count(*) as n_files from listing
        where rel_path in ('config.json', 'tokenizer.json', 'tokenizer_config.json', 'special_tokens_map.json',
                           'merges.txt', 'vocab.json', 'onnx/model.onnx') group by bundle, rel_path""",
    }
    for name in STAGES:
        found[name] = stage_rows(name)
    found["blocks_readback"] = found["pack_hash"]
    found["corpora_readback"] = f"""
with texts as (
  select source, string_agg(regexp_replace(text, '\\r\\n?', {NL}, 'g'), {NL} || {NL} order by doc_id) as t
  from documents where text is not null group by source),
split_lines as (select source, unnest(string_split(t, {NL})) as line from texts)
select source, count(*) as n_lines, sum(length(line))::bigint as n_chars,
  sum(('0x' || substr(md5(line), 1, 8))::bigint)::bigint as line_sum from split_lines group by source"""
    found["vocab_readback"] = (
        with_(*merging, "named as (select unnest(toks) as token, unnest(range(len(toks)))::int as token_id from tokens)")
        + "select token_id, token, case when token_id >= 258 then token_id - 258 end as rank from named"
    )
    rules = ready_rules(ready_file())
    found["bpe_encode_ready"] = (
        with_recursive(MARKED, rules, ready_words("marked"))
        + f"""select doc_id, len(ids)::int as n_ids, {ids_md5()} as ids_md5, md5(replace(text, '<|endoftext|>', '')) as plain_md5
        from readyids join marked using (doc_id)"""
    )
    lines = "readylines as (select doc_id * 1000000 + line_no as doc_id, text from lines)"
    sizes = """
sized as (
  select s.split, s.h, s.doc_id, s.line_no, coalesce(len(r.ids), 0) as n from sided s
  left join readyids r on r.doc_id = s.doc_id * 1000000 + s.line_no),
cuts as (select *, unnest(range(greatest(1, ceil(n / 512)::bigint))) as chunk_no from sized),
rowsizes as (
  select split, least(512, n - chunk_no * 512) as n,
    (row_number() over (partition by split order by h, doc_id, line_no, chunk_no) - 1) // 1000 as batch_id from cuts),
full_blocks as (select split, batch_id, sum(n)::bigint // 512 as n_blocks from rowsizes group by all),
planned as (select batch_id, unnest(range(n_blocks)) as block_no from full_blocks where split = 'train')
"""
    steps = (LINES, EXACT, lines, rules, ready_words("readylines"), sizes)
    found["word_manifest"] = with_recursive(*steps, visits(15, 4, 8)) + "select batch_id, block_no, epoch, place, micro_batch, step from epoch_places"
    found["word_schedule"] = (
        with_recursive(
            *steps,
            """totals as (select 15 * ceil(ceil(count(*) / 4) / 8)::bigint as t, ceil(0.1::double * t)::bigint as w from planned),
turns as (select t, w, unnest(range(t)) as s from totals)""",
        )
        + """select s + 1 as step, round(1e6::double * 3e-4::double * case when s < w then s / greatest(1, w)
          else greatest(0, 0.5::double * (1 + cos(pi() * ((s - w) / greatest(1, t - w))))) end, 6) as rate,
        true as logs, (s + 1) % 50 = 0 as evaluates, (s + 1) % 100 = 0 as saves from turns"""
    )
    found["heldout_loss_ready"] = (
        with_recursive(
            DOC_SPLIT,
            rules,
            ready_words("docsplit"),
            """
coded as (select s.split, s.doc_id, coalesce(r.ids, []) as ids from docsplit s left join readyids r using (doc_id)),
orders as (select unnest([1, 4, 6])::int as gram),
grams as (
  select split, gram, array_to_string(ids[i - gram + 1 : i - 1], ',') as ctx, ids[i] as nxt
  from (select split, gram, ids, unnest(range(gram, len(ids) + 1)) as i from coded, orders)),
train as materialized (select gram, ctx, nxt, count(*) as n from grams where split = 'train' group by all),
totals as (select gram, ctx, sum(n) as ctx_n from train group by all),
losses as (
  select t.gram, t.n, (coalesce(m.n, 0) + 0.01::double) / (coalesce(c.ctx_n, 0) + 0.01::double * 50257) as p
  from (select gram, ctx, nxt, count(*) as n from grams where split = 'test' group by all) t
  left join train m using (gram, ctx, nxt) left join totals c using (gram, ctx)),
scored as (select gram, sum(n)::bigint as n_pairs, sum(-n * ln(p)) / sum(n) as loss from losses group by gram)""",
        )
        + f"select gram, {LOSS_OUT} from scored"
    )
    found["generate"] = (
        with_(DOC_SPLIT, DOC_TOKENS, MODEL, PROMPTS, GENERATED, BYTE_OF_ID)
        + """select prompt_id, (len(g.h) - len(p.h))::int as n_new, raw as generated_hex,
        len(list_filter(regexp_extract_all(regexp_replace(raw, '(..)', '\\1 ', 'g'), '.. '), lambda x: true)) = length(raw) // 2 and
        regexp_full_match(regexp_replace(raw, '(..)', '\\1,', 'g'), '([0-7].,|(C[2-9A-F]|D.),[89AB].,|E0,[AB].,[89AB].,|(E[1-9A-CEF]),[89AB].,[89AB].,|ED,[89].,[89AB].,|F0,[9AB].,[89AB].,[89AB].,|F[1-3],[89AB].,[89AB].,[89AB].,|F4,8.,[89AB].,[89AB].,)*') as whole_characters
        from (select prompt_id, h, array_to_string(list_transform(list_filter(h, lambda i: i > 1), lambda i: hexes[i - 1]), '') as raw from gen, byte_of_id) g
        join prompts p using (prompt_id)"""
    )
    found["ready_vocab"] = (
        with_recursive(rules, ready_words("documents"))
        + """, used as (select id, count(*) as n from (select unnest(ids) as id from readyids) group by id)
        select role, token, token_id, coalesce(n, 0) as n from (
          select 'word' as role, token, token_id from vocab where token_id <> 50256
          union all select unnest(['pad', 'eos', 'bos']), '<|endoftext|>', 50256) left join used on id = token_id"""
    )
    return found
