"""Decoding filters (G2-G8) over all prompts of an Arrow batch at once.

The candidates of many prompts lie side by side in flat arrays, and every filter is one pass over them: a segmented sort, a
segmented running sum, a segmented draw. ``sampling`` has the same filters for one prompt. What is two-dimensional (ids
seen, histories, running sums) is cut into portions of rows of at most ``CELLS`` cells.

Where prompts run to their end beside a copy of the model, ``Merged`` keeps the merged levels of every context met, and
the filters run over rows of that matrix.
"""

import hashlib
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

from tokenloom.functions import kernels
from tokenloom.functions.sampling import BACKOFF, EOS_ID, STAGES, Options, uniform

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CELLS = 1 << 20
# Of the matrix of merged contexts that is kept from step to step.
KEPT_CELLS = 1 << 22
Lists = tuple[np.ndarray, np.ndarray, np.ndarray]


@dataclass
class Candidates:
    """Ids and scores of the candidates of ``n`` prompts, ordered by prompt (``row``)."""

    row: np.ndarray
    ids: np.ndarray
    scores: np.ndarray
    n: int

    def keep(self, which: np.ndarray) -> "Candidates":
        return Candidates(self.row[which], self.ids[which], self.scores[which], self.n)

    def place(self) -> np.ndarray:
        """0, 1, ... within each prompt."""
        return np.arange(len(self.row)) - np.searchsorted(self.row, self.row)

    def running(self) -> tuple[np.ndarray, np.ndarray]:
        """Running sum of the scores within each prompt, and each prompt's whole sum."""
        place = self.place()
        grid = np.zeros((self.n, 1 + place.max(initial=0)))
        grid[self.row, place] = self.scores
        np.cumsum(grid, axis=1, out=grid)
        return grid[self.row, place], grid[:, -1]


@dataclass
class Prompts:
    """Histories as rows of a matrix with room to grow, their lengths, and which ids each holds."""

    ids: np.ndarray
    length: np.ndarray
    seen: np.ndarray

    @classmethod
    def of(cls, offsets: np.ndarray, items: np.ndarray, n_ids: int, room: int) -> "Prompts":
        length = np.diff(offsets)
        row = np.repeat(np.arange(len(length)), length)
        ids = np.full((len(length), max(1, length.max(initial=0) + room)), -1, np.int16 if n_ids < 1 << 15 else np.int32)
        ids[row, np.arange(len(items)) - np.repeat(offsets[:-1] - offsets[0], length)] = items
        seen = np.zeros((len(length), n_ids), bool)
        seen[row, items] = True
        return cls(ids, length, seen)

    def some(self, rows: np.ndarray) -> "Prompts":
        return Prompts(self.ids[rows], self.length[rows], self.seen[rows])

    def put(self, rows: np.ndarray, others: "Prompts") -> None:
        """Take over the histories of ``others`` as ``rows``."""
        self.ids[rows], self.length[rows] = others.ids, others.length

    def append(self, rows: np.ndarray, new: np.ndarray) -> None:
        self.ids[rows, self.length[rows]] = new
        self.seen[rows, new] = True
        self.length[rows] += 1

    def context(self, gram: int, n_ids: int) -> np.ndarray:
        """The last gram-1 ids as one number, -1 where the history is shorter."""
        rows, number = np.arange(len(self.length)), np.zeros(len(self.length), np.int64)
        for back in range(gram - 1, 0, -1):
            number = number * n_ids + self.ids[rows, np.maximum(self.length - back, 0)]
        return np.where(self.length >= gram - 1, number, -1)


def merge_levels(levels: list[Lists], n: int) -> Candidates:
    """G2, stupid back-off: an id takes its share from the longest context it follows, times BACKOFF per level down.

    ``levels`` holds (offsets, ids, shares) per context length, longest first.
    """
    row = np.concatenate([np.repeat(np.arange(n), np.diff(offsets)) for offsets, _, _ in levels])
    ids = np.concatenate([ids for _, ids, _ in levels]).astype(np.int64)
    down = np.repeat(np.arange(len(levels)), [len(ids) for _, ids, _ in levels])
    scores = np.concatenate([np.log(shares * BACKOFF**k) for k, (_, _, shares) in enumerate(levels)])
    order = np.lexsort((down, ids, row))
    row, ids, scores = row[order], ids[order], scores[order]
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | (ids[1:] != ids[:-1])
    return Candidates(row, ids, scores, n).keep(first)


def penalise(c: Candidates, prompts: Prompts, penalty: float) -> Candidates:
    """Scores of ids already seen shrink: positive ones are divided, negative ones multiplied."""
    shrunk = np.where(c.scores > 0, c.scores / penalty, c.scores * penalty)
    return Candidates(c.row, c.ids, np.where(prompts.seen[c.row, c.ids], shrunk, c.scores), c.n)


def repeats(prompts: Prompts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Prompts (by row) and ids that would complete an n-gram the history already holds."""
    rows = np.flatnonzero(prompts.length >= size)
    if not size or not len(rows):
        return rows[:0], rows[:0]
    some = prompts if len(rows) == len(prompts.length) else prompts.some(rows)
    ids, length = some.ids, some.length
    starts = np.arange(length.max() - size + 1)
    same = starts <= (length - size)[:, None]
    for i in range(size - 1):
        last = ids[np.arange(len(rows)), length - size + 1 + i]
        same &= ids[:, i : i + len(starts)] == last[:, None]
    row, start = np.nonzero(same)
    return rows[row], ids[row, start + size - 1]


def ban_repeats(c: Candidates, prompts: Prompts, size: int) -> Candidates:
    """Drop ids that would complete an n-gram the history already holds."""
    rows, ids = repeats(prompts, size)
    if not len(rows):
        return c
    banned = np.zeros((c.n, prompts.seen.shape[1]), bool)
    banned[rows, ids] = True
    return c.keep(~banned[c.row, c.ids])


def as_probabilities(c: Candidates, temperature: float) -> Candidates:
    """Divide log-scores by the temperature and renormalise; 0 keeps the best only. Best first, ties by id."""
    c = c.keep(np.lexsort((c.ids, -c.scores, c.row)))
    first = np.searchsorted(c.row, c.row)
    if temperature == 0:
        best = c.keep(first == np.arange(len(first)))
        return Candidates(best.row, best.ids, np.ones(len(best.row)), c.n)
    shares = Candidates(c.row, c.ids, np.exp((c.scores - c.scores[first]) / temperature), c.n)
    return Candidates(c.row, c.ids, shares.scores / shares.running()[1][c.row], c.n)


def keep_top_k(c: Candidates, k: int) -> Candidates:
    """The k best; 0 keeps all."""
    return c.keep(c.place() < k) if k else c


def keep_top_p(c: Candidates, p: float) -> Candidates:
    """The shortest best-first list whose part of the whole mass reaches p."""
    upto, whole = c.running()
    first = c.place() == 0
    before = np.where(first, 0.0, np.r_[0.0, upto[:-1]] if len(upto) else upto)
    return c.keep(before < p * whole[c.row])


def draw(c: Candidates, u: np.ndarray) -> np.ndarray:
    """The first id whose running mass exceeds ``u`` times the whole mass; -1 if there is no candidate."""
    upto, whole = c.running()
    size = np.bincount(c.row, minlength=c.n)
    passed = np.bincount(c.row, weights=upto <= (u * whole)[c.row], minlength=c.n).astype(np.int64)
    out = np.full(c.n, -1, np.int64)
    some = np.flatnonzero(size)
    out[some] = c.ids[(np.cumsum(size) - size)[some] + np.minimum(passed, size - 1)[some]]
    return out


def filtered(levels: list[Lists], prompts: Prompts, options: Options, upto: str = STAGES[-1]) -> Candidates:
    """The candidates after the filters up to ``upto``, in their fixed order."""
    temperature = options.temperature if options.do_sample else 0
    filters = (
        lambda c: c,
        lambda c: penalise(c, prompts, options.repetition_penalty),
        lambda c: ban_repeats(c, prompts, options.no_repeat_ngram_size),
        lambda c: as_probabilities(c, temperature),
        lambda c: keep_top_k(c, options.top_k),
        lambda c: keep_top_p(c, options.top_p),
    )
    c = merge_levels(levels, len(prompts.length))
    for apply in filters[: STAGES.index(upto) + 1]:
        c = apply(c)
    return c


def next_ids(levels: list[Lists], prompts: Prompts, options: Options, names: np.ndarray, steps: np.ndarray) -> np.ndarray:
    u = np.array([uniform(options.seed, name, step) for name, step in zip(names.tolist(), steps.tolist())])
    return draw(filtered(levels, prompts, options), u)


def portions(offsets: np.ndarray, n_ids: int, room: int = 0) -> list[tuple[int, int]]:
    """Ranges of rows whose matrices stay below ``CELLS`` cells, as long as a single row does."""
    sizes, low, out = np.diff(offsets), 0, []
    while low < len(sizes):
        high = low + max(1, CELLS // max(n_ids, int(sizes[low]) + room))
        high = low + max(1, CELLS // max(n_ids, int(sizes[low:high].max()) + room))
        out.append((low, min(high, len(sizes))))
        low = high
    return out


def cut_lists(lists: Lists, low: int, high: int) -> Lists:
    offsets, *items = lists
    return (offsets[low : high + 1] - offsets[low], *(x[offsets[low] : offsets[high]] for x in items))


def batch_lists(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    column = batch.column(name)
    flat, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy().astype(np.int64)
    return offsets - offsets[0], flat[offsets[0] : offsets[-1]]


def looked_up(batch: pa.RecordBatch, grams: int, n_ids: int, room: int):
    """Portions of a batch of looked-up prompts: rows, prompts, and the levels from columns ids<gram> and shares<gram>."""
    offsets, items = batch_lists(batch, "history")
    levels = [(*batch_lists(batch, f"ids{g}"), batch_lists(batch, f"shares{g}")[1]) for g in range(grams, 0, -1)]
    for low, high in portions(offsets, n_ids, room):
        own, ids = cut_lists((offsets, items), low, high)
        yield slice(low, high), Prompts.of(own, ids, n_ids, room), [cut_lists(x, low, high) for x in levels]


def stage_rows(options: Options, grams: int, upto: str, n_ids: int):
    """Looked-up prompts -> one row per candidate left after the named filter."""

    def run(batches):
        for batch in batches:
            names = batch.column("prompt_id").to_numpy()
            for rows, prompts, levels in looked_up(batch, grams, n_ids, 0):
                c = filtered(levels, prompts, options, upto)
                columns = [pa.array(names[rows][c.row]), pa.array(c.ids.astype(np.int32)), pa.array(c.scores)]
                yield pa.RecordBatch.from_arrays(columns, names=["prompt_id", "token_id", "score"])

    return run


def one_step(options: Options, grams: int, n_ids: int, eos_id: int = EOS_ID):
    """Looked-up prompts -> the state after one more id each. End-of-text, or no candidate left, ends a prompt."""

    def run(batches):
        for batch in batches:
            names, steps = batch.column("prompt_id").to_numpy(), batch.column("n_new").to_numpy()
            for rows, prompts, levels in looked_up(batch, grams, n_ids, 1):
                new = next_ids(levels, prompts, options, names[rows], steps[rows])
                done = (new == -1) | (new == eos_id)
                prompts.append(np.flatnonzero(~done), new[~done])
                yield state_batch(names[rows], prompts, steps[rows] + ~done, done)

    return run


def state_batch(names: np.ndarray, prompts: Prompts, n_new: np.ndarray, done: np.ndarray) -> pa.RecordBatch:
    held = np.arange(prompts.ids.shape[1]) < prompts.length[:, None]
    offsets = np.r_[0, np.cumsum(prompts.length)].astype(np.int32)
    history = pa.ListArray.from_arrays(pa.array(offsets), pa.array(prompts.ids[held].astype(np.int32)))
    columns = [pa.array(names), history, pa.array(n_new.astype(np.int32)), pa.array(done)]
    return pa.RecordBatch.from_arrays(columns, names=["prompt_id", "history", "n_new", "done"])


class Contexts:
    """A model in look-up form: the sorted contexts of one gram, and the ids and shares of each side by side."""

    def __init__(self, table: pa.Table):
        table = table.sort_by("ctx").combine_chunks()
        self.keys = table["ctx"].to_numpy()
        batch = table.to_batches()[0] if len(table) else None
        self.offsets, self.ids = batch_lists(batch, "ids") if batch else (np.zeros(1, np.int64), np.zeros(0, np.int64))
        self.shares = batch_lists(batch, "shares")[1] if batch else np.zeros(0)

    def of(self, context: np.ndarray) -> Lists:
        at = np.minimum(np.searchsorted(self.keys, context), max(0, len(self.keys) - 1))
        hit = self.keys[at] == context if len(self.keys) else np.zeros(len(context), bool)
        sizes = np.where(hit, self.offsets[at + hit] - self.offsets[at], 0)
        flat = kernels.expand(self.offsets[at], sizes)
        return np.r_[0, np.cumsum(sizes)], self.ids[flat], self.shares[flat]


class Merged:
    """The candidates of every context met, its levels merged once: rows of a matrix with a column for each id of the model.

    Columns are in order of ids, so of equal scores the smaller id stands first. Scores are held as costs, their negatives,
    so that a sort puts the best first; what is no candidate costs infinitely much.
    """

    def __init__(self, model: list[Contexts], n_ids: int, penalty: float):
        self.model, self.n_ids, self.penalty = model, n_ids, penalty
        self.ids = np.unique(np.concatenate([m.ids for m in model])).astype(np.int64)
        self.column = np.full(n_ids, -1)
        self.column[self.ids] = np.arange(len(self.ids))
        self.forget()

    def forget(self) -> None:
        self.known: dict[int, int] = {}
        self.costs = self.penalised = np.empty((0, len(self.ids)))

    def keys(self, prompts: Prompts) -> np.ndarray:
        """The longest context of each prompt as one number, from which those of all levels follow; negative if it is short."""
        grams = len(self.model)
        number = prompts.context(grams, self.n_ids)
        for length in range(min(grams - 1, prompts.length.min(initial=grams)), grams - 1):
            short = prompts.length == length
            number[short] = -1 - sum(self.n_ids**i for i in range(length)) - prompts.context(length + 1, self.n_ids)[short]
        return number

    def rows(self, prompts: Prompts) -> np.ndarray:
        """Where the context of each prompt stands in the matrix."""
        keys, first, back = np.unique(self.keys(prompts), return_index=True, return_inverse=True)
        if (len(self.known) + len(keys)) * len(self.ids) > KEPT_CELLS and not all(k in self.known for k in keys.tolist()):
            self.forget()
        at = np.array([self.known.get(k, -1) for k in keys.tolist()], np.int64)
        fresh = np.flatnonzero(at < 0)
        if len(fresh):
            self.add(prompts.some(first[fresh]))
            at[fresh] = np.arange(len(self.known), len(self.known) + len(fresh))
            self.known.update(zip(keys[fresh].tolist(), at[fresh].tolist()))
        return at[back]

    def add(self, prompts: Prompts) -> None:
        n, grams = len(prompts.length), len(self.model)
        c = merge_levels([m.of(prompts.context(grams - k, self.n_ids)) for k, m in enumerate(self.model)], n)
        costs = np.full((2, n, len(self.ids)), np.inf)
        costs[0, c.row, self.column[c.ids]] = -c.scores
        costs[1, c.row, self.column[c.ids]] = -np.where(c.scores > 0, c.scores / self.penalty, c.scores * self.penalty)
        self.costs, self.penalised = np.concatenate([self.costs, costs[0]]), np.concatenate([self.penalised, costs[1]])

    def next_ids(self, prompts: Prompts, options: Options, u: np.ndarray) -> np.ndarray:
        """G3-G8 for every prompt: the drawn id, -1 if there is no candidate."""
        rows, at = self.rows(prompts), np.arange(len(prompts.length))
        if not len(self.ids):
            return np.full(len(at), -1, np.int64)
        costs = self.costs[rows]
        np.copyto(costs, self.penalised[rows], where=prompts.seen[:, self.ids])
        banned, ids = repeats(prompts, options.no_repeat_ngram_size)
        column = self.column[ids]
        costs[banned[column >= 0], column[column >= 0]] = np.inf
        if not options.do_sample or options.temperature == 0:
            column = costs.argmin(axis=1)
            some = np.isfinite(costs[at, column]) & (options.top_p > 0)
        else:
            column, some = drawn(costs, u, options)
        return np.where(some, self.ids[column], -1)


def drawn(costs: np.ndarray, u: np.ndarray, options: Options) -> tuple[np.ndarray, np.ndarray]:
    """The drawn column of every row, and whether there is one."""
    at = np.arange(len(costs))
    ordered = np.sort(costs, axis=1)
    some = np.isfinite(ordered[:, 0])
    ordered[~some] = 0
    shares = np.exp((ordered[:, :1] - ordered) / options.temperature)
    shares /= np.cumsum(shares, axis=1)[:, -1:]
    upto = np.cumsum(shares[:, : options.top_k or None], axis=1)
    # What is kept by top-p is a beginning: the running mass before its last one is the last below the limit.
    kept = (upto[:, :-1] < options.top_p * upto[:, -1:]).sum(axis=1) + 1
    some &= options.top_p * upto[:, -1] > 0
    place = np.minimum((upto <= (u * upto[at, kept - 1])[:, None]).sum(axis=1), kept - 1)
    cost = ordered[at, place][:, None]
    same = costs == cost
    column = same.argmax(axis=1)
    tied = place - (ordered < cost).sum(axis=1)
    later = np.flatnonzero(tied)
    column[later] = (np.cumsum(same[later], axis=1) > tied[later, None]).argmax(axis=1)
    return column, some


def uniforms(seeds: list[bytes], step: int) -> np.ndarray:
    """``sampling.uniform`` of many prompts; ``seeds`` holds what stands before the step in each one's text."""
    last = str(step).encode()
    head = b"".join([b"\0\0" + hashlib.md5(seed + last).digest()[:6] for seed in seeds])
    return np.frombuffer(head, ">u8") / 16**12


def all_steps(options: Options, grams: int, n_ids: int, eos_id: int = EOS_ID):
    """A group of prompts and a copy of a small model -> the prompts' final state."""

    def run(start: pa.Table, rows: pa.Table) -> pa.Table:
        model = [Contexts(rows.filter(pc.equal(rows["gram"], g))) for g in range(grams, 0, -1)]
        merged = Merged(model, n_ids, options.repetition_penalty)
        out = []
        # Histories of like lengths side by side make narrow matrices.
        for batch in start.take(pc.sort_indices(pc.list_value_length(start["history"]))).combine_chunks().to_batches():
            names = batch.column("prompt_id").to_numpy()
            offsets, items = batch_lists(batch, "history")
            for low, high in portions(offsets, n_ids, options.max_new_tokens):
                own, ids = cut_lists((offsets, items), low, high)
                prompts = Prompts.of(own, ids, n_ids, options.max_new_tokens)
                n_new, done = np.zeros(high - low, np.int64), np.zeros(high - low, bool)
                seeds = [f"{options.seed}:{name}:".encode() for name in names[low:high].tolist()]
                going, some = np.arange(high - low), prompts
                for step in range(options.max_new_tokens):
                    if not len(going):
                        break
                    new = merged.next_ids(some, options, uniforms(seeds, step))
                    ended = (new == -1) | (new == eos_id)
                    n_new[going[~ended]] += 1
                    if ended.any():
                        done[going[ended]] = True
                        prompts.put(going[ended], some.some(ended))
                        going, some, new = going[~ended], some.some(~ended), new[~ended]
                        seeds = [seed for seed, e in zip(seeds, ended.tolist()) if not e]
                    some.append(np.arange(len(going)), new)
                prompts.put(going, some)
                out.append(state_batch(names[low:high], prompts, n_new, done))
        return pa.Table.from_batches(out) if out else state_table()

    return run


def state_table() -> pa.Table:
    fields = [("prompt_id", pa.int64()), ("history", pa.list_(pa.int32())), ("n_new", pa.int32()), ("done", pa.bool_())]
    return pa.schema(fields).empty_table()
