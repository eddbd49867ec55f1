"""Settings of generation, and its decoding filters (G3-G8) for one prompt, whose candidates are two arrays, ids and scores.

Tables of prompts go through ``decoding``, which applies the same filters to all prompts of a batch at once.
"""

import hashlib
import sys
from dataclasses import dataclass

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BACKOFF = 0.4
EOS_ID = 1


@dataclass(frozen=True)
class Options:
    """The generation settings of the demos."""

    max_new_tokens: int = 80
    do_sample: bool = True
    temperature: float = 0.7
    top_p: float = 0.9
    top_k: int = 0
    repetition_penalty: float = 1.1
    no_repeat_ngram_size: int = 4
    seed: int = 42


def among(ids, others):
    """Which ids occur in ``others``; for short id lists a flag table beats sorting."""
    if not len(ids) or not len(others):
        return np.zeros(len(ids), bool)
    flags = np.zeros(1 + max(ids.max(), others.max()), bool)
    flags[others] = True
    return flags[ids]


def merge_levels(levels):
    """G2, stupid back-off: an id takes its share from the longest context it follows, times BACKOFF per level down.

    ``levels`` holds (ids, shares) per context length, longest first.
    """
    ids, scores = [], []
    for down, (level_ids, shares) in enumerate(levels):
        fresh = ~among(level_ids, np.concatenate(ids) if ids else level_ids[:0])
        ids.append(level_ids[fresh])
        scores.append(np.log(shares[fresh] * BACKOFF**down))
    return np.concatenate(ids), np.concatenate(scores)


def penalise(ids, scores, history, penalty):
    """Scores of ids already seen shrink: positive ones are divided, negative ones multiplied."""
    shrunk = np.where(scores > 0, scores / penalty, scores * penalty)
    return ids, np.where(among(ids, history), shrunk, scores)


def ban_repeats(ids, scores, history, n):
    """Drop ids that would complete an n-gram the history already holds."""
    if not n or len(history) < n:
        return ids, scores
    starts = np.ones(len(history) - n + 1, bool)
    for i in range(n - 1):
        starts &= history[i : i + len(starts)] == history[len(history) - n + 1 + i]
    keep = ~among(ids, history[n - 1 :][starts])
    return ids[keep], scores[keep]


def as_probabilities(ids, scores, temperature):
    """Divide log-scores by the temperature and renormalise; 0 keeps the best only. Best first, ties by id."""
    order = np.lexsort((ids, -scores))
    ids, scores = ids[order], scores[order]
    if temperature == 0:
        return ids[:1], np.ones(len(ids[:1]))
    shares = np.exp((scores - scores[:1]) / temperature)
    return ids, shares / shares.sum()


def keep_top_k(ids, shares, k):
    """The k best; 0 keeps all."""
    return (ids[:k], shares[:k]) if k else (ids, shares)


def keep_top_p(ids, shares, p):
    """The shortest best-first list whose part of the whole mass reaches p."""
    before = np.r_[0.0, np.cumsum(shares)[:-1]] if len(shares) else shares
    keep = before < p * shares.sum()
    return ids[keep], shares[keep]


def draw(ids, shares, u):
    """The first id whose running mass exceeds ``u`` times the whole mass; -1 if there is no candidate."""
    if not len(ids):
        return -1
    upto = np.cumsum(shares)
    return int(ids[min(np.searchsorted(upto, u * upto[-1], side="right"), len(ids) - 1)])


def uniform(seed, prompt_id, step):
    """A reproducible number in [0, 1) for one prompt and step."""
    return int(hashlib.md5(f"{seed}:{prompt_id}:{step}".encode()).hexdigest()[:12], 16) / 16**12


STAGES = ("candidates", "penalty", "no_repeat", "temperature", "top_k", "top_p")


def filtered(levels, history, options, upto=STAGES[-1]):
    """The candidates of one prompt after the filters up to ``upto``, in their fixed order."""
    temperature = options.temperature if options.do_sample else 0
    filters = (
        lambda ids, s: (ids, s),
        lambda ids, s: penalise(ids, s, history, options.repetition_penalty),
        lambda ids, s: ban_repeats(ids, s, history, options.no_repeat_ngram_size),
        lambda ids, s: as_probabilities(ids, s, temperature),
        lambda ids, s: keep_top_k(ids, s, options.top_k),
        lambda ids, s: keep_top_p(ids, s, options.top_p),
    )
    ids, scores = merge_levels(levels)
    for apply in filters[: STAGES.index(upto) + 1]:
        ids, scores = apply(ids, scores)
    return ids, scores
