"""A factorization machine on binary hashed terms, fitted with full-batch Adam.

score(x) = b + Σ w_i + ½ Σ_f [ (Σ v_if)² − Σ v_if² ] over the terms i of a text: the
second part is the sum over all pairs of terms of the inner product of their
factors, so a pair can weigh more (or less) than its two terms do alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


#: Terms whose bits are set at once.
PAIR_BLOCK = 2048


@dataclass
class FactorizationMachine:
    """Terms that the fit doesn't keep weigh nothing."""

    ids: np.ndarray      # sorted known term hashes
    w: np.ndarray        # weight per known term
    v: np.ndarray        # factors per known term
    bias: float

    def logit(self, terms: np.ndarray) -> float:
        if not len(self.ids):
            return self.bias
        at = np.searchsorted(self.ids, terms)
        at = at[(at < len(self.ids)) & (self.ids[np.minimum(at, len(self.ids) - 1)] == terms)]
        v = self.v[at]
        pairs = 0.5 * float((v.sum(axis=0) ** 2 - (v * v).sum(axis=0)).sum())
        return self.bias + float(self.w[at].sum()) + pairs

    def score(self, terms: np.ndarray) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.logit(terms), -30, 30))))


def associated(ids: np.ndarray, n: np.ndarray, n_pos: np.ndarray, pos: int, neg: int, least: float) -> np.ndarray:
    """Terms whose document counts depend on the label: log-likelihood ratio of the
    2x2 table of at least ``least``."""
    def part(a: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(a > 0, a * np.log(np.maximum(a, 1e-12) / np.maximum(expected, 1e-12)), 0.0)

    docs = pos + neg
    g = sum(part(a, row * col / docs) for a, row, col in (
        (n_pos, n, pos), (n - n_pos, n, neg), (pos - n_pos, docs - n, pos), (neg - (n - n_pos), docs - n, neg)))
    return ids[2 * g >= least]


def _distinct(flat: np.ndarray, rows: np.ndarray, ids: np.ndarray, docs: int) -> np.ndarray:
    """One of the terms that occur in exactly the same texts (a word and its prefixes, say)."""
    weight = np.random.default_rng(5).random(docs)
    sums = np.bincount(flat, weight[rows])[ids]  # equal texts add up in the same order
    return np.sort(ids[np.unique(sums, return_index=True)[1]])


def paired(flat: np.ndarray, rows: np.ndarray, y: np.ndarray, ids: np.ndarray, least: float) -> np.ndarray:
    """Terms of pairs that depend on the label together: among the texts with one of the
    two, the label depends on the other by at least ``least`` standard deviations, and
    the other way round. Whether a term alone tells anything doesn't matter. ``ids`` are
    sorted and in at least least² texts: fewer can't deviate that far. A term is a row of
    bits, one for each text; two rows have as many texts in common as bits."""
    if not len(ids):
        return ids
    ids = _distinct(flat, rows, ids, len(y))
    column = np.full(int(flat.max()) + 1, -1, np.int32)
    column[ids] = np.arange(len(ids))
    column = column[flat]
    # a bit for each text; positive texts first, the others from a new word on
    pos = int((y > 0).sum())
    words = -(-pos // 64)
    place = np.empty(len(y), dtype=np.int32)
    place[y > 0], place[y <= 0] = np.arange(pos), 64 * words + np.arange(len(y) - pos)
    bits = np.zeros((len(ids), words + -(-(len(y) - pos) // 64)), np.uint64)
    for start in range(0, len(ids), PAIR_BLOCK):
        some = (column >= start) & (column < start + PAIR_BLOCK)
        dense = np.zeros((min(PAIR_BLOCK, len(ids) - start), 64 * bits.shape[1]), np.uint8)
        dense[column[some] - start, place[rows[some]]] = 1
        bits[start:start + PAIR_BLOCK] = np.packbits(dense, axis=1).view(np.uint64)
    del column, dense, some

    def counts(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts and positive texts of rows of bits."""
        per_word = np.bitwise_count(x)
        positive = per_word[:, :words].sum(axis=1, dtype=np.int32)
        return positive + per_word[:, words:].sum(axis=1, dtype=np.int32), positive

    n, n_pos = counts(bits)
    share = n_pos / n
    found = np.zeros(len(ids), dtype=bool)

    def deviates(both: np.ndarray, both_pos: np.ndarray, n: np.ndarray, share: np.ndarray) -> np.ndarray:
        """Texts with both, against the share of positives among the n with one."""
        spread = both * (share * (1 - share)) * (1 - both / n)
        return (both_pos - both * share) ** 2 >= least**2 * np.maximum(spread, 1e-6)

    for i in range(len(ids) - 1):
        both, both_pos = counts(bits[i + 1:] & bits[i])
        at = np.flatnonzero(both >= least**2)
        both, both_pos = both[at], both_pos[at]
        at += i + 1
        hit = at[deviates(both, both_pos, n[i], share[i]) & deviates(both, both_pos, n[at], share[at])]
        found[hit] = True
        found[i] |= len(hit) > 0
    return ids[found]


def fit(texts: list[np.ndarray], labels: np.ndarray, factors: int = 4, min_docs: int = 3, association: float = 10.0, pair_deviation: float = 8.0,
        rounds: int = 60, rate: float = 0.05, l2: float = 3e-5, seed: int = 7) -> FactorizationMachine:
    """Fit on the distinct terms (small non-negative numbers) of bounded many texts. With one label or none the score is
    constant. Terms in fewer than ``min_docs`` texts are left out, and those that depend
    on the label neither alone (``association``) nor together with another term
    (``pair_deviation``): they would only teach the factors the sample by heart."""
    y = np.asarray(labels, dtype=np.float64)
    nothing = FactorizationMachine(np.empty(0, np.int64), np.empty(0), np.empty((0, factors)), 0.0)
    if len(y) == 0 or y.min() == y.max():
        nothing.bias = -30.0 if len(y) == 0 or y.max() == 0 else 30.0
        return nothing
    flat = np.concatenate([t.astype(np.int32, copy=False) for t in texts])
    rows = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in texts])
    n = np.bincount(flat) if len(flat) else np.zeros(1, np.int64)
    n_pos = np.bincount(flat[y[rows] > 0], minlength=len(n))
    ids = np.flatnonzero(n >= min_docs)
    alone = associated(ids, n[ids].astype(float), n_pos[ids].astype(float), int(y.sum()), int(len(y) - y.sum()), association)
    together = paired(flat, rows, y, np.flatnonzero(n >= max(min_docs, pair_deviation**2)), pair_deviation)
    ids = np.union1d(alone, together)
    column = np.zeros(len(n), np.int32)
    column[ids] = np.arange(1, len(ids) + 1)
    known = column[flat] > 0
    rows, at = rows[known], column[flat[known]]
    # column 0 is the bias: no row is empty
    cols = np.concatenate([np.zeros(len(texts), np.int32), at])
    rows = np.concatenate([np.arange(len(texts), dtype=np.int32), rows])
    order = np.argsort(rows, kind="stable")
    rows, cols = rows[order], cols[order]
    first = np.searchsorted(rows, np.arange(len(texts)))

    size = len(ids) + 1
    rng = np.random.default_rng(seed)
    theta = np.zeros((size, factors + 1))
    theta[1:, 1:] = rng.normal(0, 0.01, (size - 1, factors))
    m1, m2 = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        w, v = theta[:, 0], theta[:, 1:]
        sums = np.add.reduceat(theta[cols], first, axis=0)
        squares = np.add.reduceat((v * v).sum(axis=1)[cols], first)
        z = sums[:, 0] + 0.5 * ((sums[:, 1:] ** 2).sum(axis=1) - squares)
        g = (1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
        gr = g[rows]
        total = np.bincount(cols, gr, size)
        grad = np.empty_like(theta)
        grad[:, 0] = total
        for f in range(factors):
            grad[:, f + 1] = np.bincount(cols, gr * sums[rows, f + 1], size) - v[:, f] * total
        grad[1:] += l2 * theta[1:]
        grad[0, 1:] = 0.0
        m1 = 0.9 * m1 + 0.1 * grad
        m2 = 0.99 * m2 + 0.01 * grad * grad
        theta -= rate * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.99 ** step)) + 1e-8)
    return FactorizationMachine(ids, theta[1:, 0].copy(), theta[1:, 1:].copy(), float(theta[0, 0]))
