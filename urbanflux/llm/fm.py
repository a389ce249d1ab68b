"""Factorization machines of second order over sparse presence features.

A document is a set of feature numbers. Its logit is

    bias + sum_i w_i + 1/2 sum_f [ (sum_i v_if)^2 - sum_i v_if^2 ]

the bracket being the sum-of-squares form of all pairwise products <v_i, v_j>, which
costs one pass over the features for each factor instead of one over the pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Features whose factors are held at once when rows are scored; a longer row is held alone.
HELD = 1 << 17
#: Ranges of the hashes that are counted one after another.
RANGES = 32
#: One labelled row in so many is left out of the steps and judges when they end.
INNER = 10
#: Steps between two judgements, and judgements without a fall of the loss that end a fit.
ROUND, PATIENCE = 32, 24
#: A smaller fall of the log loss counts as none.
LEAST_FALL = 1e-4


@dataclass
class Machine:
    """``terms``: sorted 64-bit hashes of the kept words, numbered first; further features follow."""

    terms: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray
    extra: dict

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Feature numbers of those hashes that the machine knows."""
        if not len(self.terms) or not len(hashes):
            return np.empty(0, np.int64)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return at[self.terms[at] == hashes]

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        """Probability of label 1 for each row of feature numbers."""
        flat, starts = _ragged(rows)
        out = np.empty(len(rows))
        for lo, hi in _slices(starts):
            out[lo:hi] = self._logits(flat[starts[lo] : starts[hi]], starts[lo : hi + 1] - starts[lo])[0]
        return 1.0 / (1.0 + np.exp(-np.clip(out, -30, 30)))

    def _logits(self, flat: np.ndarray, starts: np.ndarray):
        v = self.factors[flat]
        sums = _sums(v, starts)
        squares = _sums((v * v).sum(1), starts)
        return self.bias + _sums(self.weights[flat], starts) + 0.5 * ((sums * sums).sum(1) - squares), sums


def _ragged(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    starts = np.zeros(len(rows) + 1, np.int64)
    np.cumsum([len(r) for r in rows], out=starts[1:])
    return (np.concatenate(rows) if rows else np.empty(0, np.int64)).astype(np.int64), starts


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs; an empty run sums to zero."""
    total = np.zeros((len(starts) - 1, *values.shape[1:]))
    some = starts[1:] > starts[:-1]
    if some.any():
        total[some] = np.add.reduceat(values, starts[:-1][some], axis=0)
    return total


def frequent_terms(rows: list[np.ndarray], least_rows: int) -> np.ndarray:
    """Sorted hashes in ``least_rows`` rows or more, whatever the labels of those rows.

    A word that tells nothing alone may tell much beside another, so labels take no part
    in the choice; ``fit`` puts words that met a label by chance to zero. Hashes are
    counted range by range, which needs little memory beside the hashes themselves.
    """
    if not sum(map(len, rows)):
        return np.empty(0, np.uint64)
    flat = np.concatenate(rows).astype(np.uint64, copy=False)
    of = (flat >> np.uint64(64 - RANGES.bit_length() + 1)).astype(np.uint8)
    kept = []
    for number in range(RANGES):
        found, n = np.unique(flat[of == number], return_counts=True)
        kept.append(found[n >= least_rows])
    return np.concatenate(kept)


def fit(
    rows: list[np.ndarray], labels: np.ndarray, n_features: int, *, terms: np.ndarray, extra: dict, factors: int = 8,
    batch: int = 256, rate: float = 0.02, shrink: float = 0.03, seed: int = 7,
) -> Machine:
    """Mini-batch proximal descent on the log loss; the same rows in the same order give the same machine.

    One rule ends every fit, whatever its size: each INNER-th row, dealt at random, is left
    out, and steps are taken until the log loss of those rows has not fallen for PATIENCE
    rounds of ROUND steps. The machine of the best round is returned.

    The gradient is averaged as in Adam, but one scale, the greatest, holds for all
    features: a word of few rows then moves as little as its rows are few. After each
    step weights and the factors of a feature, these as one vector, shrink by
    ``rate * shrink``, which takes chance words to exactly zero. A feature that is at zero
    after a round takes no part in the next ones, which makes late rounds cheap, and terms at
    zero are left out of the machine, which changes no score.
    Without rows, or with one label only, the machine has the smoothed share of label 1 as its score.
    """
    share = (float(labels.sum()) + 1.0) / (len(labels) + 2.0)
    rng = np.random.default_rng(seed)
    start = float(np.log(share / (1 - share)))
    m = Machine(terms, start, np.zeros(n_features), rng.normal(0, 0.01, (n_features, factors)), extra)
    if len(labels) == 0 or labels.min() == labels.max():
        m.factors[:] = 0.0
        return m
    dealt = rng.permutation(len(rows))
    inner, outer = np.sort(dealt[::INNER]), np.sort(np.delete(dealt, np.s_[::INNER]))
    seen, judged = _ragged([rows[i] for i in outer]), _ragged([rows[i] for i in inner])
    descent, alive = _Descent(m, rate, shrink), np.arange(n_features)
    queue, best, waited = np.empty(0, np.int64), None, 0
    while waited < PATIENCE:
        for _ in range(ROUND):
            if not len(queue):
                queue = rng.permutation(len(outer))
            take, queue = queue[:batch], queue[batch:]
            descent.step(*_taken(*seen, take), labels[outer[take]])
        loss = _log_loss(m, *judged, labels[inner])
        waited += 1
        if best is None or loss < best[0] - LEAST_FALL:
            best, waited = (loss, m.bias, alive, m.weights.copy(), m.factors.copy()), 0
        kept = descent.drop_zeros()
        alive, seen, judged = alive[kept], _renumbered(*seen, kept), _renumbered(*judged, kept)
    _, bias, alive, some_weights, some_factors = best
    weights, all_factors = np.zeros(n_features), np.zeros((n_features, factors))
    weights[alive], all_factors[alive] = some_weights, some_factors
    kept = (weights != 0) | all_factors.any(1)
    kept[len(terms) :] = True
    return Machine(terms[kept[: len(terms)]], bias, weights[kept], all_factors[kept], extra)


class _Descent:
    """Steps on a machine's parameters, which it changes in place, with the gradient averages they need."""

    def __init__(self, machine: Machine, rate: float, shrink: float):
        self.machine, self.rate, self.shrink, self.steps = machine, rate, shrink, 0
        self.state = {k: [0.0, 0.0] for k in ("b", "w", "v")}

    def _move(self, key: str, grad):
        first, second = self.state[key]
        greatest = float(np.max(np.abs(grad), initial=0.0))
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * greatest * greatest
        self.state[key] = [first, second]
        return first * (self.rate / (1 - 0.9**self.steps) / (np.sqrt(second / (1 - 0.999**self.steps)) + 1e-8))

    def step(self, flat: np.ndarray, starts: np.ndarray, labels: np.ndarray) -> None:
        m, less = self.machine, self.rate * self.shrink
        self.steps += 1
        grad_b, grad_w, grad_v = _gradients(m, flat, starts, labels)
        m.bias -= float(self._move("b", grad_b))
        m.weights -= self._move("w", grad_w)
        m.weights = np.sign(m.weights) * np.maximum(np.abs(m.weights) - less, 0.0)
        m.factors -= self._move("v", grad_v)
        norms = np.sqrt(np.einsum("ij,ij->i", m.factors, m.factors))[:, None]
        m.factors *= np.maximum(1 - less / np.maximum(norms, 1e-12), 0.0)

    def drop_zeros(self) -> np.ndarray:
        """Leave features at zero out; returns which ones stay."""
        m = self.machine
        kept = (m.weights != 0) | m.factors.any(1)
        m.weights, m.factors = m.weights[kept], m.factors[kept]
        for key in ("w", "v"):
            self.state[key][0] = self.state[key][0][kept]
        return kept


def _taken(flat: np.ndarray, starts: np.ndarray, take: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ragged rows numbered ``take``, in that order."""
    lengths = starts[take + 1] - starts[take]
    ends = np.concatenate([[0], np.cumsum(lengths)])
    return flat[np.arange(ends[-1]) + np.repeat(starts[take] - ends[:-1], lengths)], ends


def _renumbered(flat: np.ndarray, starts: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ragged rows without the features that are not ``kept``, the others numbered anew."""
    stays = kept[flat]
    before = np.concatenate([[0], np.cumsum(stays)])
    return (np.cumsum(kept) - 1)[flat[stays]], before[starts]


def _slices(starts: np.ndarray):
    """Runs of rows, first and end, that hold HELD features or are one row."""
    lo = 0
    while lo < len(starts) - 1:
        hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + HELD, "right")) - 1)
        yield lo, hi
        lo = hi


def _log_loss(m: Machine, flat: np.ndarray, starts: np.ndarray, labels: np.ndarray) -> float:
    total = 0.0
    for lo, hi in _slices(starts):
        logits = m._logits(flat[starts[lo] : starts[hi]], starts[lo : hi + 1] - starts[lo])[0]
        total += float((np.logaddexp(0.0, logits) - labels[lo:hi] * logits).sum())
    return total / len(labels)


def _gradients(m: Machine, flat: np.ndarray, starts: np.ndarray, labels: np.ndarray):
    """Mean gradients of the log loss by bias, weights and factors, in slices of HELD features."""
    n, factors = m.factors.shape
    by_bias, by_weight, by_sums = 0.0, np.zeros(n), np.zeros((factors, n))
    squares = np.einsum("ij,ij->i", m.factors, m.factors)
    for lo, hi in _slices(starts):
        part, ends = flat[starts[lo] : starts[hi]], starts[lo : hi + 1] - starts[lo]
        sums = _sums(m.factors[part], ends)
        logits = m.bias + _sums(m.weights[part] - 0.5 * squares[part], ends) + 0.5 * (sums * sums).sum(1)
        error = (1.0 / (1.0 + np.exp(-np.clip(logits, -30, 30))) - labels[lo:hi]) / len(labels)
        lengths = np.diff(ends)
        by_bias += error.sum()
        by_weight += np.bincount(part, weights=np.repeat(error, lengths), minlength=n)
        for f in range(factors):
            by_sums[f] += np.bincount(part, weights=np.repeat(error * sums[:, f], lengths), minlength=n)
    return by_bias, by_weight, by_sums.T - by_weight[:, None] * m.factors
