"""Linear-chain conditional random fields over many sequences at once, in numpy.

Sequences lie one after the other in one array. Step t of every sequence longer than t is done in one
array operation, so Python's loop runs over positions and not over tokens. Only the sequences of one
call are held; callers pass a few MB of text at a time.
"""

from __future__ import annotations

import numpy as np


class _Steps:
    """Rows of each position, the longest sequences first."""

    def __init__(self, lengths: np.ndarray):
        self.rank = np.argsort(-lengths, kind="stable")
        self.lengths = lengths[self.rank]
        ends = np.cumsum(lengths)
        self.first = (ends - lengths)[self.rank]
        self.longest = int(self.lengths[0]) if len(lengths) else 0
        # how many sequences are longer than t
        self.active = len(lengths) - np.searchsorted(self.lengths[::-1], np.arange(self.longest + 1), side="right")

    def rows(self, t: int) -> np.ndarray:
        return self.first[: self.active[t]] + t


def viterbi(emit: np.ndarray, lengths: np.ndarray, trans: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The best state of every position. ``emit`` n x S scores, ``trans[i, j]`` score of j after i."""
    n, s = emit.shape
    states = np.zeros(n, np.int8)
    steps = _Steps(lengths)
    if not steps.longest:
        return states
    back = np.zeros((n, s), np.int8)
    final = np.zeros((len(lengths), s), emit.dtype)
    score = emit[steps.rows(0)] + start
    final[: len(score)] = score
    for t in range(1, steps.longest):
        rows = steps.rows(t)
        paths = score[: len(rows), :, None] + trans
        best = paths.argmax(1)
        back[rows] = best
        score = np.take_along_axis(paths, best[:, None, :], 1)[:, 0] + emit[rows]
        final[: len(rows)] = score
    at = final.argmax(1).astype(np.int8)
    for t in range(steps.longest - 1, -1, -1):
        rows = steps.rows(t)
        states[rows] = at[: len(rows)]
        at[: len(rows)] = back[rows, at[: len(rows)]]
    return states


def marginals(emit: np.ndarray, lengths: np.ndarray, trans: np.ndarray, start: np.ndarray, pairs: bool = False):
    """P(state | sequence) of every position by forward-backward; with ``pairs`` also the expected transitions and log Z."""
    n, s = emit.shape
    top = emit.max(1, keepdims=True) if n else emit[:, :1]
    near = np.exp(emit - top)
    step, first = np.exp(trans), np.exp(start)
    forward, backward = np.zeros((n, s)), np.zeros((n, s))
    expected, log_z = np.zeros((s, s)), float(top.sum())
    steps = _Steps(lengths)
    if steps.longest:
        rows = steps.rows(0)
        now = near[rows] * first
        for t in range(steps.longest):
            if t:
                rows = steps.rows(t)
                now = (now[: len(rows)] @ step) * near[rows]
            total = now.sum(1, keepdims=True)
            now = now / total
            forward[rows] = now
            if pairs:
                log_z += float(np.log(total).sum())
        after = np.ones((len(lengths), s))
        for t in range(steps.longest - 1, -1, -1):
            rows = steps.rows(t)
            backward[rows] = here = after[: len(rows)]
            gone = (here * near[rows]) @ step.T
            if pairs and t:
                joint = forward[rows - 1][:, :, None] * step * (here * near[rows])[:, None, :]
                expected += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
            after[: len(rows)] = gone / gone.sum(1, keepdims=True)
    both = forward * backward
    both /= np.maximum(both.sum(1, keepdims=True), 1e-300)
    return (both, expected, log_z) if pairs else both


def fit(
    x: np.ndarray,
    y: np.ndarray,
    lengths: np.ndarray,
    states: int,
    forbidden: tuple[tuple[int, int], ...] = (),
    not_first: tuple[int, ...] = (),
    l2: float = 1e-4,
    rounds: int = 120,
    rate: float = 0.15,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights (features x S), transitions and start scores that maximise the likelihood of the states ``y``.

    Transitions in ``forbidden`` and first states in ``not_first`` stay impossible. Adam with a fixed
    number of full passes, so equal rows give equal weights.
    """
    x = x.astype(np.float64)
    n = max(len(y), 1)
    ends = np.cumsum(lengths)
    first = (ends - lengths)[lengths > 0]
    inner = np.ones(len(y), bool)
    inner[first] = False
    seen = np.zeros((states, states))
    np.add.at(seen, (y[:-1][inner[1:]], y[1:][inner[1:]]), 1)
    seen_first = np.bincount(y[first], minlength=states).astype(float)
    wanted = np.eye(states)[y]
    parts = [np.zeros((x.shape[1], states)), np.zeros((states, states)), np.zeros(states)]
    blocked, blocked_first = np.zeros((states, states)), np.zeros(states)
    for i, j in forbidden:
        blocked[i, j] = -1e4
    for j in not_first:
        blocked_first[j] = -1e4
    m, v = [0 * p for p in parts], [0 * p for p in parts]
    for k in range(1, rounds + 1):
        got, expected, _ = marginals(x @ parts[0], lengths, parts[1] + blocked, parts[2] + blocked_first, True)
        up = [x.T @ (wanted - got) / n - l2 * parts[0], (seen - expected) / n - l2 * parts[1], (seen_first - got[first].sum(0)) / n - l2 * parts[2]]
        for i, g in enumerate(up):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            parts[i] = parts[i] + rate * (m[i] / (1 - 0.9**k)) / (np.sqrt(v[i] / (1 - 0.999**k)) + 1e-8)
    return parts[0], parts[1] + blocked, parts[2] + blocked_first
