"""Linear-chain conditional random field with two labels over sets of binary
features: fitted by gradient ascent on the log-likelihood of whole sequences,
decoded by Viterbi."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Chain:
    index: dict[str, int]
    emit: np.ndarray         # [features, 2]
    move: np.ndarray         # [2, 2], from label to label
    begin: np.ndarray        # [2]

    def decode(self, sequence: list[list[str]]) -> list[int]:
        """The most probable labels; of equal ones label 0."""
        if not sequence:
            return []
        get, emit = self.index.get, self.emit.tolist()
        (m00, m01), (m10, m11) = self.move.tolist()
        back = []
        s0, s1 = self.begin.tolist()
        for t, names in enumerate(sequence):
            e0 = e1 = 0.0
            for f in names:
                j = get(f)
                if j is not None:
                    e0 += emit[j][0]
                    e1 += emit[j][1]
            if t:
                a, b, c, d = s0 + m00, s1 + m10, s0 + m01, s1 + m11
                back.append((b > a, d > c))
                s0, s1 = max(a, b), max(c, d)
            s0 += e0
            s1 += e1
        label = int(s1 > s0)
        out = [label]
        for step in reversed(back):
            label = int(step[label])
            out.append(label)
        return out[::-1]


def fit(sequences: list[list[list[str]]], labels: list[list[int]], rounds: int = 150, rate: float = 0.1,
        ridge: float = 1e-3) -> Chain:
    """Adam on the penalised log-likelihood; all sequences at once, padded."""
    index: dict[str, int] = {}
    for s in sequences:
        for names in s:
            for f in names:
                index.setdefault(f, len(index))
    n, longest, d = len(sequences), max(map(len, sequences)), len(index)
    x = np.zeros((n, longest, d), np.float32)
    y = np.zeros((n, longest), np.int64)
    real = np.zeros((n, longest), bool)
    for i, (s, ls) in enumerate(zip(sequences, labels, strict=True)):
        for t, (names, v) in enumerate(zip(s, ls, strict=True)):
            x[i, t, [index[f] for f in names]] = 1
            y[i, t], real[i, t] = v, True
    both = real[:, 1:]
    gold_emit = np.stack([(x * (real & (y == v))[..., None]).sum((0, 1)) for v in (0, 1)], 1)
    gold_move = np.array([[(both & (y[:, :-1] == a) & (y[:, 1:] == b)).sum() for b in (0, 1)] for a in (0, 1)], float)
    gold_begin = np.bincount(y[:, 0], minlength=2).astype(float)
    weights = [np.zeros((d, 2)), np.zeros((2, 2)), np.zeros(2)]
    mean, square = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    lse = lambda a, axis: np.logaddexp.reduce(a, axis=axis)
    for step in range(1, rounds + 1):
        emit, move, begin = weights
        e = x @ emit.astype(np.float32)
        forward, backward = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        forward[:, 0] = begin + e[:, 0]
        for t in range(1, longest):
            nxt = lse(forward[:, t - 1, :, None] + move, 1) + e[:, t]
            forward[:, t] = np.where(real[:, t, None], nxt, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            nxt = lse(move + (e[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(real[:, t + 1, None], nxt, 0)
        total = lse(forward[:, -1], 1)
        node = np.exp(forward + backward - total[:, None, None]) * real[..., None]
        pair = np.exp(forward[:, :-1, :, None] + move + (e + backward)[:, 1:, None, :] - total[:, None, None, None])
        grads = [gold_emit - np.einsum("itd,itk->dk", x, node, optimize=True),
                 gold_move - (pair * both[..., None, None]).sum((0, 1)), gold_begin - node[:, 0].sum(0)]
        for j, g in enumerate(grads):
            g = g / n - ridge * weights[j]
            mean[j] = 0.9 * mean[j] + 0.1 * g
            square[j] = 0.999 * square[j] + 0.001 * g * g
            weights[j] = weights[j] + rate * (mean[j] / (1 - 0.9 ** step)) / (np.sqrt(square[j] / (1 - 0.999 ** step)) + 1e-8)
    return Chain(index, *weights)
