"""A small linear-chain conditional random field in numpy: training and batched decoding.

Sequences stand one after another: ``ids`` has the features of each token (rows of
equal width), ``sizes`` the number of tokens of each sequence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def _steps(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, Iterator[tuple[int, int]]]:
    """Starts by falling size, their order, and for each step how many sequences reach it."""
    starts = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")
    longest = int(sizes.max(initial=0))
    live = np.searchsorted(-sizes[order], -np.arange(longest), side="left")
    return starts[order], order, live


class Crf:
    """Weights of features by label, and of each label after another; the ends count as label 0."""

    def __init__(self, n_features: int, n_labels: int):
        self.weights = np.zeros((n_features, n_labels))
        self.moves = np.zeros((n_labels, n_labels))

    def emissions(self, ids: np.ndarray) -> np.ndarray:
        return self.weights[ids].sum(1)

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The best labels by Viterbi, all sequences step by step together; of equal paths the lower labels."""
        return self.best(self.emissions(ids), sizes)

    def is_surely_zero(self, score: np.ndarray) -> np.ndarray:
        """Which tokens have label 0 on the best path of any text, whatever stands beside them.

        No other label can make up for its lower score by better moves from and to it.
        """
        m = self.moves
        gain = (m[:, 1:] - m[:, :1]).max(0) + (m[1:] - m[:1]).max(1)
        return (score[:, :1] - score[:, 1:] > gain).all(1)

    def best(self, score: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """``decode`` from the scores of the tokens."""
        starts, _, live = _steps(sizes)
        n_labels = score.shape[1]
        back = np.zeros((len(score), n_labels), np.int8)
        total = np.zeros((len(starts), n_labels))
        for t, n in enumerate(live.tolist()):
            at = starts[:n] + t
            if t:
                paths = total[:n, :, None] + self.moves
                back[at] = paths.argmax(1)
                total[:n] = paths.max(1) + score[at]
            else:
                total[:n] = self.moves[0] + score[at]
        label = (total + self.moves[:, 0]).argmax(1)
        out = np.zeros(len(score), np.int8)
        for t in range(len(live) - 1, -1, -1):
            n = live[t]
            at = starts[:n] + t
            out[at] = label[:n]
            label[:n] = back[at, label[:n]]
        return out

    def _expected(self, score: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected label of each token and expected moves, by forward and backward sums."""
        starts, _, live = _steps(sizes)
        n_labels = score.shape[1]
        forward, backward = np.zeros_like(score), np.zeros_like(score)
        move = np.exp(self.moves)
        # Every step is scaled to sum one, which cancels in the normalised products.
        local = np.exp(score - score.max(1, keepdims=True))
        scale = np.ones(len(score))
        for t, n in enumerate(live.tolist()):
            at = starts[:n] + t
            now = (forward[at - 1] @ move if t else np.broadcast_to(move[0], (n, n_labels))) * local[at]
            scale[at] = now.sum(1)
            forward[at] = now / scale[at, None]
        order_sizes = np.sort(sizes)[::-1]
        backward[starts + order_sizes - 1] = move[:, 0]
        moves = np.zeros_like(move)
        for t in range(len(live) - 1, 0, -1):
            n = live[t]
            at = starts[:n] + t
            after = local[at] * backward[at] / scale[at, None]
            joint = forward[at - 1][:, :, None] * move * after[:, None, :]
            moves += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
            backward[at - 1] = after @ move.T
        label = forward * backward
        label /= label.sum(1, keepdims=True)
        moves[0] += label[starts].sum(0)
        moves[:, 0] += label[starts + order_sizes - 1].sum(0)
        return label, moves

    def fit(self, ids: np.ndarray, sizes: np.ndarray, labels: np.ndarray, rounds: int = 60, rate: float = 0.5, keep: float = 1e-3):
        """Gradient ascent on the likelihood with steps by feature (AdaGrad) and a pull towards zero."""
        if not len(sizes):
            return self
        n_labels = self.weights.shape[1]
        truth = np.eye(n_labels)[labels]
        ends = np.cumsum(sizes)
        seen = np.zeros_like(self.moves)
        inner = np.ones(len(labels), bool)
        inner[ends - sizes] = False
        np.add.at(seen, (labels[:-1][inner[1:]], labels[1:][inner[1:]]), 1)
        np.add.at(seen[0], labels[ends - sizes], 1)
        np.add.at(seen[:, 0], labels[ends - 1], 1)
        past_w, past_m = np.full_like(self.weights, 1e-8), np.full_like(self.moves, 1e-8)
        for _ in range(rounds):
            label, moves = self._expected(self.emissions(ids), sizes)
            step = np.zeros_like(self.weights)
            for k in range(ids.shape[1]):
                np.add.at(step, ids[:, k], truth - label)
            step = step / len(sizes) - keep * self.weights
            step_m = (seen - moves) / len(sizes) - keep * self.moves
            past_w += step**2
            past_m += step_m**2
            self.weights += rate * step / np.sqrt(past_w)
            self.moves += rate * step_m / np.sqrt(past_m)
        return self
