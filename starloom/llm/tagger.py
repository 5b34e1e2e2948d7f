"""A character-level bidirectional LSTM with CRF transitions in numpy."""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np

FORBIDDEN = -1e4
ASCII, OTHER_LETTER, OTHER_DIGIT, OTHER, PAD = 128, 128, 129, 130, 131
SYMBOLS = 132


def symbols(text: str) -> np.ndarray:
    """One class per character: ASCII as itself, its wide forms and other scripts' decimal digits alike, others as letter, digit or rest."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    for k in np.flatnonzero(codes >= ASCII):
        codes[k] = _symbol(int(codes[k]))
    return codes


@lru_cache(maxsize=4096)
def _symbol(code: int) -> int:
    char = chr(code)
    if char.isdecimal():
        return ord("0") + int(char)
    plain = unicodedata.normalize("NFKC", char)
    if len(plain) == 1 and ord(plain) < ASCII:
        return ord(plain)
    return OTHER_LETTER if char.isalpha() else OTHER_DIGIT if char.isdigit() else OTHER


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Tagger:
    """Tags are 0 for outside, then for each kind a begin and an inside tag."""

    kinds: int
    hidden: int = 16
    seed: int = 3
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def __post_init__(self):
        self.tags = 1 + 2 * self.kinds
        self.allowed = np.zeros((self.tags, self.tags))
        for kind in range(self.kinds):
            inside = 2 + 2 * kind
            self.allowed[:, inside] = FORBIDDEN
            self.allowed[[inside - 1, inside], inside] = 0
        self.first = np.zeros(self.tags)
        if not self.weights:
            random, n = np.random.default_rng(self.seed), self.hidden
            self.weights = {
                "input": random.normal(0, 0.3, (2, SYMBOLS, 4 * n)),
                "again": random.normal(0, 0.5 / np.sqrt(n), (2, n, 4 * n)),
                "out": random.normal(0, 0.5 / np.sqrt(n), (2 * n, self.tags)),
                "bias": np.zeros(self.tags),
                "moves": np.zeros((self.tags, self.tags)),
            }
            self.weights["input"][:, :, n : 2 * n] += 0.5  # remember at first

    def _run(self, codes: np.ndarray) -> tuple[np.ndarray, list]:
        """Hidden states [2, T, B, n] in reading order of each direction, and what backward needs."""
        n, (batch, steps) = self.hidden, codes.shape
        both = np.stack([codes, codes[:, ::-1]])
        projected = np.stack([self.weights["input"][d][both[d]] for d in (0, 1)])
        hidden, cell = np.zeros((2, batch, n)), np.zeros((2, batch, n))
        states, kept = np.zeros((2, steps, batch, n)), []
        for t in range(steps):
            gates = projected[:, :, t] + hidden @ self.weights["again"]
            opened = _sigmoid(gates[..., : 3 * n])
            i, f, o = opened[..., :n], opened[..., n : 2 * n], opened[..., 2 * n :]
            new = np.tanh(gates[..., 3 * n :])
            before, cell = cell, f * cell + i * new
            shown = np.tanh(cell)
            kept.append((hidden, before, i, f, o, new, shown))
            hidden = o * shown
            states[:, t] = hidden
        return states, kept

    def emissions(self, codes: np.ndarray) -> np.ndarray:
        """Scores [B, T, tags] of padded windows."""
        states, _ = self._run(codes)
        return self._emit(states)

    def _emit(self, states: np.ndarray) -> np.ndarray:
        joined = np.concatenate([states[0], states[1, ::-1]], axis=2).transpose(1, 0, 2)
        return joined @ self.weights["out"] + self.weights["bias"]

    def marginals(self, scores: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(tag probabilities [B, T, K], expected moves [K, K], log of the sum over all paths [B]).

        mask [B, T] is true inside the text, from the first column on.
        """
        moves = self.weights["moves"] + self.allowed
        batch, steps, tags = scores.shape
        start = np.where(np.arange(tags) % 2 == 0, FORBIDDEN, 0.0)
        start[0] = 0
        ahead = np.zeros_like(scores)
        ahead[:, 0] = scores[:, 0] + start
        for t in range(1, steps):
            reach = _log_sum(ahead[:, t - 1, :, None] + moves, 1) + scores[:, t]
            ahead[:, t] = np.where(mask[:, t, None], reach, ahead[:, t - 1])
        total = _log_sum(ahead[:, -1], 1)
        behind = np.zeros_like(scores)
        expected = np.zeros((tags, tags))
        for t in range(steps - 2, -1, -1):
            onward = scores[:, t + 1] + behind[:, t + 1]
            reach = _log_sum(moves + onward[:, None, :], 2)
            live = mask[:, t + 1]
            behind[:, t] = np.where(live[:, None], reach, behind[:, t + 1])
            if live.any():
                joint = ahead[live, t, :, None] + moves + onward[live][:, None, :] - total[live, None, None]
                expected += np.exp(joint).sum(0)
        chances = np.exp(ahead + behind - total[:, None, None]) * mask[:, :, None]
        return chances, expected, total

    def step(self, codes: np.ndarray, gold: np.ndarray, mask: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """(mean loss per window, gradients) of the negative log-likelihood of the gold tags."""
        n, (batch, steps) = self.hidden, codes.shape
        states, kept = self._run(codes)
        scores = self._emit(states)
        chances, expected, total = self.marginals(scores, mask)
        row, col = np.nonzero(mask)
        truth = np.zeros_like(scores)
        truth[row, col, gold[row, col]] = 1
        along = mask[:, 1:]
        taken = np.zeros_like(expected)
        np.add.at(taken, (gold[:, :-1][along], gold[:, 1:][along]), 1)
        loss = total.sum() - (scores * truth).sum() - (taken * self.weights["moves"]).sum()
        d_scores = (chances - truth) / batch
        joined = np.concatenate([states[0], states[1, ::-1]], axis=2).transpose(1, 0, 2)
        grads = {
            "moves": (expected - taken) / batch,
            "bias": d_scores.sum((0, 1)),
            "out": np.einsum("btn,btk->nk", joined, d_scores),
            "input": np.zeros_like(self.weights["input"]),
            "again": np.zeros_like(self.weights["again"]),
        }
        d_joined = (d_scores @ self.weights["out"].T).transpose(1, 0, 2)
        d_states = np.stack([d_joined[..., :n], d_joined[::-1, :, n:]])
        both = np.stack([codes, codes[:, ::-1]])
        d_hidden, d_cell = np.zeros((2, batch, n)), np.zeros((2, batch, n))
        for t in range(steps - 1, -1, -1):
            hidden, before, i, f, o, new, shown = kept[t]
            d_hidden = d_hidden + d_states[:, t]
            d_cell = d_cell + d_hidden * o * (1 - shown * shown)
            d_gates = np.concatenate(
                [d_cell * new * i * (1 - i), d_cell * before * f * (1 - f), d_hidden * shown * o * (1 - o), d_cell * i * (1 - new * new)],
                axis=2,
            )
            grads["again"] += hidden.transpose(0, 2, 1) @ d_gates
            for d in (0, 1):
                np.add.at(grads["input"][d], both[d][:, t], d_gates[d])
            d_hidden = d_gates @ self.weights["again"].transpose(0, 2, 1)
            d_cell = d_cell * f
        return loss / batch, grads

    def fit(self, codes: np.ndarray, gold: np.ndarray, mask: np.ndarray, epochs: int, batch: int = 64, rate: float = 0.02) -> list[float]:
        """Adam over shuffled batches; the mean loss of each epoch."""
        random, losses = np.random.default_rng(self.seed), []
        mean = {k: np.zeros_like(w) for k, w in self.weights.items()}
        square = {k: np.zeros_like(w) for k, w in self.weights.items()}
        count = 0
        for epoch in range(epochs):
            order, spent = random.permutation(len(codes)), []
            for first in range(0, len(order), batch):
                own = order[first : first + batch]
                loss, grads = self.step(codes[own], gold[own], mask[own])
                spent.append(loss)
                count += 1
                size = np.sqrt(sum((g * g).sum() for g in grads.values()))
                pace = rate * (1 - 0.9 * epoch / epochs)
                for name, grad in grads.items():
                    grad = grad * min(1.0, 5.0 / (size + 1e-12))
                    mean[name] = 0.9 * mean[name] + 0.1 * grad
                    square[name] = 0.99 * square[name] + 0.01 * grad * grad
                    change = mean[name] / (1 - 0.9**count) / (np.sqrt(square[name] / (1 - 0.99**count)) + 1e-8)
                    self.weights[name] = self.weights[name] - pace * change
            losses.append(float(np.mean(spent)))
        return losses

    def decode(self, codes: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(best tags [B, T], the probability of each of these tags [B, T])."""
        scores = self.emissions(codes)
        moves = self.weights["moves"] + self.allowed
        batch, steps, tags = scores.shape
        start = np.where(np.arange(tags) % 2 == 0, FORBIDDEN, 0.0)
        start[0] = 0
        best, back = scores[:, 0] + start, np.zeros((batch, steps, tags), np.int64)
        for t in range(1, steps):
            options = best[:, :, None] + moves
            came = options.argmax(1)
            reach = np.take_along_axis(options, came[:, None, :], 1)[:, 0] + scores[:, t]
            live = mask[:, t, None]
            best = np.where(live, reach, best)
            back[:, t] = np.where(live, came, np.arange(tags))
        path = np.zeros((batch, steps), np.int64)
        path[:, -1] = best.argmax(1)
        for t in range(steps - 1, 0, -1):
            path[:, t - 1] = np.take_along_axis(back[:, t], path[:, t, None], 1)[:, 0]
        chances, _, _ = self.marginals(scores, mask)
        return np.where(mask, path, 0), np.take_along_axis(chances, path[:, :, None], 2)[:, :, 0]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis)
    return top + np.log(np.exp(x - np.expand_dims(top, axis)).sum(axis))
