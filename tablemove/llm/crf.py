"""A linear-chain conditional random field over the tags O, B and I: training and exact decoding."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np

#: Tags: outside, begin and inside of a span.
O, B, I = 0, 1, 2  # noqa: E741


@dataclass(frozen=True)
class Field:
    """Weights of features (a row of three for each) and of a tag after another one.

    The tag before the first token counts as O; nothing follows the last one.
    """

    weights: dict[str, tuple[float, float, float]]
    follow: np.ndarray

    def score(self, features: list[str]) -> np.ndarray:
        known = [self.weights[f] for f in features if f in self.weights]
        return np.sum(known, axis=0) if known else np.zeros(3)

    def margins(self) -> np.ndarray:
        """By how much B and I have to be behind O at a token, so that its best tag is O whatever surrounds it.

        Whatever the tags beside it are, putting O there can't lose more than this in transitions.
        """
        t = self.follow
        result = np.zeros(2)
        for z in (B, I):
            before = (t[:, z] - t[:, O]).max()
            result[z - 1] = max(before, before + (t[z, :] - t[O, :]).max())
        return result

    def best(self, scores: np.ndarray, closed: bool) -> list[int]:
        """The best tags of some tokens after an O, and before an O if ``closed``; O wins ties, then B."""
        t = self.follow
        now, back = t[O] + scores[0], []
        for row in scores[1:]:
            ways = now[:, None] + t
            back.append(ways.argmax(0))
            now = ways.max(0) + row
        tag = int((now + t[:, O] if closed else now).argmax())
        tags = [tag]
        for step in reversed(back):
            tag = int(step[tag])
            tags.append(tag)
        return tags[::-1]


def _sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(values - top).sum(axis))


def fit(sequences: list[tuple[list[list[str]], list[int]]], rounds: int = 60, decay: float = 1e-3, rate: float = 0.15, seen: int = 3) -> Field:
    """Weights that make the given tags likely: Adam steps along the whole gradient, with a decay of squares.

    A sequence has the features of each token, and its tags; features met less than ``seen`` times are left out.
    The result depends on nothing else.
    """
    often = Counter(f for rows, _ in sequences for row in rows for f in row)
    names = {f: i for i, f in enumerate(f for f, n in often.items() if n >= seen)}
    width = max((len(tags) for _, tags in sequences), default=1)
    token, feature = [], []
    gold = np.zeros((len(sequences), width), np.int64)
    inside = np.zeros((len(sequences), width), bool)
    for s, (rows, tags) in enumerate(sequences):
        gold[s, : len(tags)] = tags
        inside[s, : len(tags)] = True
        for i, row in enumerate(rows):
            known = [names[f] for f in row if f in names]
            token += [s * width + i] * len(known)
            feature += known
    token, feature = np.array(token, np.int64), np.array(feature, np.int64)
    weights, follow = np.zeros((len(names), 3)), np.zeros((3, 3))
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (weights, follow)]
    hot = np.eye(3)[gold] * inside[..., None]
    before = np.concatenate([np.tile(np.eye(3)[O], (len(sequences), 1, 1)), hot[:, :-1]], 1)
    counted = np.einsum("sti,stj->ij", before, hot)
    for step in range(1, rounds + 1):
        scores = np.stack([np.bincount(token, weights[feature, y], gold.size) for y in range(3)], 1)
        tags, pairs = _marginals(scores.reshape(*gold.shape, 3), follow, inside)
        lean = (hot - tags).reshape(-1, 3)
        slopes = [
            np.stack([np.bincount(feature, lean[token, y], len(names)) for y in range(3)], 1) - decay * len(sequences) * weights / 100,
            counted - pairs - decay * len(sequences) * follow / 100,
        ]
        for value, slope, moment in zip((weights, follow), slopes, moments, strict=True):
            moment[0] = 0.9 * moment[0] + 0.1 * slope
            moment[1] = 0.99 * moment[1] + 0.01 * slope**2
            value += rate * (moment[0] / (1 - 0.9**step)) / (np.sqrt(moment[1] / (1 - 0.99**step)) + 1e-6)
    return Field({n: tuple(weights[i]) for n, i in names.items()}, follow)


def _marginals(scores: np.ndarray, follow: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of the tags of all tokens, and expected counts of a tag after another."""
    count, width, _ = scores.shape
    forward = np.empty_like(scores)
    forward[:, 0] = follow[O] + scores[:, 0]
    for i in range(1, width):
        ahead = _sum(forward[:, i - 1, :, None] + follow, 1) + scores[:, i]
        forward[:, i] = np.where(inside[:, i, None], ahead, forward[:, i - 1])
    backward = np.zeros_like(scores)
    for i in range(width - 2, -1, -1):
        behind = _sum(follow + (scores[:, i + 1] + backward[:, i + 1])[:, None, :], 2)
        backward[:, i] = np.where(inside[:, i + 1, None], behind, 0)
    total = _sum(forward[:, -1], 1)
    tags = np.exp(forward + backward - total[:, None, None]) * inside[..., None]
    ways = forward[:, :-1, :, None] + follow + (scores[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None]
    pairs = (np.exp(np.where(inside[:, 1:, None, None], ways, -np.inf))).sum((0, 1))
    pairs[O] += tags[:, 0].sum(0)
    return tags, pairs
