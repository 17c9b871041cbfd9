"""A small averaged perceptron over named features."""

from __future__ import annotations

import random
from collections import defaultdict
from collections.abc import Iterable


#: The right label must lead by so much in training, or the weights are moved.
GAP = 1.0


class Perceptron:
    """``weights[feature][label]``; labels may be limited per decision."""

    def __init__(self, weights: dict[str, dict[str, float]]):
        self.weights = weights

    def scores(self, features: Iterable[str], labels: Iterable[str]) -> dict[str, float]:
        out = dict.fromkeys(labels, 0.0)
        weights = self.weights
        for f in features:
            own = weights.get(f)
            if own:
                for label, w in own.items():
                    if label in out:
                        out[label] += w
        return out

    def margin(self, features: Iterable[str]) -> float:
        """Of "yes" over "no"."""
        s = self.scores(features, ("yes", "no"))
        return s["yes"] - s["no"]

    @classmethod
    def fit(cls, examples: list[tuple[list[str], str, tuple[str, ...]]], rounds: int = 5, seed: int = 7) -> Perceptron:
        """Averaged over all updates; ``examples``: (features, right label, possible labels)."""
        now: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
        total: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
        order, step = list(range(len(examples))), 1
        shuffle = random.Random(seed).shuffle
        for _ in range(rounds):
            shuffle(order)
            for k in order:
                features, right, labels = examples[k]
                s = dict.fromkeys(labels, 0.0)
                for f in features:
                    for label, w in now[f].items() if f in now else ():
                        if label in s:
                            s[label] += w
                guess = max((x for x in labels if x != right), key=lambda x: (s[x], x))
                if s[right] < s[guess] + GAP:
                    for f in features:
                        now[f][right] += 1
                        total[f][right] += step
                        now[f][guess] -= 1
                        total[f][guess] -= step
                step += 1
        return cls({f: {label: w - total[f][label] / step for label, w in own.items() if w or total[f][label]} for f, own in now.items()})
