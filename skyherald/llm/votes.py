"""A two-class model of labelling rules that vote for (1), against (-1) or abstain (0)."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class VoteModel:
    """Prior probability of good, and per rule the probability of each vote given good and given bad."""

    prior: float
    given: tuple[tuple[tuple[float, float, float], tuple[float, float, float]], ...]

    def accuracies(self) -> list[float]:
        """Probability that a rule that votes is right."""
        p, out = self.prior, []
        for good, bad in self.given:
            right, wrong = p * good[2] + (1 - p) * bad[0], p * good[0] + (1 - p) * bad[2]
            out.append(right / (right + wrong))
        return out

    def weights(self) -> list[list[float]]:
        """Log odds that each vote adds. A bad vote never speaks for a document, a good one never against it."""
        logs = [[math.log(good[k] / bad[k]) for k in range(3)] for good, bad in self.given]
        return [[min(0.0, bad), none, max(0.0, good)] for bad, none, good in logs]

    def log_odds(self, votes: Sequence[Column]) -> Column:
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for v, weight in zip(votes, self.weights(), strict=True):
            odds = odds + F.when(v == -1, weight[0]).when(v == 1, weight[2]).otherwise(weight[1])
        return odds


def fit_votes(
    patterns: list[tuple[tuple[int, ...], int]], rules: int, prior: float = 0.8, rounds: int = 50
) -> VoteModel:
    """Expectation-maximisation over counted vote patterns (two classes, votes independent given the class).

    Starts from rules that are mostly right, which also fixes which class is called good. One pseudo-document per
    class and vote keeps every probability above zero. Without patterns the model is the start.
    """
    n = rules
    patterns = sorted(patterns)
    given = [((0.1, 0.2, 0.7), (0.5, 0.3, 0.2)) for _ in range(n)]
    for _ in range(rounds if patterns else 0):
        sums = [[[1.0] * 3, [1.0] * 3] for _ in range(n)]
        total = [1.0, 1.0]
        weights = VoteModel(prior, tuple(given)).weights()
        for votes, count in patterns:
            odds = math.log(prior / (1 - prior)) + sum(w[v + 1] for v, w in zip(votes, weights, strict=True))
            p = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
            for cls, share in ((0, p), (1, 1 - p)):
                total[cls] += count * share
                for j, v in enumerate(votes):
                    sums[j][cls][v + 1] += count * share
        prior = total[0] / (total[0] + total[1])
        given = [tuple(tuple(x / sum(side) for x in side) for side in rule) for rule in sums]
    return VoteModel(prior, tuple(given))
