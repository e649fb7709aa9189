"""Budgets of a run and the rules between them, checked when they are made."""

from __future__ import annotations

from dataclasses import dataclass

from budgetloom.operators.gates import Stop

ARMS = ("base_prefix", "quality_prefix", "styled_random", "oversample_refilter", "topic_quota", "disagreement")


@dataclass(frozen=True)
class Budgets:
    """Token budgets: the target B, the sources of the arms, and the training horizons.

    A source is twice B; the oversampled arm's is kappa times a source; horizons
    are whole epochs of 2 B.  Breaking a rule stops the run.
    """

    target: int
    source: int
    oversample: int
    kappa: int = 2
    spread_weight: float = 0.5
    low_quantile: float = 0.3
    high_quantile: float = 0.9
    arms: tuple[str, ...] = ARMS
    horizons: tuple[int, ...] = (1, 2, 3)
    seeds: tuple[int, ...] = (42, 43, 44)

    def __post_init__(self):
        rules = {
            "the target must be positive": self.target > 0,
            "a source is twice the target": self.source == 2 * self.target,
            "the oversampled source is kappa sources": self.oversample == self.kappa * self.source,
            "the spread's weight is between 0 and 1": 0 <= self.spread_weight <= 1,
            "quantiles are between 0 and 1": 0 < self.low_quantile < 1 and 0 < self.high_quantile < 1,
            "there are six different arms": len(set(self.arms)) == 6 and set(self.arms) == set(ARMS),
            "horizons are 1, 2 and 3 epochs": self.horizons == (1, 2, 3),
            "there are three different seeds": len(set(self.seeds)) == 3,
        }
        broken = [k for k, ok in rules.items() if not ok]
        if broken:
            raise Stop("; ".join(broken))

    @classmethod
    def of_pool(cls, tokens: int, part: int = 12) -> Budgets:
        """Budgets for a pool of so many tokens: the target is one part of it."""
        b = max(1, tokens // part)
        return cls(b, 2 * b, 4 * b)

    def horizon_plan(self, corpus_tokens: int) -> list[tuple[int, float]]:
        """(training tokens, passes over the corpus) of each horizon."""
        return [(k * 2 * self.target, round(k * 2 * self.target / max(1, corpus_tokens), 6)) for k in self.horizons]
