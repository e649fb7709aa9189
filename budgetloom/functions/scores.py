"""Score columns of the pool and hash streams, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEED = 42
#: Weight of the spread in ``u``.
SPREAD_WEIGHT = 0.5


def stream(name: str, *keys: str, seed: int = SEED) -> Column:
    """A named random order: the md5 of seed, name and keys, the same whatever the partitioning."""
    return F.md5(F.concat_ws(":", F.lit(f"{seed}:{name}"), *(F.col(k).cast("string") for k in keys)))


def train_len(tokens: str) -> Column:
    """Stored tokens and one for the end of the document; null counts as 0 tokens."""
    return (F.coalesce(F.col(tokens), F.lit(0)) + 1).cast("long")


def consensus(*scores: str) -> Column:
    """Mean of the scores, in single precision."""
    total = F.col(scores[0])
    for s in scores[1:]:
        total = total + F.col(s)
    return (total / len(scores)).cast("float")


def disagreement(q: str, *scores: str) -> Column:
    """Population variance of the scores about ``q``, in single precision (squares by multiplication)."""
    squares = [(F.col(s) - F.col(q)) * (F.col(s) - F.col(q)) for s in scores]
    total = squares[0]
    for s in squares[1:]:
        total = total + s
    return (total / len(scores)).cast("float")


def upper_score(q: str, v: str, weight: float = SPREAD_WEIGHT) -> Column:
    """``q`` plus the weighted standard deviation, in single precision."""
    return (F.col(q) + F.lit(weight).cast("float") * F.sqrt(v).cast("float")).cast("float")


def score_key(name: str) -> Column | None:
    """The assembly key by its name: a score, ``u``, or none for a random order."""
    known = {"s1": F.col("s1"), "s2": F.col("s2"), "s3": F.col("s3"), "u": F.col("u"), "random": None}
    if name not in known:
        raise ValueError(f"no assembly key {name!r}")
    return known[name]
