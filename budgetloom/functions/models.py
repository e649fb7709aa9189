"""Tokenizers and classifiers as parameters: functions that a worker makes once and Arrow batches call.

``make`` is a function without arguments that returns the model's function; it
runs in the worker, so that a model need not be sent.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a classifier calls a text of high quality.
HIGH = "hq"


def token_counter(make: Callable[[], Callable[[str], int]]) -> Callable[[Column], Column]:
    """A function of a text column: its tokens without special ones; null and empty texts have 0."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = make()
        for texts in batches:
            yield pd.Series([tokens(t) if t else 0 for t in texts], dtype="int64")

    return count


def classifier(make: Callable[[], Callable[[list[str]], list[tuple[str, float]]]]) -> Callable[[Column], Column]:
    """A function of a text column: (label, p) of each text; texts of one batch are given together."""

    @F.pandas_udf("label string, p double")
    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        labels = make()
        for texts in batches:
            yield pd.DataFrame(labels([t or "" for t in texts]), columns=["label", "p"])

    return classify


def raw_score(text: Column, label: Column, p: Column) -> Column:
    """The probability of high quality: p if that is the label, else 1 - p; a text without a character has 0."""
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, 0.0).when(label == HIGH, p).otherwise(1 - p)


def pieces() -> Callable[[str], int]:
    """A stand-in tokenizer: pieces between white space."""
    return lambda text: len(text.replace("\t", " ").replace("\r", " ").replace("\n", " ").split(" ")) - sum(x == "" for x in text.replace("\t", " ").replace("\r", " ").replace("\n", " ").split(" "))


def by_length() -> Callable[[list[str]], list[tuple[str, float]]]:
    """A stand-in classifier: even lengths are of high quality, the surer the larger their remainder by 50."""
    return lambda texts: [(HIGH if len(t) % 2 == 0 else "lq", 0.5 + (len(t) % 50) / 100) for t in texts]
