"""Hard stops: checks that return rows (check_name, ok, detail), and ``stop_unless``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Stop(RuntimeError):
    """A gate failed; nothing downstream may run."""


def line(df: DataFrame, name: str, bad: str) -> DataFrame:
    """One line of a check from a one-row table that holds the number of bad rows in ``bad``."""
    return df.select(F.lit(name).alias("check_name"), (F.col(bad) == 0).alias("ok"), F.col(bad).cast("long").alias("detail"))


def overlap(a: DataFrame, b: DataFrame, key: str, name: str) -> DataFrame:
    """No key of ``a`` may stand in ``b``."""
    return line(a.select(key).join(b.select(key), key, "left_semi").agg(F.count("*").alias("n")), name, "n")


def contained(a: DataFrame, b: DataFrame, key: str, name: str) -> DataFrame:
    """Every key of ``a`` has to stand in ``b``."""
    return line(a.select(key).join(b.select(key), key, "left_anti").agg(F.count("*").alias("n")), name, "n")


def unique(a: DataFrame, key: str, name: str) -> DataFrame:
    """No key may stand twice."""
    return line(a.groupBy(key).count().where("count > 1").agg(F.count("*").alias("n")), name, "n")


def all_of(checks: list[DataFrame]) -> DataFrame:
    """The lines of several checks."""
    return reduce(DataFrame.unionByName, checks)


def stop_unless(checks: DataFrame) -> None:
    """Raise ``Stop`` with the lines that failed, of which there is one for each check."""
    failed = [f"{r['check_name']}: {r['detail']}" for r in checks.where("not ok").collect()]
    if failed:
        raise Stop("; ".join(failed))
