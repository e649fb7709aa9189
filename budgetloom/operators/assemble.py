"""Filling the second budget from the rewritten passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from budgetloom.operators.fill import Lead, budget_fill

#: pass -> tier: rows of the first pass are taken before any of the second.
TIERS = {"p1": 0, "distill": 1}


def completed(passes: DataFrame) -> DataFrame:
    """Rows that finished, with their length (tokens and one) and tier."""
    tier = F.when(F.col("pass_name") == "p1", TIERS["p1"]).otherwise(TIERS["distill"])
    return passes.where("status = 2").withColumn("len", (F.coalesce("rewritten_tokens", F.lit(0)) + 1).cast("long")).withColumn("tier", tier)


#: More than a rank may differ, so that tiers never mix.
RANK_SPAN = 64


def assemble(passes: DataFrame, rank: Column, target: float | Column, group: list[str] | None = None, method: str = "two_phase") -> DataFrame:
    """Kept rows with ``rn`` and ``before_len``: all of the first pass by rank, then the second's, to the target.

    rank is a number between -``RANK_SPAN`` / 2 and ``RANK_SPAN`` / 2, taken from
    the least.  A document may be kept once for each pass.  Below the target
    everything is kept and nothing is padded.
    """
    order = [F.col("tier").asc(), rank.asc(), F.col("doc_id").asc(), F.col("rewrite_id").asc()]
    lead = Lead(F.col("tier") * RANK_SPAN + rank.cast("double"), False)
    return budget_fill(completed(passes), order, "len", target, group, method, lead)


def accounting(kept: DataFrame, by: list[str], target: float | None = None) -> DataFrame:
    """Documents and tokens kept, by the given columns; with a target also what is missing of it and what is over, and whether the second pass was used."""
    sums = [F.count("*").cast("long").alias("docs"), F.sum("len").cast("long").alias("tokens")]
    if target is None:
        return kept.groupBy(*by).agg(*sums)
    one = kept.groupBy(*by).agg(*sums, (F.max("tier") > 0).alias("used_distill"))
    gap = F.lit(target).cast("double") - F.col("tokens")
    return one.withColumn("shortfall", F.bround(F.greatest(gap, F.lit(0.0))).cast("long")).withColumn("overshoot", F.bround(F.greatest(-gap, F.lit(0.0))).cast("long"))
