"""Percentiles of scores with ties, without a global sort in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from budgetloom.operators.fill import BUCKETS, Lead, running_sum

#: A score value held by more than this part of the rows is hot; there are fewer than its inverse of them.
HOT_PART = 1e-3


def _of_values(df: DataFrame, score: str, values: DataFrame, n_rows: int, out: str) -> DataFrame:
    """``df`` with the column ``out`` of its score's line in values (score, __n, out).

    Hot values, of which there are under a thousand, come by broadcast; null
    scores and hot ones take no part in the shuffle by score.
    """
    hot = F.broadcast(values.where(F.col("__n") > HOT_PART * n_rows).select(score, F.col(out).alias("__hot")))
    marked = df.join(hot, score, "left")
    done = marked.where(F.col("__hot").isNotNull() | F.col(score).isNull()).withColumnRenamed("__hot", out)
    rest = marked.where(F.col("__hot").isNull() & F.col(score).isNotNull()).drop("__hot").join(values.select(score, out), score, "left")
    return done.select(*df.columns, out).unionByName(rest.select(*df.columns, out))


def tie_percentile(df: DataFrame, score: str, out: str) -> DataFrame:
    """``df`` with the mean rank of each row's tie group, divided by the number of rows.

    Ranks are made on the distinct values' counts, so that a tie group of any
    size is one row of the sum.  Null scores have no percentile.
    """
    counts = df.where(F.col(score).isNotNull()).groupBy(score).agg(F.count("*").alias("__n"))
    total = df.where(F.col(score).isNotNull()).count()
    ranked = running_sum(counts, [F.col(score).asc()], "__n", Lead(F.col(score), False))
    pct = ((F.col("before_len") + (F.col("__n") + 1) / 2) / F.lit(max(1, total))).cast("double")
    return _of_values(df, score, ranked.select(score, "__n", pct.alias(out)), total, out)


def percentile_vs_reference(df: DataFrame, score: str, reference: DataFrame, value: str, out: str) -> DataFrame:
    """``df`` with the percentile that each score would have among the reference's values.

    The mean of the ranks before and after insertion, over the number of values:
    a score below all has 0.5 / N, one above all 1 + 0.5 / N.
    """
    known = reference.where(F.col(value).isNotNull())
    total = known.count()
    probes = df.withColumn("__v", F.col(score).cast("double"))
    values = known.select(F.col(value).cast("double").alias("__v"), F.lit(1).alias("__n"), F.lit(0).alias("__m")).unionByName(probes.where("__v is not null").select("__v", F.lit(0).alias("__n"), F.lit(1).alias("__m")))
    counts = values.groupBy("__v").agg(F.sum("__n").alias("__n"), F.sum("__m").alias("__m"))
    ranked = running_sum(counts, [F.col("__v").asc()], "__n", Lead(F.col("__v"), False))
    pct = ((F.col("before_len") + F.col("before_len") + F.col("__n") + 1) / 2 / F.lit(max(1, total))).cast("double")
    # what is hot here is a value of the probes
    lines = ranked.select("__v", F.col("__m").alias("__n"), pct.alias(out))
    return _of_values(probes, "__v", lines, max(1, total), out).drop("__v")


def exact_percentiles(df: DataFrame, columns: dict[str, tuple[str, float]]) -> dict[str, float | None]:
    """Exact percentiles with linear interpolation, by name: (column, share); None for a column without values.

    Values are counted in ``BUCKETS`` buckets between the extremes; only the
    buckets in which the wanted ranks fall are looked at by value.  Nothing is
    held by value in one task but the distinct values of those.
    """
    named = list(dict.fromkeys(c for c, _ in columns.values()))
    wide = df.select(*(F.col(c).cast("double").alias(c) for c in named))
    ends = wide.agg(*(f(c).alias(f"{n}_{c}") for c in named for n, f in (("lo", F.min), ("hi", F.max)))).first()
    out: dict[str, float | None] = {}
    for c in named:
        lo, hi = ends[f"lo_{c}"], ends[f"hi_{c}"]
        asked = {n: p for n, (col, p) in columns.items() if col == c}
        if lo is None:
            out |= dict.fromkeys(asked)
            continue
        values = wide.select(F.col(c).alias("v")).where("v is not null").withColumn("b", F.floor((F.col("v") - F.lit(lo)) / F.lit(max(hi - lo, 1e-300)) * (BUCKETS - 1)).cast("int"))
        filled = sorted((r["b"], r["n"]) for r in values.groupBy("b").agg(F.count("*").alias("n")).collect())  # at most BUCKETS rows
        total = sum(n for _, n in filled)
        ranks = {n: p * (total - 1) for n, p in asked.items()}
        wanted = sorted({k for r in ranks.values() for k in (int(r), min(int(r) + 1, total - 1))})
        before, of_bucket = 0, {}
        for b, n in filled:
            for k in wanted:
                if before <= k < before + n:
                    of_bucket[k] = (b, k - before)
            before += n
        counts = values.where(F.col("b").isin(sorted({b for b, _ in of_bucket.values()}))).groupBy("b", "v").agg(F.count("*").alias("n"))
        upto = counts.withColumn("upto", F.sum("n").over(Window.partitionBy("b").orderBy("v")))
        found = upto.agg(*(F.min(F.when((F.col("b") == b) & (F.col("upto") > inside), F.col("v"))).alias(f"at_{k}") for k, (b, inside) in of_bucket.items())).first()
        at = {k: found[f"at_{k}"] for k in of_bucket}
        for n, r in ranks.items():
            low, high = at[int(r)], at[min(int(r) + 1, total - 1)]
            out[n] = low + (high - low) * (r - int(r))
    return out


def order_desc(score: str, tie: Column, key: str) -> list[Column]:
    """The total order of a score: from the highest, ties by the hash order, then the key."""
    return [F.col(score).desc(), tie.asc(), F.col(key).asc()]
