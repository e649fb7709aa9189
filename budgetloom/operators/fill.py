"""The budget fill: in a total order, keep rows until the running length reaches a target, the last one whole.

``budget_fill`` has three physical forms with one result.  ``window`` is one
running sum: a global order, or a hot group, is sorted in one task, so it is for
small tables.  ``two_phase`` first adds up lengths in buckets of the leading
score, a narrow aggregate; buckets beyond the target are dropped before anything
is shuffled, and only rows of one bucket are sorted together.  A bucket of one
score value, as a tie floor makes, is cut again by the tie's hash.  ``hash_fill``
is the same for random orders within groups.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from budgetloom.operators.gates import Stop

#: Buckets of a global order, of each group's order, and of a bucket of one value.
BUCKETS, GROUP_BUCKETS, TIE_BUCKETS = 4096, 64, 256


@dataclass(frozen=True)
class Lead:
    """What a total order starts with: a numeric column, its direction, and a hash (hexadecimal) that breaks its ties."""

    value: Column
    descending: bool = True
    tie: Column | None = None


def hash_lead(hexadecimal: Column) -> Lead:
    """The lead of an order by a hash in hexadecimal."""
    return Lead(F.conv(F.substring(hexadecimal, 1, 8), 16, 10).cast("double"), False)


def _kept(target: Column) -> Column:
    return (F.col("rn") == 1) | (F.col("before_len") < target)


def budget_fill(df: DataFrame, order: list[Column], length: str, target: float | Column, partition_by: list[str] | None = None, method: str = "window", lead: Lead | None = None) -> DataFrame:
    """The kept rows with ``rn`` (place from 1) and ``before_len`` (sum of the lengths before).

    order has to be total (end it with the key); lengths are at least 1.  A
    non-empty group with a target of 0 or less keeps its first row; a group
    below its target is kept whole.  target is a number, or a column that is
    constant within a group.  ``two_phase`` needs the order's lead.
    """
    goal = target if isinstance(target, Column) else F.lit(target)
    if method == "two_phase":
        return running_sum(df, order, length, lead, partition_by, goal).where(_kept(goal))
    if method != "window":
        raise ValueError(f"no method {method!r}")
    w = Window.partitionBy(*(partition_by or [])).orderBy(*order)
    before = F.coalesce(F.sum(length).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")
    return df.withColumn("rn", F.row_number().over(w).cast("long")).withColumn("before_len", before).where(_kept(goal))


def strict_fill(df: DataFrame, order: list[Column], length: str, target: float, name: str, lead: Lead | None = None) -> DataFrame:
    """``budget_fill`` to a number, where falling short of it stops the run: the whole supply is added up first."""
    supply = df.agg(F.coalesce(F.sum(length), F.lit(0))).first()[0]
    if supply < target:
        raise Stop(f"{name}: {supply} of {target} are available")
    return budget_fill(df, order, length, target, method="two_phase", lead=lead)


def running_sum(df: DataFrame, order: list[Column], amount: str | Column, lead: Lead | None = None, group: list[str] | None = None, goal: Column | None = None) -> DataFrame:
    """``df`` with ``rn`` (place from 1) and ``before_len`` (sum of ``amount`` before) in a total order.

    With a goal, rows of buckets that begin beyond it are left out.  lead is the
    order's first part; nulls in it come last.
    """
    if lead is None:
        raise ValueError("a running sum needs the lead of its order")
    group = group or []
    buckets = GROUP_BUCKETS if group else BUCKETS
    rows = df.withColumn("__amount", (amount if isinstance(amount, Column) else F.col(amount)).cast("long")).withColumn("__lead", lead.value.cast("double"))
    if lead.descending:
        rows = rows.withColumn("__lead", -F.col("__lead"))
    ends = rows.agg(F.min("__lead").alias("__lo"), F.max("__lead").alias("__hi"))  # one row
    place = F.floor((F.col("__lead") - F.col("__lo")) / F.greatest(F.col("__hi") - F.col("__lo"), F.lit(1e-300)) * (buckets - 1))
    rows = rows.join(F.broadcast(ends)).withColumn("__b", F.coalesce(place, F.lit(buckets)).cast("int")).drop("__lo", "__hi")
    sub = F.conv(F.substring(lead.tie, 1, 2), 16, 10).cast("int") if lead.tie is not None else F.lit(0)
    fine = [*group, "__b"]
    # a bucket that holds one value only is cut by the tie, whose hash follows the value in the order
    sums = rows.groupBy(*fine, sub.alias("__t")).agg(F.sum("__amount").alias("__s"), F.count("*").alias("__n"), F.min("__lead").alias("__x"), F.max("__lead").alias("__y"))
    whole = Window.partitionBy(*fine)
    one = (F.min("__x").over(whole) == F.max("__y").over(whole)) | F.col("__x").isNull()
    cut = sums.withColumn("__t", F.when(one, F.col("__t")).otherwise(-1)).groupBy(*fine, "__t").agg(F.sum("__s").alias("__s"), F.sum("__n").alias("__n"))
    w = Window.partitionBy(*group).orderBy("__b", "__t").rowsBetween(Window.unboundedPreceding, -1)  # at most buckets x TIE_BUCKETS rows
    off = cut.withColumn("__off", F.coalesce(F.sum("__s").over(w), F.lit(0))).withColumn("__rn", F.coalesce(F.sum("__n").over(w), F.lit(0))).drop("__s", "__n")
    if goal is not None and not group:
        off = off.where((F.col("__off") < goal) | (F.col("__rn") == 0))
    keyed = rows.withColumn("__t0", sub)
    same = (F.col("__t") == -1) | (F.col("__t") == F.col("__t0"))
    if group:
        on = [F.col(f"r.{g}").eqNullSafe(F.col(f"o.{g}")) for g in group]
        joined = keyed.alias("r").join(off.alias("o"), [*on, F.col("r.__b") == F.col("o.__b"), same]).select("r.*", "o.__t", "o.__off", "o.__rn")
        if goal is not None:
            joined = joined.where((F.col("__off") < goal) | (F.col("__rn") == 0))
    else:
        joined = keyed.alias("r").join(F.broadcast(off).alias("o"), [F.col("r.__b") == F.col("o.__b"), same]).select("r.*", "o.__t", "o.__off", "o.__rn")
    inner = Window.partitionBy(*fine, "__t").orderBy(*order)
    return (
        joined.withColumn("rn", (F.row_number().over(inner) + F.col("__rn")).cast("long"))
        .withColumn("before_len", (F.coalesce(F.sum("__amount").over(inner.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("__off")).cast("long"))
        .drop("__amount", "__lead", "__b", "__t0", "__t", "__off", "__rn")
    )


def hash_fill(df: DataFrame, key: str, length: str, group: list[str], quotas: DataFrame, seed: int, buckets: int = 1024, coin: bool = False) -> DataFrame:
    """Rows drawn at random in each group until their lengths reach its quota, the last one whole.

    quotas: the group's columns, ``quota`` (sum of lengths) and ``floor`` (rows
    that are drawn in any case); groups without a line are left out.  With
    ``coin`` the last row, the one that crosses the quota, is drawn with the
    chance of its part below it, so that the expected sum is the quota.  The
    order is the hash of seed and key, then the key.  A group that holds a third of
    all rows is spread over ``buckets`` sorts.
    """
    h = F.xxhash64(F.lit(seed), F.col(key))
    hashed = df.withColumn("__h", h).withColumn("__b", F.pmod(F.shiftright("__h", 40), F.lit(buckets)))
    sums = hashed.groupBy(*group, "__b").agg(F.sum(length).alias("__s"), F.count("*").alias("__n"))
    w = Window.partitionBy(*group).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*group, "__b", F.coalesce(F.sum("__s").over(w), F.lit(0)).alias("__so"), F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__no")).join(F.broadcast(quotas), group)
    offsets = offsets.where("__so < quota or __no < floor")
    inner = Window.partitionBy(*group, "__b").orderBy("__h", key)
    rows = hashed.join(offsets, [*group, "__b"])
    rows = rows.withColumn("__before", F.coalesce(F.sum(length).over(inner.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("__so"))
    rows = rows.withColumn("__rank", F.row_number().over(inner) - 1 + F.col("__no"))
    drawn = F.col("__before") < F.col("quota")
    if coin:
        part = (F.col("quota") - F.col("__before")) / F.col(length)
        drawn = drawn & (F.pmod(F.xxhash64(F.lit(seed + 1), F.col(key)), F.lit(1 << 20)) < part * (1 << 20))
    return rows.where(drawn | (F.col("__rank") < F.col("floor"))).drop("__h", "__b", "__so", "__no", "__before", "__rank", "quota", "floor")
