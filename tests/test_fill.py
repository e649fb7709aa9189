"""The budget fill against a literal model, in all its forms."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from budgetloom.operators.assemble import assemble
from budgetloom.operators.fill import Lead, budget_fill, hash_fill, hash_lead, running_sum, strict_fill
from budgetloom.operators.gates import Stop


def model(rows, target):
    kept, total = [], 0
    for key, n in rows:
        if kept and total >= target:
            break
        kept.append(key)
        total += n
    return kept


def table(spark, rows):
    return spark.createDataFrame([(i, n) for i, n in enumerate(rows)], "k long, n long")


@pytest.mark.parametrize("method", ["window", "two_phase"])
@pytest.mark.parametrize("target,want", [(45, 3), (30, 2), (1000, 5), (0, 1), (-5, 1), (150, 5), (149, 5), (100, 4)])
def test_acceptance(spark, method, target, want):
    got = budget_fill(table(spark, [10, 20, 30, 40, 50]), [F.col("k").asc()], "n", target, method=method, lead=Lead(F.col("k"), False)).orderBy("k").collect()
    assert [r["k"] for r in got] == list(range(want))
    assert [r["before_len"] for r in got] == [0, 10, 30, 60, 100][:want]


@pytest.mark.parametrize("method", ["window", "two_phase"])
def test_empty(spark, method):
    assert budget_fill(table(spark, [1]).limit(0), [F.col("k").asc()], "n", 10, method=method, lead=Lead(F.col("k"), False)).count() == 0


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(1, 20)), min_size=1, max_size=60), st.integers(0, 300))
def test_two_phase_is_the_window(spark, rows, target):
    df = spark.createDataFrame([(i, s, n) for i, (s, n) in enumerate(rows)], "k long, s long, n long").repartition(5)
    order = [F.col("s").desc(), F.col("k").asc()]
    want = model([(i, n) for i, (s, n) in sorted(enumerate(rows), key=lambda x: (-x[1][0], x[0]))], target)
    for method in ("window", "two_phase"):
        assert sorted(r["k"] for r in budget_fill(df, order, "n", target, method=method, lead=Lead(F.col("s"))).collect()) == sorted(want)


def test_running_sum_counts_places(spark):
    got = running_sum(table(spark, [5, 1, 7]).repartition(3), [F.col("k").desc()], "n", Lead(F.col("k"))).orderBy("rn").collect()
    assert [(r["k"], r["rn"], r["before_len"]) for r in got] == [(2, 1, 0), (1, 2, 7), (0, 3, 8)]


@pytest.mark.parametrize("method", ["window", "two_phase"])
def test_by_group_with_quota_column(spark, method):
    df = spark.createDataFrame([("a", 1, 10, 15.0), ("a", 2, 10, 15.0), ("a", 3, 10, 15.0), ("b", 4, 1, 0.0)], "g string, k long, n long, q double")
    assert {r["k"] for r in budget_fill(df, [F.col("k").asc()], "n", F.col("q"), ["g"], method, Lead(F.col("k"), False)).collect()} == {1, 2, 4}


def test_hot_group_in_two_phases(spark):
    df = spark.range(4000).select(F.col("id").alias("k"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.pmod("id", F.lit(50)))).alias("g"), (F.col("id") % 7 + 1).alias("n"))
    order = [(F.col("k") % 11).desc(), F.col("k").asc()]
    a, b = (sorted(tuple(r) for r in budget_fill(df.repartition(6), order, "n", 90, ["g"], m, Lead(F.col("k") % 11)).select("k", "rn", "before_len").collect()) for m in ("window", "two_phase"))
    assert a == b


def test_hash_fill_reaches_quota_and_floor(spark):
    df = spark.range(5000).select(F.col("id").alias("k"), F.lit("hot").alias("g"), F.lit(3).cast("long").alias("n"))
    df = df.unionByName(spark.createDataFrame([(9001, "rare", 50), (9002, "rare", 50)], "k long, g string, n long"))
    quotas = spark.createDataFrame([("hot", 1000, 0), ("rare", 1, 2)], "g string, quota long, floor long")
    got = hash_fill(df, "k", "n", ["g"], quotas, 7, buckets=16)
    by = {r["g"]: r["c"] for r in got.groupBy("g").agg(F.count("*").alias("c")).collect()}
    assert by == {"hot": 334, "rare": 2}
    again = hash_fill(df.repartition(7), "k", "n", ["g"], quotas, 7, buckets=16)
    assert {r["k"] for r in got.collect()} == {r["k"] for r in again.collect()}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.booleans(), st.integers(0, 4), st.integers(0, 9)), min_size=1, max_size=40), st.integers(1, 200))
def test_assembly_is_the_two_branch_rule(spark, rows, target):
    data = [(i, i % 7, "p1" if p else "distill", 2, n, float(s)) for i, (p, s, n) in enumerate(rows)]
    first = sorted((r for r in data if r[2] == "p1"), key=lambda r: (-r[5], r[1], r[0]))
    second = sorted((r for r in data if r[2] != "p1"), key=lambda r: (-r[5], r[1], r[0]))
    total = sum(r[4] + 1 for r in first)
    want = [r[0] for r in first] + (model([(r[0], r[4] + 1) for r in second], target - total) if second else []) if total < target else model([(r[0], r[4] + 1) for r in first], target)
    df = spark.createDataFrame(data, "rewrite_id long, doc_id long, pass_name string, status int, rewritten_tokens long, s double")
    for method in ("window", "two_phase"):
        got = assemble(df, -F.col("s"), target, method=method).collect()
        if first or total < target:
            assert sorted(r["rewrite_id"] for r in got) == sorted(want)


def test_tie_floor_is_cut_by_the_hash(spark):
    """Rows of one score value, in the order of their hashes, and the same rows with a few others."""
    df = spark.range(3000).select(F.col("id").alias("k"), F.when(F.col("id") % 10 == 0, F.col("id") / 3000.0).otherwise(F.lit(0.04)).alias("s"), F.md5(F.col("id").cast("string")).alias("tie"), (F.col("id") % 5 + 1).alias("n"))
    order = [F.col("s").desc(), F.col("tie").asc(), F.col("k").asc()]
    lead = Lead(F.col("s"), True, F.col("tie"))
    for target in (10, 4000, 10**6):
        a, b = (sorted(tuple(r) for r in budget_fill(df.repartition(5), order, "n", target, method=m, lead=lead).select("k", "rn", "before_len").collect()) for m in ("window", "two_phase"))
        assert a == b
    h = F.md5(F.concat(F.lit("x"), F.col("k").cast("string")))
    a, b = (sorted(r["k"] for r in budget_fill(df.withColumn("h", h), [F.col("h").asc(), F.col("k").asc()], "n", 500, method=m, lead=hash_lead(F.col("h"))).collect()) for m in ("window", "two_phase"))
    assert a == b


def test_strict_fill_stops(spark):
    df = table(spark, [10, 20])
    assert strict_fill(df, [F.col("k").asc()], "n", 30, "base", Lead(F.col("k"), False)).count() == 2
    with pytest.raises(Stop, match="base: 30 of 31"):
        strict_fill(df, [F.col("k").asc()], "n", 31, "base", Lead(F.col("k"), False))
    with pytest.raises(Stop):
        strict_fill(df.limit(0), [F.col("k").asc()], "n", 1, "base", Lead(F.col("k"), False))


def test_hash_fill_with_a_coin_is_right_on_average(spark):
    """Many groups whose last row is much larger than what is left: their sums add up to the quotas."""
    df = spark.range(40_000).select(F.col("id").alias("k"), F.pmod("id", F.lit(400)).alias("g"), (F.col("id") % 89 + 30).cast("long").alias("n"))
    quotas = spark.range(400).select(F.col("id").alias("g"), F.lit(1000).cast("long").alias("quota"), F.lit(0).alias("floor"))
    one = lambda **kw: hash_fill(df, "k", "n", ["g"], quotas, 5, buckets=4, **kw).agg(F.sum("n")).first()[0]
    assert abs(one(coin=True) - 400_000) < 4_000 < one() - 400_000
