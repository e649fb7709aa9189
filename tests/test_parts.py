"""Ranking, gates, sources, configuration and streams."""

import pytest
from pyspark.sql import functions as F

from budgetloom.config import Budgets
from budgetloom.operators import gates
from budgetloom.operators.ranking import exact_percentiles, percentile_vs_reference, tie_percentile
from budgetloom.sources import shards
from budgetloom.streaming import leases


def test_tie_percentile(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate([0.0, 0.0, 0.1, 0.2, 0.2, 0.2, 0.9, None])], "i int, s double")
    got = {r["i"]: r["p"] for r in tie_percentile(df, "s", "p").collect()}
    assert [round(got[i] * 7, 6) if got[i] is not None else None for i in range(8)] == [1.5, 1.5, 3, 5, 5, 5, 7, None]


def test_percentile_vs_reference(spark):
    ref = spark.createDataFrame([(s,) for s in [0.0, 0.0, 0.1, 0.2, 0.2, 0.2, 0.9]], "v double")
    probes = spark.createDataFrame([(0, 0.0), (1, 0.1), (2, 0.2), (3, 0.9), (4, -1.0), (5, 2.0), (6, 0.2)], "i int, s double")
    got = {r["i"]: r["p"] for r in percentile_vs_reference(probes, "s", ref, "v", "p").collect()}
    assert [round(got[i] * 7, 6) for i in range(7)] == [1.5, 3, 5, 7, 0.5, 7.5, 5]


def test_exact_percentiles(spark):
    import random

    rnd = random.Random(2)
    values = [rnd.choice([0.04, 0.04, rnd.random(), rnd.random() ** 3]) for _ in range(501)] + [None]
    df = spark.createDataFrame([(v, 1.0) for v in values], "a double, b double").repartition(4)
    got = exact_percentiles(df, {"lo": ("a", 0.3), "hi": ("a", 0.9), "top": ("a", 1.0), "one": ("b", 0.5)})
    known = sorted(v for v in values if v is not None)
    assert abs(got["lo"] - known[150]) < 1e-12 and abs(got["hi"] - known[450]) < 1e-12 and got["top"] == known[-1] and got["one"] == 1.0
    four = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 10)], "a double")
    assert abs(exact_percentiles(four, {"m": ("a", 0.5)})["m"] - 2.5) < 1e-12
    assert exact_percentiles(four.limit(0), {"m": ("a", 0.5)}) == {"m": None}


def test_work_folder_has_to_be_named_on_a_cluster(monkeypatch):
    from budgetloom import session

    class Fake:
        class conf:
            get = staticmethod(lambda name, default=None: default)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.work_root(Fake)
    assert session.is_local("local[8]") and session.is_local("local") and not session.is_local("local-cluster[2,1,1024]")


def test_discarded_tables_are_gone(spark):
    from budgetloom import session

    t = session.stash(spark.range(3), "gone")
    assert t.count() == 3 and shards.exists(spark, t._stash)
    session.discard(t)
    assert not shards.exists(spark, t._stash)


def test_gates(spark):
    a, b = (spark.createDataFrame([(i,) for i in x], "k long") for x in ([1, 2], [2, 3]))
    checks = gates.all_of([gates.overlap(a, b, "k", "o"), gates.contained(a, b, "k", "c"), gates.unique(a, "k", "u")])
    assert {r["check_name"]: (r["ok"], r["detail"]) for r in checks.collect()} == {"o": (False, 1), "c": (False, 1), "u": (True, 0)}
    with pytest.raises(gates.Stop):
        gates.stop_unless(checks)


def test_shards_round_trip(spark, tmp_path):
    ids = spark.range(0, 230, 2).select(F.col("id").alias("doc_id"), F.lit(3).alias("len"))
    texts = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    shards.write_shards(shards.plan_shards(ids, "doc_id", 50), texts, "doc_id", str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 115 and back.where("text <> concat('t', doc_id)").count() == 0
    assert [r["n_rows"] for r in shards.shard_index(back, "doc_id", "len").orderBy("shard_index").collect()] == [50, 50, 15]


def test_manifest_and_resume(spark, tmp_path):
    ran = []

    def make():
        ran.append(1)
        return spark.range(5)

    for _ in range(2):
        assert shards.run_once(spark, "stage", str(tmp_path / "t"), make).count() == 5
    assert len(ran) == 1
    with pytest.raises(gates.Stop):
        shards.read_manifest(spark, str(tmp_path / "t") + ".manifest", "other")
    left = shards.undone(spark.range(4).toDF("k"), spark.createDataFrame([(1,), (1,)], "k long"), ["k"])
    assert {r["k"] for r in left.collect()} == {0, 2, 3}


def test_final_parts(spark, tmp_path):
    rows = spark.range(25).selectExpr("id as orig_doc_id", "'x' as text", "'original' as source_prompt", "1 as tokens_llama2", "5 as extra")
    shards.write_final(rows.coalesce(1), str(tmp_path / "f"), 10)
    assert spark.read.parquet(str(tmp_path / "f")).columns == [f.name for f in shards.FINAL]
    assert shards.rows_per_file(spark, str(tmp_path / "f")).agg(F.max("n_rows")).first()[0] == 10


def test_pool_columns(spark, sf):
    assert shards.read_pool(spark, f"{sf}/pool.parquet", ["doc_id"]).columns == ["doc_id"]
    with pytest.raises(gates.Stop):
        shards.read_pool(spark, f"{sf}/orders.parquet")


def test_budgets():
    b = Budgets.of_pool(1200)
    assert (b.target, b.source, b.oversample) == (100, 200, 400) and b.horizon_plan(50)[0] == (200, 4.0)
    for bad in (dict(target=1, source=3, oversample=6), dict(target=1, source=2, oversample=5), dict(target=1, source=2, oversample=4, arms=("a",))):
        with pytest.raises(gates.Stop):
            Budgets(**bad)


def test_leases(spark):
    rows = [(1, "2024-01-01 00:00:00", 7, "a"), (2, "2024-01-01 00:20:00", 7, "b"), (3, "2024-01-01 02:00:00", 7, "c"), (4, "2024-01-01 01:00:00", 8, "d")]
    df = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    assert {(r["user_id"], r["last_type"], r["stale"]) for r in leases.status(df).collect()} == {(7, "c", False), (8, "d", True)}
    assert sorted((r["user_id"], r["beats"]) for r in leases.sessions(df).collect()) == [(7, 1), (7, 2), (8, 1)]


def test_rewrite_stage_takes_each_shard_once(spark, tmp_path):
    source, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    schema = "doc_id long, text string"
    for k in range(2):
        spark.createDataFrame([(k, "a b")], schema).write.mode("append").parquet(source)
        leases.rewrite_new(spark, source, schema, lambda df: df.withColumn("text", F.upper("text")), out, mark)
    assert sorted(tuple(r) for r in spark.read.parquet(out).select("doc_id", "text").collect()) == [(0, "A B"), (1, "A B")]
