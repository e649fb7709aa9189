"""The stages end to end, with a kill between them, and the models as parameters."""

import json

import pytest
from pyspark.sql import functions as F

from budgetloom import stages
from budgetloom.functions import models
from budgetloom.operators.gates import Stop
from budgetloom.sources import shards


def test_stages_end_to_end_and_after_a_kill(spark, sf, tmp_path, capsys):
    config = tmp_path / "c.json"
    config.write_text(json.dumps({"shard_rows": 20, "part_rows": 15, "blocks": ["topic_quota"], "arms": ["quality_prefix"]}))
    out = str(tmp_path / "out")
    arguments = lambda stage: [stage, "--tables", sf, "--out", out, "--config", str(config)]
    assert stages.main(arguments("materialise"), spark) == 1 and "select is not done" in capsys.readouterr().out
    assert stages.main(arguments("select"), spark) == 0
    run = stages.Run(spark, sf, out, stages.read_config(str(config)))
    first = run.materialise()["topic_quota"]
    source = shards.read_shards(spark, f"{out}/sources/topic_quota")
    rows = source.count()
    assert first > 1 and source.where("text is null").count() < rows
    # a kill: one shard half written, one gone; only these are made again
    import shutil

    folders = sorted(p for p in (tmp_path / "out/sources/topic_quota").iterdir() if p.is_dir())
    shutil.rmtree(folders[0])
    half = spark.read.parquet(str(folders[1])).limit(3).toPandas()
    spark.createDataFrame(half).coalesce(1).write.mode("overwrite").parquet(str(folders[1]))
    assert run.materialise()["topic_quota"] == 2
    spark.catalog.clearCache()
    assert shards.read_shards(spark, f"{out}/sources/topic_quota").count() == rows
    assert run.materialise()["topic_quota"] == 0
    assert shards.read_index(spark, f"{out}/sources/topic_quota.index").agg(F.sum("n_rows")).first()[0] == rows
    assert stages.main(arguments("assemble"), spark) == 0 and stages.main(arguments("final"), spark) == 0
    final = spark.read.parquet(f"{out}/final")
    sizes = [r["count"] for r in final.groupBy("part").count().orderBy("part").collect()]
    assert set(sizes[:-1]) == {15} and 0 < sizes[-1] <= 15
    assert stages.main(arguments("report"), spark) == 0 and "| base |" in capsys.readouterr().out
    assert shards.read_manifest(spark, f"{out}/report.manifest", "report")["final"]
    shards.remove(spark, f"{out}/final")
    with pytest.raises(Stop):
        run.report()


def test_config_stops_at_unknown_names(tmp_path):
    (tmp_path / "c.toml").write_text("part_rows = 7\n")
    assert stages.read_config(str(tmp_path / "c.toml"))["part_rows"] == 7 and stages.read_config(None) == stages.DEFAULTS
    (tmp_path / "c.toml").write_text("parts = 7\n")
    with pytest.raises(Stop, match="parts"):
        stages.read_config(str(tmp_path / "c.toml"))


def test_models_are_parameters(spark):
    df = spark.createDataFrame([("a b  c",), ("",), (None,), (" x ",)], "t string")
    got = [r[0] for r in df.select(models.token_counter(models.pieces)(F.col("t"))).collect()]
    assert got == [3, 0, 0, 1]

    def signs():
        return lambda texts: [("hq" if "a" in t else "lq", 0.75) for t in texts]

    c = models.classifier(signs)(F.col("t")).alias("c")
    rows = df.select("t", c).select(models.raw_score(F.col("t"), F.col("c.label"), F.col("c.p"))).collect()
    assert [r[0] for r in rows] == [0.75, 0.0, 0.0, 0.25]
