"""Sources and sinks of the pipeline: shards, manifests, resumable stages.

Spark's commit protocol makes a written folder whole or absent; a stage that
already has its manifest is not run again.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from budgetloom.operators.fill import Lead, running_sum
from budgetloom.operators.gates import Stop

FINAL = T.StructType([T.StructField("orig_doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source_prompt", T.StringType()), T.StructField("tokens_llama2", T.IntegerType())])
POOL_NEEDS = ["doc_id", "text", "topic", "tok", "fasttext_ranking_v2", "fineweb_edu_ranking_v2", "modernbert_ranking_v2", "tokens_llama2"]


def read_pool(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The pool, checked by column names; stops with the names that are missing."""
    df = spark.read.parquet(path)
    missing = sorted(set(POOL_NEEDS) - set(df.columns))
    if missing:
        raise Stop(f"the pool has no column {', '.join(missing)}")
    return df.select(*columns) if columns else df


def rows_per_file(spark: SparkSession, path: str) -> DataFrame:
    """(file, n_rows) of a table; only file metadata and row counts are read."""
    return spark.read.parquet(path).select(F.col("_metadata.file_name").alias("file")).groupBy("file").agg(F.count("*").alias("n_rows"))


def plan_shards(ids: DataFrame, key: str, rows: int) -> DataFrame:
    """``ids`` with ``shard_index`` and ``row_in_shard``: ids in order, cut every ``rows`` rows."""
    placed = running_sum(ids, [F.col(key).asc()], F.lit(1), Lead(F.col(key), False))
    return placed.withColumn("shard_index", F.expr(f"(rn - 1) div {rows}")).withColumn("row_in_shard", F.pmod(F.col("rn") - 1, F.lit(rows))).drop("rn", "before_len")


def write_shards(planned: DataFrame, texts: DataFrame, key: str, out: str) -> None:
    """Write each shard to its own folder, sorted by key; the wide text is joined last.

    Sorted keys give each file narrow min and max statistics, by which later
    scans by key skip files.
    """
    rows = planned.join(texts, key)
    rows.repartitionByRange("shard_index", key).sortWithinPartitions("shard_index", key).write.mode("overwrite").option("compression", "zstd").partitionBy("shard_index").parquet(out)


def shard_index(shards: DataFrame, key: str, length: str) -> DataFrame:
    """Rows, least and greatest key and exact length of each shard."""
    return shards.groupBy("shard_index").agg(F.count("*").alias("n_rows"), F.min(key).alias("id_min"), F.max(key).alias("id_max"), F.sum(length).cast("long").alias("tokens"))


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """All shards of a source that are written."""
    return spark.read.parquet(path)


def write_missing_shards(spark: SparkSession, planned: DataFrame, texts: DataFrame, key: str, out: str) -> int:
    """Write the planned shards that are not there in full; the number of shards written.

    A shard counts as there if its rows and its least and greatest key are those
    planned.  Texts are cut down to the wanted keys before anything else is done
    with them, and a shard's folder is replaced as a whole.
    """
    plan = planned.groupBy("shard_index").agg(F.count("*").alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi"))
    if exists(spark, out):
        there = read_shards(spark, out).groupBy(F.col("shard_index").cast("long").alias("shard_index")).agg(F.count("*").alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi"))
        plan = plan.join(there, ["shard_index", "n", "lo", "hi"], "left_anti")
    missing = plan.count()
    if missing:
        rows = planned.join(plan.select("shard_index"), "shard_index", "left_semi").join(texts, key)
        writer = rows.repartition("shard_index").sortWithinPartitions("shard_index", key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.option("compression", "zstd").partitionBy("shard_index").parquet(out)
    return missing


def write_index(spark: SparkSession, index: DataFrame, path: str) -> None:
    """The shard index as JSON lines, one a shard."""
    index.coalesce(1).write.mode("overwrite").json(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(shard_index, n_rows, id_min, id_max, tokens) of a source; stops where shards are missing from the count or ids run over."""
    index = spark.read.schema("shard_index long, n_rows long, id_min long, id_max long, tokens long").json(path)
    bad = index.agg((F.max("shard_index") + 1 - F.count("*")).alias("gap"), F.count_if(F.col("n_rows").isNull() | (F.col("id_min") > F.col("id_max"))).alias("wrong")).first()
    if bad["gap"] is None or bad["gap"] or bad["wrong"]:
        raise Stop(f"{path} is no whole shard index")
    return index


def write_parts(placed: DataFrame, place: str, out: str, part_rows: int) -> None:
    """The corpus in its fixed schema, in parts of exactly ``part_rows`` rows but for the last, by place from 1."""
    part = F.expr(f"({place} - 1) div {part_rows}").cast("int").alias("part")
    fixed = placed.select(*(F.col(f.name).cast(f.dataType) for f in FINAL), part, F.col(place).alias("__place"))
    fixed.repartition("part").sortWithinPartitions("part", "__place").drop("__place").write.mode("overwrite").option("compression", "zstd").partitionBy("part").parquet(out)


def require(spark: SparkSession, stage: str, out: str) -> DataFrame:
    """The table of a stage that is done; stops where it is not."""
    if not exists(spark, f"{out}.manifest"):
        raise Stop(f"{stage} is not done: {out}")
    read_manifest(spark, f"{out}.manifest", stage)
    return spark.read.parquet(out)


def remove(spark: SparkSession, out: str) -> None:
    """Remove a stage's table and its manifest."""
    for path in (f"{out}.manifest", out):
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def write_final(rows: DataFrame, out: str, part_rows: int = 200_000) -> None:
    """The corpus in its fixed schema, in parts of at most ``part_rows`` rows."""
    fixed = rows.select(*(F.col(f.name).cast(f.dataType) for f in FINAL))
    fixed.write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", part_rows).parquet(out)


def write_manifest(spark: SparkSession, path: str, stage: str, facts: dict) -> None:
    """A stage's facts as one JSON line, written after its data."""
    spark.createDataFrame([(stage, json.dumps(facts, sort_keys=True))], "stage string, facts string").coalesce(1).write.mode("overwrite").json(path)


def read_manifest(spark: SparkSession, path: str, stage: str) -> dict:
    """The facts of ``stage``; stops if the manifest belongs to another."""
    row = spark.read.schema("stage string, facts string").json(path).first()
    if row is None or row["stage"] != stage:
        raise Stop(f"{path} is no manifest of {stage}")
    return json.loads(row["facts"])


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on its file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def run_once(spark: SparkSession, stage: str, out: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The stage's table: read if its manifest exists, else made, written and described."""
    manifest = f"{out}.manifest"
    if not exists(spark, manifest):
        make().write.mode("overwrite").option("compression", "zstd").parquet(out)
        n = spark.read.parquet(out).count()
        write_manifest(spark, manifest, stage, {"rows": n})
    read_manifest(spark, manifest, stage)
    return spark.read.parquet(out)


def undone(planned: DataFrame, written: DataFrame, keys: list[str]) -> DataFrame:
    """Planned units that are not written yet: the work of a resumed run."""
    return planned.join(written.select(*keys).distinct(), keys, "left_anti")
