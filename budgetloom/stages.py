"""The pipeline's stages, each written with a manifest and skipped when it is done already.

``python -m budgetloom STAGE --tables DIR --out DIR [--config FILE]`` runs one;
``all`` runs them in order.  A stage that is killed leaves no manifest and is
made again; its shards that are whole are kept.
"""

from __future__ import annotations

import argparse
import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from budgetloom.config import Budgets
from budgetloom.functions.scores import stream
from budgetloom.operators import gates
from budgetloom.operators.fill import hash_lead, running_sum
from budgetloom.plans import catalog
from budgetloom.plans.tables import texts
from budgetloom.sources import shards

STAGES = ("select", "materialise", "assemble", "final", "report")
DEFAULTS = {"shard_rows": 500, "part_rows": 1000, "blocks": ["styled_random", "topic_quota", "disagreement"], "arms": ["quality_prefix", "styled_random", "disagreement"]}


def read_config(path: str | None) -> dict:
    """Defaults, and over them a JSON or TOML file's values, or a YAML file's where a reader is installed; unknown names stop the run."""
    given: dict = {}
    if path:
        raw = Path(path).read_text()
        if path.endswith(".toml"):
            import tomllib

            given = tomllib.loads(raw)
        elif path.endswith((".yaml", ".yml")):
            import yaml

            given = yaml.safe_load(raw) or {}
        else:
            given = json.loads(raw)
    unknown = sorted(set(given) - set(DEFAULTS))
    if unknown:
        raise gates.Stop(f"the configuration has unknown names: {', '.join(unknown)}")
    return DEFAULTS | given


class Run:
    """A run over input tables, with its folder of outputs."""

    def __init__(self, spark: SparkSession, tables: str, out: str, config: dict | None = None):
        self.spark, self.tables, self.out, self.config = spark, tables, out.rstrip("/"), DEFAULTS | (config or {})

    def path(self, *parts: str) -> str:
        return "/".join((self.out, *parts))

    def select(self) -> DataFrame:
        """Block memberships; the run stops where a block is empty, overlaps the base or falls short."""
        s = catalog.Selection(self.spark, self.tables)
        Budgets(s.b, 2 * s.b, 4 * s.b)

        def make() -> DataFrame:
            blocks = s.blocks()
            base = blocks.where("block = 'base'")
            others = blocks.where(F.col("block").isin("styled_random", "oversample_refilter", "topic_quota", "disagreement"))
            gates.stop_unless(gates.all_of([gates.overlap(base, others, "doc_id", "base and strategies"), gates.overlap(s.holdout.held(s.pool), blocks, "doc_id", "hold-out and blocks"), gates.unique(base, "doc_id", "base is unique")]))
            return blocks

        return shards.run_once(self.spark, "select", self.path("select"), make)

    def materialise(self) -> dict[str, int]:
        """The sources of the blocks in shards with their texts; shards that are whole stay as they are."""
        blocks = shards.require(self.spark, "select", self.path("select"))
        done = {}
        for name in self.config["blocks"]:
            ids = blocks.where(F.col("block") == name).select("doc_id", "len")
            planned = shards.plan_shards(ids, "doc_id", self.config["shard_rows"])
            done[name] = shards.write_missing_shards(self.spark, planned, texts(self.spark, self.tables), "doc_id", self.path("sources", name))
            index = shards.shard_index(shards.read_shards(self.spark, self.path("sources", name)), "doc_id", "len")
            shards.write_index(self.spark, index, self.path("sources", f"{name}.index"))
        shards.write_manifest(self.spark, self.path("sources.manifest"), "materialise", {"written": done})
        return done

    def assemble(self) -> None:
        """The kept rewrites of each arm; an output without rows removes what an earlier run left."""
        ranks = {"quality_prefix": catalog._desc("s1"), "styled_random": catalog._random("topup", "rewrite_id"), "disagreement": catalog._desc("u")}
        for arm in self.config["arms"]:
            if arm not in ranks:
                raise gates.Stop(f"no arm {arm!r}")
            out = self.path("assembled", arm)
            table = shards.run_once(self.spark, "assemble", out, lambda arm=arm: catalog._kept(self.spark, self.tables, arm, ranks[arm]).select("rewrite_id", "doc_id", "pass_name", "len", "tier"))
            if table.isEmpty():
                shards.remove(self.spark, out)

    def final(self) -> DataFrame:
        """Base and strategy rows, shuffled by document and written in parts of equal rows."""

        def make() -> DataFrame:
            rows = catalog._base_rows(self.spark, self.tables).unionByName(catalog._strategy_rows(self.spark, self.tables).drop("rewrite_id"))
            return rows.withColumn("h", stream("shuffle", "orig_doc_id", "source_prompt"))

        shards.require(self.spark, "assemble", self.path("assembled", self.config["arms"][0]))
        out = self.path("final")
        if not shards.exists(self.spark, f"{out}.manifest"):
            rows = make()
            placed = running_sum(rows, [F.col("h").asc(), F.col("orig_doc_id").asc(), F.col("source_prompt").asc(), F.col("text").asc()], F.lit(1), hash_lead(F.col("h")))
            shards.write_parts(placed, "rn", out, self.config["part_rows"])
            n = self.spark.read.parquet(out).count()
            shards.write_manifest(self.spark, f"{out}.manifest", "final", {"rows": n})
        return self.spark.read.parquet(out)

    def report(self) -> str:
        """A summary of what was written, as Markdown; the same facts as JSON in the manifest."""
        blocks = shards.require(self.spark, "select", self.path("select")).groupBy("block").agg(F.count("*").alias("docs"), F.sum("len").alias("tokens")).orderBy("block").collect()  # seven rows
        final = shards.require(self.spark, "final", self.path("final"))
        mix = final.groupBy("source_prompt").agg(F.count("*").alias("docs"), F.sum(F.coalesce("tokens_llama2", F.lit(0)) + 1).alias("tokens")).orderBy("source_prompt").collect()  # one row a prompt
        lines = ["| block | documents | tokens |", "|-|-|-|", *(f"| {r['block']} | {r['docs']} | {r['tokens']} |" for r in blocks), "", "| source prompt | documents | tokens |", "|-|-|-|", *(f"| {r['source_prompt']} | {r['docs']} | {r['tokens']} |" for r in mix)]
        facts = {"blocks": {r["block"]: [r["docs"], r["tokens"]] for r in blocks}, "final": {r["source_prompt"]: [r["docs"], r["tokens"]] for r in mix}}
        shards.write_manifest(self.spark, self.path("report.manifest"), "report", facts)
        return "\n".join(lines)


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """Run a stage; 0 when it is done, 1 when a gate stopped it."""
    parser = argparse.ArgumentParser(prog="budgetloom")
    parser.add_argument("stage", choices=[*STAGES, "all"])
    parser.add_argument("--tables", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--config")
    given = parser.parse_args(arguments)
    try:
        run = Run(spark or SparkSession.builder.appName("budgetloom").getOrCreate(), given.tables, given.out, read_config(given.config))
        for stage in STAGES if given.stage == "all" else [given.stage]:
            result = getattr(run, stage)()
            print(result if isinstance(result, str) else f"{stage}: done")
    except gates.Stop as stop:
        print(f"stopped: {stop}")
        return 1
    return 0


__all__ = ["Run", "main", "read_config"]
