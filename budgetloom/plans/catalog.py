"""The queries of the pipeline's own operators, each beside its SQL.

``@query`` registers a function of (spark, sf_dir) under its name, with the SQL
of the same result.  Text-valued results are compared by their length and md5.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from budgetloom.functions import models, scores
from budgetloom.functions import text as rules
from budgetloom.functions.scores import stream
from budgetloom.operators import assemble as asm
from budgetloom.operators import gates
from budgetloom.operators.fill import Lead, budget_fill, hash_lead, running_sum, strict_fill
from budgetloom.operators.ranking import exact_percentiles, order_desc, percentile_vs_reference, tie_percentile
from budgetloom.plans import oracle as o
from budgetloom.plans.tables import passes, scored, second_scores, texts, topic_of
from budgetloom.session import map_arrow, stash, table
from budgetloom.streaming import leases

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}
SHARD_ROWS, PART_ROWS = 500, 1000


def query(sql: str | None = None, needs: str = ""):
    def register(f):
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = o.sql(sql, needs)
        return f

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# ---------------------------------------------------------------- shared parts


def tied(df: DataFrame) -> DataFrame:
    return df.withColumn("tie", stream("tie", "doc_id"))


def budget(df: DataFrame) -> int:
    """A twelfth of the scored length."""
    return int(df.agg((F.sum("len") / 12).cast("long")).first()[0] or 0)


class Holdout:
    """Exactly max(1, n / 2000) documents, the first in their random order.

    The order's boundary is found once; what is held out and what is alive are
    then filters of any table with ``doc_id``, without a join.
    """

    def __init__(self, df: DataFrame, rows: int | None = None):
        self.h = stream("val", "doc_id")
        k = max(1, (df.count() if rows is None else rows) // 2000)
        rows = df.select("doc_id", self.h.alias("h"))
        first = budget_fill(rows.withColumn("one", F.lit(1)), [F.col("h").asc(), F.col("doc_id").asc()], "one", k, method="two_phase", lead=hash_lead(F.col("h")))
        last = first.agg(F.max(F.struct("h", "doc_id")).alias("m")).first()["m"]
        self.last = (last["h"], last["doc_id"]) if last is not None else ("", -1)

    def _held(self):
        h, key = self.last
        return (self.h < h) | ((self.h == h) & (F.col("doc_id") <= key))

    def held(self, df: DataFrame) -> DataFrame:
        return df.where(self._held())

    def alive(self, df: DataFrame) -> DataFrame:
        return tied(df.where(~self._held()))


def holdout(df: DataFrame) -> DataFrame:
    return Holdout(df).held(df).select("doc_id")


def alive(df: DataFrame) -> DataFrame:
    return Holdout(df).alive(df)


class Selection:
    """The pool, its budget and the shared base; blocks are made when asked for."""

    def __init__(self, spark: SparkSession, d: str):
        self.pool = stash(scored(spark, d), "scored")  # narrow, and read by every block
        size = self.pool.agg(F.count("*").alias("n"), (F.sum("len") / 12).cast("long").alias("b")).first()
        self.b = int(size["b"] or 0)
        self.holdout = Holdout(self.pool, size["n"])
        self.alive = self.holdout.alive(self.pool)

    def by_score(self, target: int) -> DataFrame:
        return budget_fill(self.alive, order_desc("s1", F.col("tie"), "doc_id"), "len", target, method="two_phase", lead=self.lead("s1"))

    @staticmethod
    def lead(score: str) -> Lead:
        return Lead(F.col(score), True, F.col("tie"))

    def base(self) -> DataFrame:
        """The shared base; a pool that cannot fill it stops the run."""
        if not hasattr(self, "_base"):
            self._base = stash(strict_fill(self.alive, order_desc("s1", F.col("tie"), "doc_id"), "len", self.b, "base", self.lead("s1")), "base")
        return self._base

    def continued(self, budget_after: int) -> DataFrame:
        """The rows after the base in the same order, to a further budget: one running sum serves base and blocks."""
        filled = stash(self.by_score(2 * self.b + budget_after), "prefix")
        size = filled.where((F.col("rn") == 1) | (F.col("before_len") < self.b)).agg(F.count("*").alias("n"), F.sum("len").alias("t")).first()
        n, t = size["n"], size["t"] or 0
        return filled.where((F.col("rn") > n) & ((F.col("rn") == n + 1) | (F.col("before_len") - t < budget_after)))

    def residual(self) -> DataFrame:
        """What is alive and not in the base: the base is a prefix of an order, so this is a filter behind its last row and no join."""
        if not hasattr(self, "_residual"):
            last = self.base().agg(F.max_by(F.struct("s1", "tie", "doc_id"), "rn").alias("m")).first()["m"]
            score, tie, key = F.lit(last["s1"]).cast("float"), F.lit(last["tie"]), F.lit(last["doc_id"])
            behind = (F.col("s1") < score) | ((F.col("s1") == score) & ((F.col("tie") > tie) | ((F.col("tie") == tie) & (F.col("doc_id") > key))))
            self._residual = self.alive.where(behind)
        return self._residual

    def uniform(self, name: str, times: int) -> DataFrame:
        return budget_fill(self.residual().withColumn("draw", stream(name, "doc_id")), [F.col("draw").asc(), F.col("doc_id").asc()], "len", times * self.b, method="two_phase", lead=hash_lead(F.col("draw")))

    def quotas(self) -> DataFrame:
        total = self.residual().agg(F.sum("len").cast("double").alias("t")).first()["t"] or 1.0
        by = self.residual().groupBy("topic").agg(F.count("*").alias("docs"), F.sum("len").cast("long").alias("tokens"))
        return by.withColumn("quota", F.lit(float(2 * self.b)) * F.col("tokens").cast("double") / F.lit(total))

    def by_topic(self) -> DataFrame:
        with_quota = self.residual().join(F.broadcast(self.quotas().select("topic", "quota")), "topic")  # one row for each topic
        return budget_fill(with_quota, order_desc("q", F.col("tie"), "doc_id"), "len", F.col("quota"), ["topic"], "two_phase", self.lead("q"))

    def by_listed_topic(self, targets: DataFrame) -> DataFrame:
        """The fill by topic under listed shares of twice the budget, and a top-up by q to the whole target."""
        goal = 2 * self.b
        shares = targets.where("topic is not null").groupBy(topic_of().alias("topic")).agg((F.max("target_share") * goal).alias("quota"))
        filled = stash(budget_fill(self.residual().join(F.broadcast(shares), "topic"), order_desc("q", F.col("tie"), "doc_id"), "len", F.col("quota"), ["topic"], "two_phase", self.lead("q")), "listed")
        missing = goal - int(filled.agg(F.coalesce(F.sum("len"), F.lit(0))).first()[0])
        taken = filled.select("doc_id", "topic", F.lit(False).alias("topped_up"))
        if missing <= 0:
            return taken
        rest = self.residual().join(filled.select("doc_id"), "doc_id", "left_anti")
        more = budget_fill(rest, order_desc("q", F.col("tie"), "doc_id"), "len", missing, method="two_phase", lead=self.lead("q"))
        return taken.unionByName(more.select("doc_id", "topic", F.lit(True).alias("topped_up")))

    def candidates(self) -> DataFrame:
        """Union of three fills, each with its membership as a flag."""
        flags = [budget_fill(self.residual(), order_desc(s, F.col("tie"), "doc_id"), "len", 2 * self.b, method="two_phase", lead=self.lead(s)).select("doc_id", F.lit(i).alias("i")) for i, s in enumerate(("s1", "s2", "s3"), 1)]
        of = reduce(DataFrame.unionByName, flags).groupBy("doc_id").agg(*(F.max(F.col("i") == i).alias(f"in{i}") for i in (1, 2, 3)))
        return self.residual().join(of, "doc_id").select("doc_id", "len", "q", "v", "u", "tie", "in1", "in2", "in3")

    def taus(self, candidates: DataFrame) -> tuple[float, float]:
        r = exact_percentiles(candidates, {"q": ("q", 0.3), "v": ("v", 0.9)})
        return r["q"] or 0.0, r["v"] or 0.0

    def feasible(self) -> tuple[DataFrame, DataFrame]:
        c = stash(self.candidates(), "candidates")
        tau_q, tau_v = self.taus(c)
        return c, c.where((F.col("q") >= F.lit(tau_q).cast("float")) & (F.col("v") <= F.lit(tau_v).cast("float")))

    def spread(self) -> DataFrame:
        return budget_fill(self.feasible()[1], order_desc("u", F.col("tie"), "doc_id"), "len", 2 * self.b, method="two_phase", lead=self.lead("u"))

    def blocks(self) -> DataFrame:
        parts = {
            "base": self.base(), "quality_base": self.continued(self.b), "quality_prefix": self.continued(2 * self.b), "styled_random": self.uniform("draw_a", 2), "oversample_refilter": self.uniform("draw_b", 4),
            "topic_quota": self.by_topic(), "disagreement": self.spread(),
        }
        return stash(reduce(DataFrame.unionByName, [p.select(F.lit(n).alias("block"), "doc_id", "len") for n, p in parts.items()]), "blocks")


def r6(c, name: str):
    return F.round(F.col(c).cast("double") if isinstance(c, str) else c.cast("double"), 6).alias(name)


def long(c, name: str):
    return (F.col(c) if isinstance(c, str) else c).cast("long").alias(name)


def when_sum(cond, amount="len"):
    return F.coalesce(F.sum(F.when(cond, F.col(amount) if isinstance(amount, str) else amount)), F.lit(0)).cast("long")


def when_count(cond):
    return F.count(F.when(cond, 1)).cast("long")


# ---------------------------------------------------------------- scans and sinks


@query("SELECT doc_id, len, round(CAST(s1 AS DOUBLE), 6) AS s1, round(CAST(s2 AS DOUBLE), 6) AS s2, round(CAST(s3 AS DOUBLE), 6) AS s3, topic FROM scored", "scored")
def scan_pool(spark, d):
    return scored(spark, d).select("doc_id", "len", r6("s1", "s1"), r6("s2", "s2"), r6("s3", "s3"), "topic")


@query("SELECT 'pool' AS table_name, count(*) AS n_rows FROM pool UNION ALL SELECT 'rewritten', count(*) FROM rewritten UNION ALL SELECT 'final', count(*) FROM final")
def count_per_file(spark, d):
    """Row counts from the footers alone (no column is read)."""
    return reduce(DataFrame.unionByName, [table(spark, d, n).agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows") for n in ("pool", "rewritten", "final")])


@query(f"SELECT DISTINCT doc_id, doc_id // {SHARD_ROWS} AS shard, doc_id % {SHARD_ROWS} AS row_in_shard FROM pool")
def shard_address(spark, d):
    return table(spark, d, "pool").select("doc_id", F.expr(f"doc_id div {SHARD_ROWS}").alias("shard"), F.pmod("doc_id", F.lit(SHARD_ROWS)).cast("long").alias("row_in_shard")).distinct()


def _planned(rows: DataFrame) -> DataFrame:
    """Ids in order, cut into shards of a fixed number of rows."""
    placed = running_sum(rows, [F.col("doc_id").asc()], F.lit(1), Lead(F.col("doc_id"), False))
    return placed.select("doc_id", "len", F.expr(f"(rn - 1) div {SHARD_ROWS}").alias("shard_index"), F.pmod(F.col("rn") - 1, F.lit(SHARD_ROWS)).cast("long").alias("row_in_shard"))


_PLAN = f"(SELECT doc_id, len, (row_number() OVER (ORDER BY doc_id) - 1) // {SHARD_ROWS} AS shard_index, (row_number() OVER (ORDER BY doc_id) - 1) % {SHARD_ROWS} AS row_in_shard FROM uniform)"


@query(f"SELECT doc_id, shard_index, row_in_shard FROM {_PLAN}", "uniform")
def plan_shards(spark, d):
    return _planned(Selection(spark, d).uniform("draw_a", 2).select("doc_id", "len")).select("doc_id", "shard_index", "row_in_shard")


@query(f"SELECT shard_index, 'shard_' || lpad(CAST(shard_index AS VARCHAR), 5, '0') AS file, count(*) AS n_rows, min(doc_id) AS doc_id_min, max(doc_id) AS doc_id_max, CAST(sum(len) AS BIGINT) AS source_train_tokens FROM {_PLAN} GROUP BY shard_index", "uniform")
def shard_index(spark, d):
    plan = _planned(Selection(spark, d).uniform("draw_a", 2).select("doc_id", "len"))
    return plan.groupBy("shard_index").agg(F.count("*").alias("n_rows"), F.min("doc_id").alias("doc_id_min"), F.max("doc_id").alias("doc_id_max"), long(F.sum("len"), "source_train_tokens")).withColumn("file", F.format_string("shard_%05d", "shard_index"))


@query(f"SELECT shard_index, n_rows, CAST(coalesce(sum(n_rows) OVER (ORDER BY shard_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS row_offset FROM (SELECT shard_index, count(*) AS n_rows FROM {_PLAN} GROUP BY shard_index)", "uniform")
def shard_offsets(spark, d):
    per = shard_index(spark, d).select("shard_index", "n_rows")
    return running_sum(per, [F.col("shard_index").asc()], "n_rows", Lead(F.col("shard_index"), False)).select("shard_index", "n_rows", F.col("before_len").alias("row_offset"))


@query(f"SELECT p.doc_id, shard_index, row_in_shard, CAST(length(text) AS BIGINT) AS n_chars, md5(text) AS text_md5, tokens FROM {_PLAN} p JOIN pool_texts t ON p.doc_id = t.doc_id", "uniform pool_texts")
def materialize_source(spark, d):
    """Late materialisation: ids are ranked on narrow rows and the text joined last."""
    plan = _planned(Selection(spark, d).uniform("draw_a", 2).select("doc_id", "len"))
    return plan.join(texts(spark, d), "doc_id").select("doc_id", "shard_index", "row_in_shard", long(F.length("text"), "n_chars"), F.md5("text").alias("text_md5"), "tokens")


@query("SELECT block, doc_id FROM blocks", "blocks")
def block_ids(spark, d):
    return Selection(spark, d).blocks().select("block", "doc_id")


@query("SELECT block, count(*) AS docs, CAST(sum(len) AS BIGINT) AS tokens, min(doc_id) AS id_min, max(doc_id) AS id_max, bit_xor(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15))::BIGINT) AS id_digest FROM blocks GROUP BY block", "blocks")
def block_digest(spark, d):
    """Digest of id sets that does not depend on their order: the exclusive or of each id's hash."""
    h = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 15), 16, 10).cast("long")
    return Selection(spark, d).blocks().groupBy("block").agg(F.count("*").alias("docs"), long(F.sum("len"), "tokens"), F.min("doc_id").alias("id_min"), F.max("doc_id").alias("id_max"), F.bit_xor(h).alias("id_digest"))


@query("""SELECT block, '{"block":"' || block || '","docs":' || count(*) || ',"tokens":' || CAST(sum(len) AS BIGINT) || '}' AS manifest FROM blocks GROUP BY block""", "blocks")
def manifest_json(spark, d):
    one = Selection(spark, d).blocks().groupBy("block").agg(F.count("*").alias("docs"), long(F.sum("len"), "tokens"))
    return one.select("block", F.to_json(F.struct("block", "docs", "tokens")).alias("manifest"))


@query("SELECT block, count(*) AS docs, CAST(sum(len) AS BIGINT) AS tokens, CASE block WHEN 'base' THEN b WHEN 'quality_base' THEN b WHEN 'oversample_refilter' THEN 4 * b ELSE 2 * b END AS target, CAST(sum(len) AS BIGINT) - CASE block WHEN 'base' THEN b WHEN 'quality_base' THEN b WHEN 'oversample_refilter' THEN 4 * b ELSE 2 * b END AS overshoot FROM blocks, budget GROUP BY block, b", "blocks budget")
def block_summary(spark, d):
    s = Selection(spark, d)
    target = F.lit(s.b) * F.when(F.col("block").isin("base", "quality_base"), 1).when(F.col("block") == "oversample_refilter", 4).otherwise(2)
    one = s.blocks().groupBy("block").agg(F.count("*").alias("docs"), long(F.sum("len"), "tokens"))
    return one.withColumn("target", target.cast("long")).withColumn("overshoot", F.col("tokens") - F.col("target"))


# ---------------------------------------------------------------- projections and predicates


@query("SELECT doc_id, CAST(coalesce(tokens_llama2, 0) + 1 AS BIGINT) AS train_len, count(*) AS n FROM pool GROUP BY ALL")
def train_len(spark, d):
    return table(spark, d, "pool").select("doc_id", scores.train_len("tokens_llama2").alias("train_len")).groupBy("doc_id", "train_len").agg(F.count("*").alias("n"))


@query("SELECT doc_id, round(CAST(q AS DOUBLE), 6) AS q, round(CAST(v AS DOUBLE), 6) AS v FROM scored", "scored")
def consensus_qv(spark, d):
    return scored(spark, d).select("doc_id", r6("q", "q"), r6("v", "v"))


@query("SELECT doc_id, round(CAST(u AS DOUBLE), 5) AS u FROM scored", "scored")
def u_score(spark, d):
    return scored(spark, d).select("doc_id", F.round(F.col("u").cast("double"), 5).alias("u"))


@query("SELECT doc_id FROM holdout", "holdout")
def holdout_sample(spark, d):
    return holdout(scored(spark, d))


@query("SELECT doc_id, len FROM alive", "alive")
def alive_docs(spark, d):
    return alive(scored(spark, d)).select("doc_id", "len")


@query("SELECT doc_id, len FROM residual", "residual")
def residual_docs(spark, d):
    return Selection(spark, d).residual().select("doc_id", "len")


@query("SELECT rewrite_id, doc_id, pass_name, len FROM done", "done")
def completed_rows(spark, d):
    return asm.completed(passes(spark, d)).select("rewrite_id", "doc_id", "pass_name", "len")


@query("SELECT rewrite_id, input_tokens_qwen > 400 AS dropped, CASE WHEN input_tokens_qwen > 400 THEN 0 WHEN finish_reason = 'length' THEN 1 ELSE 2 END AS status, greatest(1, least(4096, 8192 - input_tokens_qwen)) AS max_new_tokens FROM passes WHERE input_tokens_qwen IS NOT NULL", "passes")
def rewrite_status(spark, d):
    """Input drop, status code and output budget of each request."""
    n = F.col("input_tokens_qwen")
    rows = passes(spark, d).where(n.isNotNull())
    return rows.select("rewrite_id", (n > 400).alias("dropped"), F.when(n > 400, 0).when(F.col("finish_reason") == "length", 1).otherwise(2).alias("status"), F.greatest(F.lit(1), F.least(F.lit(4096), 8192 - n)).alias("max_new_tokens"))


@query("SELECT rewrite_id, CASE WHEN setting = 'styled_random' AND pass_name = 'p1' THEN 'wrap_' || wrap_style WHEN pass_name = 'p1' THEN 'wikipedia' ELSE 'distill' END AS source_prompt FROM passes", "passes")
def source_prompt_tag(spark, d):
    return passes(spark, d).select("rewrite_id", _source_prompt().alias("source_prompt"))


def _source_prompt():
    return F.when((F.col("setting") == "styled_random") & (F.col("pass_name") == "p1"), F.concat(F.lit("wrap_"), "wrap_style")).when(F.col("pass_name") == "p1", "wikipedia").otherwise("distill")


@query("SELECT topic, dense_rank() OVER (ORDER BY topic) - 1 AS code, n FROM (SELECT topic, count(*) AS n FROM scored GROUP BY topic)", "scored")
def topic_codes(spark, d):
    """Dictionary codes in the order of the sorted vocabulary; one row for each topic."""
    return scored(spark, d).groupBy("topic").agg(F.count("*").alias("n")).withColumn("code", (F.dense_rank().over(Window.orderBy("topic")) - 1).cast("long"))


@query("SELECT p.setting, p.shard_index, k.pass_name FROM (SELECT DISTINCT setting, shard_index FROM shard_plan) p, (VALUES ('p1'), ('distill')) k(pass_name) WHERE NOT EXISTS (SELECT 1 FROM passes r WHERE r.setting = p.setting AND r.shard_index = p.shard_index AND r.pass_name = k.pass_name)", "passes")
def missing_shards(spark, d):
    planned = table(spark, d, "shard_plan").select("setting", "shard_index").distinct().select("setting", "shard_index", F.explode(F.array(F.lit("p1"), F.lit("distill"))).alias("pass_name"))
    return planned.join(passes(spark, d).select("setting", "shard_index", "pass_name").distinct(), ["setting", "shard_index", "pass_name"], "left_anti")


@query("SELECT setting, count(*) AS n_shards, CAST(sum(n_docs) AS BIGINT) AS n_docs, CAST(sum(source_train_tokens) AS BIGINT) AS tokens FROM shard_plan GROUP BY setting")
def collect_shards(spark, d):
    return table(spark, d, "shard_plan").groupBy("setting").agg(F.count("*").alias("n_shards"), long(F.sum("n_docs"), "n_docs"), long(F.sum("source_train_tokens"), "tokens"))


def _pilot(n_shards, k: int):
    """Evenly spread shards: floor((i + 0.5) n / k), each once; all where there are no more than k."""
    i = F.sequence(F.lit(0), F.lit(k - 1))
    return F.array_distinct(F.transform(i, lambda x: F.least(n_shards - 1, F.floor((x + 0.5) * n_shards / k).cast("long"))))


@query("SELECT DISTINCT setting, least(n - 1, CAST(floor((i + 0.5) * n / 4) AS BIGINT)) AS pilot FROM (SELECT setting, count(*) AS n FROM shard_plan GROUP BY setting), range(4) t(i)")
def pilot_shards(spark, d):
    n = table(spark, d, "shard_plan").groupBy("setting").agg(F.count("*").alias("n"))
    return n.select("setting", F.explode(_pilot(F.col("n"), 4)).alias("pilot"))


@query("SELECT rewrite_id, doc_id, setting, pass_name, k AS row_in_shard FROM (SELECT *, row_number() OVER (PARTITION BY setting, pass_name, shard_index ORDER BY doc_id, rewrite_id) - 1 AS k FROM passes) WHERE k < 8", "passes")
def smoke_rows(spark, d):
    """The first rows of each shard, as a smoke run takes them."""
    w = Window.partitionBy("setting", "pass_name", "shard_index").orderBy("doc_id", "rewrite_id")  # a shard has a fixed number of rows
    return passes(spark, d).withColumn("row_in_shard", (F.row_number().over(w) - 1).cast("long")).where("row_in_shard < 8").select("rewrite_id", "doc_id", "setting", "pass_name", "row_in_shard")


# ---------------------------------------------------------------- fills and selections


_FILLED = ["doc_id", "rn", "len", "before_len"]


@query("SELECT doc_id, rn, len, before_len FROM base", "base")
def base_block(spark, d):
    return Selection(spark, d).base().select(*_FILLED)


@query("SELECT doc_id, rn, len, before_len FROM quality_base", "quality_base")
def quality_base(spark, d):
    s = Selection(spark, d)
    return s.continued(s.b).select(*_FILLED)


@query("SELECT doc_id, rn, len, before_len FROM quality_first", "quality_first")
def quality_first(spark, d):
    s = Selection(spark, d)
    return s.continued(2 * s.b).select(*_FILLED)


@query("SELECT doc_id, rn, len, before_len FROM uniform", "uniform")
def uniform_select(spark, d):
    return Selection(spark, d).uniform("draw_a", 2).select(*_FILLED)


@query("SELECT doc_id, rn, len, before_len FROM oversample", "oversample")
def oversample_select(spark, d):
    return Selection(spark, d).uniform("draw_b", 4).select(*_FILLED)


@query("SELECT topic, docs, tokens, round(quota, 4) AS quota FROM topic_quota", "topic_quota")
def topic_quota(spark, d):
    return Selection(spark, d).quotas().withColumn("quota", F.round("quota", 4))


@query("SELECT doc_id, topic, rn, before_len FROM topic_fill", "topic_fill")
def topic_quota_select(spark, d):
    return Selection(spark, d).by_topic().select("doc_id", "topic", "rn", "before_len")


@query("SELECT doc_id, topic, topped_up FROM listed_fill UNION ALL SELECT doc_id, topic, true FROM listed_topup", "listed_fill listed_topup")
def topic_topup_select(spark, d):
    """Quotas by the listed shares of the topics; what scarce topics leave open is filled by q from what is left."""
    return Selection(spark, d).by_listed_topic(table(spark, d, "topic_targets")).select("doc_id", "topic", "topped_up")


@query("SELECT doc_id, in1, in2, in3 FROM candidates", "candidates")
def da_candidates(spark, d):
    return Selection(spark, d).candidates().select("doc_id", "in1", "in2", "in3")


@query("SELECT round(tau_q, 6) AS tau_q, round(tau_v, 6) AS tau_v FROM taus", "taus")
def da_thresholds(spark, d):
    s = Selection(spark, d)
    tau_q, tau_v = s.taus(stash(s.candidates(), "candidates"))
    return spark.createDataFrame([(round(tau_q, 6), round(tau_v, 6))], "tau_q double, tau_v double")


@query("SELECT doc_id, len FROM feasible", "feasible")
def da_feasible(spark, d):
    return Selection(spark, d).feasible()[1].select("doc_id", "len")


@query("SELECT q >= CAST(tau_q AS FLOAT) AS pass_q, v <= CAST(tau_v AS FLOAT) AS pass_v, count(*) AS docs, CAST(sum(len) AS BIGINT) AS tokens FROM candidates, taus GROUP BY ALL", "candidates taus")
def da_contingency(spark, d):
    s = Selection(spark, d)
    c = stash(s.candidates(), "candidates")
    tau_q, tau_v = s.taus(c)
    return c.groupBy((F.col("q") >= F.lit(tau_q).cast("float")).alias("pass_q"), (F.col("v") <= F.lit(tau_v).cast("float")).alias("pass_v")).agg(F.count("*").alias("docs"), long(F.sum("len"), "tokens"))


@query("SELECT count(*) AS u_docs, CAST(sum(len) AS BIGINT) AS u_tokens, count(CASE WHEN in1 AND in2 AND in3 THEN 1 END) AS in_all, count(CASE WHEN in1 THEN 1 END) AS n1, count(CASE WHEN in2 THEN 1 END) AS n2, count(CASE WHEN in3 THEN 1 END) AS n3, (SELECT count(*) FROM feasible) AS f_docs, (SELECT CAST(sum(len) AS BIGINT) FROM feasible) AS f_tokens, (SELECT sum(len) FROM feasible) >= (SELECT 2 * b FROM budget) AS enough FROM candidates", "candidates feasible budget")
def da_domain_stats(spark, d):
    s = Selection(spark, d)
    c, f = s.feasible()
    of = f.agg(F.count("*").alias("f_docs"), long(F.sum("len"), "f_tokens"))
    one = c.agg(F.count("*").alias("u_docs"), long(F.sum("len"), "u_tokens"), when_count(F.col("in1") & F.col("in2") & F.col("in3")).alias("in_all"), *(when_count(F.col(f"in{i}")).alias(f"n{i}") for i in (1, 2, 3)))
    return one.join(F.broadcast(of)).withColumn("enough", F.col("f_tokens") >= 2 * s.b)  # one row on either side


@query("SELECT doc_id, rn, len, before_len FROM disagree", "disagree")
def disagreement_select(spark, d):
    return Selection(spark, d).spread().select(*_FILLED)


@query("SELECT count(*) AS docs, round(avg(CAST(q AS DOUBLE)), 5) AS mean_q, round(avg(CAST(v AS DOUBLE)), 5) AS mean_v, round(CAST(arg_max(u, rn) AS DOUBLE), 5) AS cutoff FROM disagree", "disagree")
def da_select_stats(spark, d):
    return Selection(spark, d).spread().agg(F.count("*").alias("docs"), F.round(F.avg(F.col("q").cast("double")), 5).alias("mean_q"), F.round(F.avg(F.col("v").cast("double")), 5).alias("mean_v"), F.round(F.max_by("u", "rn").cast("double"), 5).alias("cutoff"))


@query("SELECT l_orderkey, l_linenumber, rn, before_len FROM (SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rn, CAST(coalesce(sum(CAST(l_quantity AS BIGINT)) OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before_len FROM lineitem) WHERE rn = 1 OR before_len < 50000")
def fill_prefix(spark, d):
    """The fill on the largest table, in two phases."""
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", F.col("l_quantity").cast("long").alias("len"))
    return budget_fill(rows, [F.col("l_extendedprice").desc(), F.col("l_orderkey").asc(), F.col("l_linenumber").asc()], "len", 50_000, method="two_phase", lead=Lead(F.col("l_extendedprice"))).select("l_orderkey", "l_linenumber", "rn", "before_len")


@query("SELECT l_suppkey, l_orderkey, l_linenumber, rn, before_len FROM (SELECT l_suppkey, l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rn, CAST(coalesce(sum(CAST(l_quantity AS BIGINT)) OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before_len FROM lineitem) WHERE rn = 1 OR before_len < 300")
def fill_desc(spark, d):
    """The fill by group."""
    rows = table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice", F.col("l_quantity").cast("long").alias("len"))
    return budget_fill(rows, [F.col("l_extendedprice").desc(), F.col("l_orderkey").asc(), F.col("l_linenumber").asc()], "len", 300, ["l_suppkey"], "two_phase", Lead(F.col("l_extendedprice"))).select("l_suppkey", "l_orderkey", "l_linenumber", "rn", "before_len")


@query("SELECT doc_id, rn AS place FROM by_score", "by_score")
def order_desc_places(spark, d):
    s = Selection(spark, d)
    return running_sum(s.alive.select("doc_id", "s1", "tie"), order_desc("s1", F.col("tie"), "doc_id"), F.lit(1), s.lead("s1")).select("doc_id", F.col("rn").alias("place"))


@query("SELECT doc_id, row_number() OVER (ORDER BY md5('42:draw_a:' || doc_id), doc_id) AS place FROM scored", "scored")
def random_order(spark, d):
    rows = scored(spark, d).select("doc_id", stream("draw_a", "doc_id").alias("h"))
    return running_sum(rows, [F.col("h").asc(), F.col("doc_id").asc()], F.lit(1), hash_lead(F.col("h"))).select("doc_id", F.col("rn").alias("place"))


@query("SELECT doc_id, round((rank() OVER (ORDER BY raw) + (count(*) OVER (PARTITION BY raw) - 1) / 2.0) / (SELECT count(*) FROM scored WHERE raw IS NOT NULL), 6) AS pct FROM scored WHERE raw IS NOT NULL", "scored")
def tie_percentile_of_raw(spark, d):
    return tie_percentile(scored(spark, d).where("raw is not null").select("doc_id", "raw"), "raw", "pct").select("doc_id", r6("pct", "pct"))


@query("""SELECT r.doc_id, r.pass_name, round((lo + hi + 1) / 2.0 / (SELECT count(*) FROM scored WHERE raw IS NOT NULL), 6) AS pct FROM rescored r JOIN
    (SELECT v, sum(n) OVER (ORDER BY v) - n AS lo, sum(n) OVER (ORDER BY v) AS hi FROM (SELECT v, sum(n) AS n FROM (SELECT CAST(raw AS DOUBLE) AS v, 1 AS n FROM scored WHERE raw IS NOT NULL UNION ALL SELECT CAST(score AS DOUBLE), 0 FROM rescored WHERE score IS NOT NULL) GROUP BY v)) k ON CAST(r.score AS DOUBLE) = k.v""", "rescored scored")
def percentile_vs_pool(spark, d):
    probes = second_scores(spark, d).where("score is not null").select("doc_id", "pass_name", "score")
    return percentile_vs_reference(probes, "score", scored(spark, d).select("raw"), "raw", "pct").select("doc_id", "pass_name", r6("pct", "pct"))


# ---------------------------------------------------------------- joins, overlaps, gates


@query("SELECT rewrite_id, round(CAST(s1 AS DOUBLE), 6) AS s1, round(CAST(u AS DOUBLE), 5) AS u, topic, source_len FROM keyed", "keyed")
def attach_keys(spark, d):
    return _keyed(spark, d).select("rewrite_id", r6("s1", "s1"), F.round(F.col("u").cast("double"), 5).alias("u"), "topic", "source_len")


def _keyed(spark, d) -> DataFrame:
    return asm.completed(passes(spark, d)).join(scored(spark, d).select("doc_id", "s1", "s2", "s3", "u", "topic", F.col("len").alias("source_len")), "doc_id")


_PAIRED = """(SELECT a.setting, a.doc_id, a.status AS s1, b.status AS s2, s.len FROM (SELECT setting, doc_id, min(status) AS status FROM passes WHERE pass_name = 'p1' GROUP BY ALL) a
    JOIN (SELECT setting, doc_id, min(status) AS status FROM passes WHERE pass_name = 'distill' GROUP BY ALL) b ON a.setting = b.setting AND a.doc_id = b.doc_id JOIN scored s ON s.doc_id = a.doc_id)"""


def _paired(spark, d) -> DataFrame:
    p = passes(spark, d).groupBy("setting", "doc_id").agg(F.min(F.when(F.col("pass_name") == "p1", F.col("status"))).alias("s1"), F.min(F.when(F.col("pass_name") == "distill", F.col("status"))).alias("s2"))
    return p.where("s1 is not null and s2 is not null").join(scored(spark, d).select("doc_id", "len"), "doc_id")


@query(f"SELECT setting, s1, s2, count(*) AS n FROM {_PAIRED} GROUP BY ALL", "passes scored")
def paired_status(spark, d):
    """Both passes of a document side by side, from one shuffle."""
    return _paired(spark, d).groupBy("setting", "s1", "s2").agg(F.count("*").alias("n"))


@query(f"""SELECT setting, count(*) AS paired_docs, count(CASE WHEN s1 = 0 AND s2 = 0 THEN 1 END) AS status0_both, CAST(coalesce(sum(CASE WHEN s1 = 0 AND s2 = 0 THEN len END), 0) AS BIGINT) AS status0_tokens,
    count(CASE WHEN s1 = 1 AND s2 = 1 THEN 1 END) AS status1_both, count(CASE WHEN s1 <> 2 AND s2 = 2 THEN 1 END) AS recovered, count(CASE WHEN s1 = 2 AND s2 <> 2 THEN 1 END) AS only_first,
    count(CASE WHEN s1 = 2 OR s2 = 2 THEN 1 END) AS any_done, CAST(coalesce(sum(CASE WHEN s1 = 2 OR s2 = 2 THEN len END), 0) AS BIGINT) AS covered_tokens, CAST(sum(len) AS BIGINT) AS source_tokens,
    round(100.0 * coalesce(sum(CASE WHEN s1 = 2 OR s2 = 2 THEN len END), 0) / greatest(1, sum(len)), 6) AS covered_pct FROM {_PAIRED} GROUP BY setting""", "passes scored")
def cross_pass_report(spark, d):
    a, b = F.col("s1"), F.col("s2")
    any_done = (a == 2) | (b == 2)
    rows = _paired(spark, d).groupBy("setting").agg(
        F.count("*").alias("paired_docs"), when_count((a == 0) & (b == 0)).alias("status0_both"), when_sum((a == 0) & (b == 0)).alias("status0_tokens"), when_count((a == 1) & (b == 1)).alias("status1_both"),
        when_count((a != 2) & (b == 2)).alias("recovered"), when_count((a == 2) & (b != 2)).alias("only_first"), when_count(any_done).alias("any_done"), when_sum(any_done).alias("covered_tokens"), long(F.sum("len"), "source_tokens"),
    )
    return rows.withColumn("covered_pct", F.round(100.0 * F.col("covered_tokens") / F.greatest(F.lit(1), F.col("source_tokens")), 6))


@query("SELECT a.block AS block_a, b.block AS block_b, count(*) AS shared, round(count(*) / (any_value(na) + any_value(nb) - count(*)), 6) AS jaccard FROM blocks a JOIN blocks b ON a.doc_id = b.doc_id JOIN (SELECT block, count(*) AS na FROM blocks GROUP BY block) x ON x.block = a.block JOIN (SELECT block, count(*) AS nb FROM blocks GROUP BY block) y ON y.block = b.block GROUP BY a.block, b.block", "blocks")
def overlap_matrix(spark, d):
    """Shared documents and Jaccard of each pair of blocks: a document's few blocks are paired in its own row, without a self-join."""
    blocks = Selection(spark, d).blocks()
    sizes = F.broadcast(blocks.groupBy("block").agg(F.count("*").alias("n")))  # one row for each block
    of = blocks.groupBy("doc_id").agg(F.collect_set("block").alias("of"))  # at most seven names
    pairs = of.select(F.explode("of").alias("block_a"), "of").select("block_a", F.explode("of").alias("block_b")).groupBy("block_a", "block_b").agg(F.count("*").alias("shared"))
    return pairs.join(sizes.select(F.col("block").alias("block_a"), F.col("n").alias("na")), "block_a").join(sizes.select(F.col("block").alias("block_b"), F.col("n").alias("nb")), "block_b").select("block_a", "block_b", "shared", F.round(F.col("shared") / (F.col("na") + F.col("nb") - F.col("shared")), 6).alias("jaccard"))


@query("SELECT 'base and strategies' AS check_name, count(*) = 0 AS ok, count(*) AS detail FROM base b WHERE doc_id IN (SELECT doc_id FROM uniform UNION ALL SELECT doc_id FROM topic_fill) UNION ALL SELECT 'hold-out and alive', count(*) = 0, count(*) FROM holdout WHERE doc_id IN (SELECT doc_id FROM alive)", "base uniform topic_fill holdout alive")
def gate_no_overlap(spark, d):
    s = Selection(spark, d)
    strategies = s.uniform("draw_a", 2).select("doc_id").unionByName(s.by_topic().select("doc_id"))
    return gates.all_of([gates.overlap(s.base(), strategies, "doc_id", "base and strategies"), gates.overlap(s.holdout.held(s.pool), s.alive, "doc_id", "hold-out and alive")])


@query("SELECT 'quality_base in quality_prefix' AS check_name, count(*) = 0 AS ok, count(*) AS detail FROM quality_base WHERE doc_id NOT IN (SELECT doc_id FROM quality_first)", "quality_base quality_first")
def gate_containment(spark, d):
    s = Selection(spark, d)
    return gates.contained(s.continued(s.b), s.continued(2 * s.b), "doc_id", "quality_base in quality_prefix")


@query("SELECT 'doc_id is unique' AS check_name, count(*) = 0 AS ok, count(*) AS detail FROM (SELECT doc_id FROM pool GROUP BY doc_id HAVING count(*) > 1) UNION ALL SELECT 'scored doc_id is unique', count(*) = 0, count(*) FROM (SELECT doc_id FROM scored GROUP BY doc_id HAVING count(*) > 1)", "scored")
def gate_unique(spark, d):
    return gates.all_of([gates.unique(table(spark, d, "pool"), "doc_id", "doc_id is unique"), gates.unique(scored(spark, d), "doc_id", "scored doc_id is unique")])


@query("SELECT count(CASE WHEN tok IS NULL THEN 1 END) AS tok, count(CASE WHEN topic IS NULL THEN 1 END) AS topic, count(CASE WHEN fasttext IS NULL THEN 1 END) AS s1, count(CASE WHEN text IS NULL THEN 1 END) AS text, count(*) AS n FROM pool")
def gate_nulls(spark, d):
    one = lambda c, n: F.count_if(F.col(c).isNull()).alias(n)
    return table(spark, d, "pool").agg(one("tok", "tok"), one("topic", "topic"), one("fasttext", "s1"), one("text", "text"), F.count("*").alias("n"))


@query("SELECT count(DISTINCT coalesce(lower(trim(topic)), '(none)')) AS topics, (SELECT count(*) FROM topic_targets) AS expected FROM pool")
def gate_topics(spark, d):
    expected = table(spark, d, "topic_targets").agg(F.count("*").alias("expected"))
    return table(spark, d, "pool").agg(F.countDistinct(topic_of()).alias("topics")).join(F.broadcast(expected))


@query("SELECT count(CASE WHEN NOT (fasttext_ranking_v2 > 0) THEN 1 END) AS low, count(CASE WHEN fasttext_ranking_v2 > 1 + 1e-6 THEN 1 END) AS high, count(CASE WHEN fasttext_ranking_v2 IS NULL THEN 1 END) AS missing FROM pool")
def gate_score_range(spark, d):
    s = F.col("fasttext_ranking_v2")
    return table(spark, d, "pool").agg(when_count(~(s > 0)).alias("low"), when_count(s > 1 + 1e-6).alias("high"), when_count(s.isNull()).alias("missing"))


@query("SELECT setting, count(DISTINCT CASE WHEN pass_name = 'p1' THEN shard_index END) AS p1_shards, count(DISTINCT CASE WHEN pass_name = 'distill' THEN shard_index END) AS distill_shards, any_value(expected) AS expected FROM passes JOIN (SELECT setting AS s, count(*) AS expected FROM shard_plan GROUP BY setting) ON s = setting GROUP BY setting", "passes")
def gate_both_passes(spark, d):
    expected = table(spark, d, "shard_plan").groupBy("setting").agg(F.count("*").alias("expected"))
    shards = passes(spark, d).groupBy("setting").agg(*(F.countDistinct(F.when(F.col("pass_name") == p, F.col("shard_index"))).alias(f"{p}_shards") for p in ("p1", "distill")))
    return shards.join(F.broadcast(expected), "setting")


_STATE = "CASE WHEN coalesce(n, 0) = 0 THEN 'missing' WHEN n < p.n_docs THEN 'partial' WHEN lo < doc_id_min OR hi > doc_id_max THEN 'misaligned' WHEN n > p.n_docs THEN 'surplus' ELSE 'complete' END"


@query(f"SELECT p.setting, p.shard_index, p.pass_name, coalesce(n, 0) AS found_rows, p.n_docs AS planned_rows, {_STATE} AS state FROM (SELECT setting, shard_index, CAST(n_docs AS BIGINT) AS n_docs, doc_id_min, doc_id_max, pass_name FROM shard_plan, (VALUES ('p1'), ('distill')) k(pass_name)) p LEFT JOIN (SELECT setting, shard_index, pass_name, count(*) AS n, min(doc_id) AS lo, max(doc_id) AS hi FROM passes GROUP BY ALL) r ON r.setting = p.setting AND r.shard_index = p.shard_index AND r.pass_name = p.pass_name", "passes")
def pilot_verify(spark, d):
    """Expected shards against what was written: missing, partial, misaligned in their ids, of too many rows, or complete."""
    planned = table(spark, d, "shard_plan").select("setting", "shard_index", long("n_docs", "planned_rows"), "doc_id_min", "doc_id_max", F.explode(F.array(F.lit("p1"), F.lit("distill"))).alias("pass_name"))
    found = passes(spark, d).groupBy("setting", "shard_index", "pass_name").agg(F.count("*").alias("found_rows"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    rows = planned.join(found, ["setting", "shard_index", "pass_name"], "left").withColumn("found_rows", F.coalesce("found_rows", F.lit(0)))
    n, want = F.col("found_rows"), F.col("planned_rows")
    outside = (F.col("lo") < F.col("doc_id_min")) | (F.col("hi") > F.col("doc_id_max"))
    state = F.when(n == 0, "missing").when(n < want, "partial").when(outside, "misaligned").when(n > want, "surplus").otherwise("complete")
    return rows.withColumn("state", state).drop("doc_id_min", "doc_id_max", "lo", "hi")


#: Headroom over the target below which a pilot fails, in percent.
LEAST_HEADROOM = 5.0


@query(f"SELECT s.setting, incomplete, headroom_pct, CASE WHEN incomplete > 0 THEN 2 WHEN headroom_pct < {LEAST_HEADROOM} THEN 1 ELSE 0 END AS code FROM (SELECT setting, CAST(sum(CASE WHEN state <> 'complete' THEN 1 ELSE 0 END) AS BIGINT) AS incomplete FROM pilot_state GROUP BY setting) s JOIN yields y ON y.setting = s.setting", "pilot_state yields")
def pilot_gate(spark, d):
    """The code of each setting's pilot: 2 if shards are incomplete, 1 if the headroom is too small, else 0."""
    states = pilot_verify(spark, d).groupBy("setting").agg(F.sum((F.col("state") != "complete").cast("long")).alias("incomplete"))
    rows = states.join(yield_projection(spark, d).select("setting", "headroom_pct"), "setting")
    return rows.withColumn("code", F.when(F.col("incomplete") > 0, 2).when(F.col("headroom_pct") < LEAST_HEADROOM, 1).otherwise(0))


@query("SELECT p.setting, coalesce(r.tokens, 0) AS rewritten_tokens, p.tokens AS planned_tokens, coalesce(r.docs, 0) AS rewritten_docs, p.docs AS planned_docs, coalesce(r.tokens, 0) = p.tokens AS ok FROM (SELECT setting, CAST(sum(source_train_tokens) AS BIGINT) AS tokens, CAST(sum(n_docs) AS BIGINT) AS docs FROM shard_plan GROUP BY setting) p LEFT JOIN (SELECT setting, CAST(sum(len) AS BIGINT) AS tokens, count(*) AS docs FROM sources GROUP BY setting) r ON r.setting = p.setting", "sources")
def gate_token_reconcile(spark, d):
    """Source tokens of what was rewritten against what the plan says."""
    r = _sources(spark, d).groupBy("setting").agg(long(F.sum("len"), "rewritten_tokens"), F.count("*").alias("rewritten_docs"))
    p = table(spark, d, "shard_plan").groupBy("setting").agg(long(F.sum("source_train_tokens"), "planned_tokens"), long(F.sum("n_docs"), "planned_docs"))
    rows = F.broadcast(p).join(r, "setting", "left").na.fill(0, ["rewritten_tokens", "rewritten_docs"])  # one row a setting
    return rows.withColumn("ok", F.col("rewritten_tokens") == F.col("planned_tokens"))


@query("SELECT setting, count(CASE WHEN NOT known THEN 1 END) AS unknown_ids, count(CASE WHEN n = 1 THEN 1 END) AS one_pass_only, count(CASE WHEN NOT known THEN 1 END) = 0 AS ok FROM (SELECT setting, doc_id, count(DISTINCT pass_name) AS n, doc_id IN (SELECT doc_id FROM scored) AS known FROM passes WHERE doc_id IS NOT NULL GROUP BY setting, doc_id) GROUP BY setting", "passes scored")
def gate_pass_ids(spark, d):
    """Ids of rewrites that the pool does not have, which would vanish in joins, and ids with one pass only."""
    p = passes(spark, d).where("doc_id is not null").groupBy("setting", "doc_id").agg(F.countDistinct("pass_name").alias("n"))
    known = p.join(scored(spark, d).select("doc_id", F.lit(True).alias("known")), "doc_id", "left")
    rows = known.groupBy("setting").agg(when_count(F.col("known").isNull()).alias("unknown_ids"), when_count(F.col("n") == 1).alias("one_pass_only"))
    return rows.withColumn("ok", F.col("unknown_ids") == 0)


@query("SELECT 'base is filled' AS check_name, sum(len) >= (SELECT b FROM budget) AS ok, CAST(sum(len) AS BIGINT) AS detail FROM base UNION ALL SELECT 'feasible is enough', sum(len) >= (SELECT 2 * b FROM budget), CAST(sum(len) AS BIGINT) FROM feasible", "base feasible budget")
def validate_stage(spark, d):
    s = Selection(spark, d)
    one = lambda df, name, goal: df.agg(long(F.sum("len"), "detail")).select(F.lit(name).alias("check_name"), (F.col("detail") >= goal).alias("ok"), "detail")
    return gates.all_of([one(s.base(), "base is filled", s.b), one(s.feasible()[1], "feasible is enough", 2 * s.b)])


# ---------------------------------------------------------------- calibration


def _calibration(spark, d) -> DataFrame:
    joined = passes(spark, d).join(scored(spark, d).select("doc_id", "len"), "doc_id")
    ok = F.col("status") == 2
    return joined.groupBy("setting", "pass_name", "shard_index").agg(F.count("*").alias("n_rows"), long(F.sum("len"), "src_tokens"), when_sum(ok).alias("src_done_tokens"), when_sum(ok, F.coalesce("rewritten_tokens", F.lit(0))).alias("out_tokens"), when_count(ok).alias("docs_done"))


def _ratios(parts: DataFrame, by: list[str]) -> DataFrame:
    total = parts.groupBy(*by).agg(*(long(F.sum(c), c) for c in ("n_rows", "src_tokens", "src_done_tokens", "out_tokens", "docs_done")))
    return total.withColumn("r_census", F.round(F.col("out_tokens") / F.greatest(F.lit(1), "src_tokens"), 6)).withColumn("r_done", F.round(F.col("out_tokens") / F.greatest(F.lit(1), "src_done_tokens"), 6))


@query("SELECT * FROM calibration", "calibration")
def calibration_by_shard(spark, d):
    return _calibration(spark, d)


_RATIO = "SELECT setting, pass_name, CAST(sum(n_rows) AS BIGINT) AS n_rows, CAST(sum(src_tokens) AS BIGINT) AS src_tokens, CAST(sum(src_done_tokens) AS BIGINT) AS src_done_tokens, CAST(sum(out_tokens) AS BIGINT) AS out_tokens, CAST(sum(docs_done) AS BIGINT) AS docs_done, round(sum(out_tokens) / greatest(1, sum(src_tokens)), 6) AS r_census, round(sum(out_tokens) / greatest(1, sum(src_done_tokens)), 6) AS r_done FROM calibration GROUP BY setting, pass_name"


@query(_RATIO, "calibration")
def calibration_ratio(spark, d):
    return _ratios(_calibration(spark, d), ["setting", "pass_name"])


@query(f"SELECT setting, r_p1, r_distill, round((r_p1 + r_distill) * 2 * b, 2) AS projected, round(100.0 * ((r_p1 + r_distill) * 2 - 1), 4) AS headroom_pct, (r_p1 + r_distill) * 2 >= 1 AS meets_target FROM (SELECT setting, max(CASE WHEN pass_name = 'p1' THEN r_census END) AS r_p1, max(CASE WHEN pass_name = 'distill' THEN r_census END) AS r_distill FROM ({_RATIO}) GROUP BY setting), budget", "calibration budget")
def yield_projection(spark, d):
    b = budget(scored(spark, d))
    r = calibration_ratio(spark, d).groupBy("setting").agg(*(F.max(F.when(F.col("pass_name") == p, F.col("r_census"))).alias(f"r_{p}") for p in ("p1", "distill")))
    both = (F.col("r_p1") + F.col("r_distill")) * 2
    return r.withColumn("projected", F.round(both * b, 2)).withColumn("headroom_pct", F.round(100.0 * (both - 1), 4)).withColumn("meets_target", both >= 1)


# ---------------------------------------------------------------- assembly


def _targets(spark, d, setting: str, by: list[str]) -> DataFrame:
    """The second budget of an arm, by its share of the source's tokens: a supply below it is not padded."""
    source = _sources(spark, d).where(F.col("setting") == setting)
    total = source.agg(F.sum("len").cast("double")).first()[0] or 1.0
    b = budget(scored(spark, d))
    return source.groupBy(*by).agg((F.lit(float(b)) * F.sum("len").cast("double") / F.lit(total)).alias("target"))


def _sources(spark, d) -> DataFrame:
    """(setting, doc_id, len, topic): the documents that an arm rewrote, once each."""
    return passes(spark, d).select("setting", "doc_id").distinct().join(scored(spark, d).select("doc_id", "len", "topic"), "doc_id")


def _kept(spark, d, setting: str, rank, group=None) -> DataFrame:
    rows = stash(_keyed(spark, d).where(F.col("setting") == setting), "passes")
    if group:
        rows = rows.join(F.broadcast(_targets(spark, d, setting, group)), group)  # one row a topic
        return asm.assemble(rows, rank, F.col("target"), group)
    target = float(budget(scored(spark, d)))
    return asm.assemble(rows, rank, target).withColumn("target", F.lit(target))


def _desc(score: str):
    """The rank of an order from the highest score."""
    return -F.col(score).cast("double")


def _random(name: str, key: str):
    """The rank of a random order, between 0 and 1."""
    return F.conv(F.substring(stream(name, key), 1, 12), 16, 10).cast("double") / float(1 << 48)


_ASM = ["rewrite_id", "doc_id", "pass_name", "rn", "before_len", "target"]


@query("SELECT rewrite_id, doc_id, pass_name, rn, before_len, target FROM asm_keyed", "asm_keyed")
def assemble_keyed(spark, d):
    return _kept(spark, d, "quality_prefix", _desc("s1")).select(*_ASM)


@query("SELECT rewrite_id, doc_id, pass_name, rn, before_len, target FROM asm_spread", "asm_spread")
def assemble_key(spark, d):
    return _kept(spark, d, "disagreement", _desc("u")).select(*_ASM)


@query("SELECT rewrite_id, doc_id, pass_name, rn, before_len, target FROM asm_random", "asm_random")
def assemble_random(spark, d):
    return _kept(spark, d, "styled_random", _random("topup", "rewrite_id")).select(*_ASM)


@query("SELECT rewrite_id, doc_id, pass_name, rn, before_len, round(target, 4) AS target FROM asm_topic", "asm_topic")
def assemble_per_topic(spark, d):
    return _kept(spark, d, "topic_quota", _desc("s1"), ["topic"]).withColumn("target", F.round("target", 4)).select(*_ASM)


@query("SELECT setting, count(*) AS docs, CAST(sum(len) AS BIGINT) AS tokens, max(tier) > 0 AS used_distill, CAST(greatest(round_even(any_value(target) - sum(len), 0), 0) AS BIGINT) AS shortfall, CAST(greatest(round_even(sum(len) - any_value(target), 0), 0) AS BIGINT) AS overshoot FROM (SELECT 'quality_prefix' AS setting, len, tier, target FROM asm_keyed UNION ALL SELECT 'styled_random', len, tier, target FROM asm_random UNION ALL SELECT 'disagreement', len, tier, target FROM asm_spread) GROUP BY setting", "asm_keyed asm_random asm_spread")
def assemble_accounting(spark, d):
    """What each arm kept, what is missing of the budget, what is over, and whether the second pass was needed."""
    b = budget(scored(spark, d))
    ranks = {"quality_prefix": _desc("s1"), "styled_random": _random("topup", "rewrite_id"), "disagreement": _desc("u")}
    return reduce(DataFrame.unionByName, [asm.accounting(_kept(spark, d, name, rank), ["setting"], b) for name, rank in ranks.items()])


@query("SELECT pass_name, count(*) AS docs, CAST(sum(len) AS BIGINT) AS tokens FROM asm_keyed GROUP BY pass_name", "asm_keyed")
def assemble_by_pass(spark, d):
    return asm.accounting(_kept(spark, d, "quality_prefix", _desc("s1")), ["pass_name"])


@query("SELECT topic, CAST(greatest(round_even(any_value(target) - coalesce(sum(len), 0), 0), 0) AS BIGINT) AS shortfall FROM (SELECT t.topic, t.target, a.len FROM asm_topic_target t LEFT JOIN asm_topic a ON a.topic = t.topic) GROUP BY topic", "asm_topic asm_topic_target")
def topic_shortfall(spark, d):
    """What each topic is short of its part of the second budget, to the nearest even where it is a half; topics are not filled up by others."""
    kept = _kept(spark, d, "topic_quota", _desc("s1"), ["topic"]).groupBy("topic").agg(F.sum("len").alias("tokens"))
    rows = _targets(spark, d, "topic_quota", ["topic"]).join(kept, "topic", "left")
    return rows.select("topic", F.bround(F.greatest(F.col("target") - F.coalesce("tokens", F.lit(0)), F.lit(0.0))).cast("long").alias("shortfall"))


@query("SELECT topic, shortfall FROM (SELECT topic, CAST(greatest(round_even(any_value(target) - coalesce(sum(len), 0), 0), 0) AS BIGINT) AS shortfall FROM (SELECT t.topic, t.target, a.len FROM asm_topic_target t LEFT JOIN asm_topic a ON a.topic = t.topic) GROUP BY topic) ORDER BY shortfall DESC, topic LIMIT 8", "asm_topic asm_topic_target")
def worst_topics(spark, d):
    """The eight topics that are furthest below their quota."""
    return topic_shortfall(spark, d).orderBy(F.col("shortfall").desc(), "topic").limit(8)


#: Distill shares of an earlier run, in percent of the kept tokens.
EARLIER_DISTILL = {"quality_prefix": 34.9, "styled_random": 16.9, "disagreement": 29.1}


@query("SELECT a.setting, round(100.0 * sum(CASE WHEN tier > 0 THEN len ELSE 0 END) / greatest(1, sum(len)), 4) AS distill_pct, any_value(e.pct) AS earlier_pct, round(round(100.0 * sum(CASE WHEN tier > 0 THEN len ELSE 0 END) / greatest(1, sum(len)), 4) - any_value(e.pct), 4) AS difference FROM (SELECT 'quality_prefix' AS setting, len, tier FROM asm_keyed UNION ALL SELECT 'styled_random', len, tier FROM asm_random UNION ALL SELECT 'disagreement', len, tier FROM asm_spread) a JOIN (VALUES ('quality_prefix', 34.9::DOUBLE), ('styled_random', 16.9), ('disagreement', 29.1)) e(setting, pct) ON e.setting = a.setting GROUP BY a.setting", "asm_keyed asm_random asm_spread")
def distill_share(spark, d):
    """The second pass's part of what each arm kept, beside that of an earlier run."""
    ranks = {"quality_prefix": _desc("s1"), "styled_random": _random("topup", "rewrite_id"), "disagreement": _desc("u")}
    kept = reduce(DataFrame.unionByName, [_kept(spark, d, name, rank).select("setting", "len", "tier") for name, rank in ranks.items()])
    one = kept.groupBy("setting").agg(F.round(100.0 * when_sum(F.col("tier") > 0) / F.greatest(F.lit(1), F.sum("len")), 4).alias("distill_pct"))
    earlier = F.broadcast(spark.createDataFrame(list(EARLIER_DISTILL.items()), "setting string, earlier_pct double"))  # three rows
    return one.join(earlier, "setting").withColumn("difference", F.round(F.col("distill_pct") - F.col("earlier_pct"), 4))


@query("SELECT doc_id, pass_name, len, round(CAST(score AS DOUBLE), 6) AS score FROM both_pool", "both_pool")
def both_pass_pool(spark, d):
    return _both(spark, d).select("doc_id", "pass_name", "len", r6("score", "score"))


def _both(spark, d) -> DataFrame:
    return second_scores(spark, d).where("status = 2 and score is not null")


def _refiltered(spark, d) -> tuple[DataFrame, DataFrame, int]:
    pool = stash(_both(spark, d), "both")
    target = int(pool.agg((F.sum("len") * 3 / 10).cast("long")).first()[0] or 0)
    return pool, budget_fill(pool, [F.col("score").desc(), F.col("pass_name").desc(), F.col("doc_id").asc()], "len", target, method="two_phase", lead=Lead(F.col("score"))), target


@query("SELECT doc_id, pass_name, rn, before_len FROM refilter", "refilter")
def refilter_top_b(spark, d):
    return _refiltered(spark, d)[1].select("doc_id", "pass_name", "rn", "before_len")


@query("SELECT count(*) AS kept_docs, CAST(sum(len) AS BIGINT) AS kept_tokens, round(CAST(arg_max(score, rn) AS DOUBLE), 6) AS cutoff, count(CASE WHEN pass_name = 'p1' THEN 1 END) AS p1_docs, count(CASE WHEN pass_name <> 'p1' THEN 1 END) AS distill_docs, round(100.0 * sum(CASE WHEN pass_name <> 'p1' THEN len ELSE 0 END) / sum(len), 4) AS distill_pct, round(100.0 * sum(len) / (SELECT sum(len) FROM both_pool), 4) AS accepted_pct FROM refilter", "refilter both_pool")
def refilter_accounting(spark, d):
    pool, kept, _ = _refiltered(spark, d)
    total = pool.agg(F.sum("len")).first()[0] or 1
    first = F.col("pass_name") == "p1"
    return kept.agg(
        F.count("*").alias("kept_docs"), long(F.sum("len"), "kept_tokens"), F.round(F.max_by("score", "rn").cast("double"), 6).alias("cutoff"), when_count(first).alias("p1_docs"), when_count(~first).alias("distill_docs"),
        F.round(100.0 * when_sum(~first) / F.sum("len"), 4).alias("distill_pct"), F.round(100.0 * F.sum("len") / F.lit(total), 4).alias("accepted_pct"),
    )


@query("SELECT kept, count(*) AS n, round(min(CAST(score AS DOUBLE)), 6) AS lowest, round(quantile_cont(CAST(score AS DOUBLE), 0.1), 6) AS p10, round(quantile_cont(CAST(score AS DOUBLE), 0.5), 6) AS median, round(quantile_cont(CAST(score AS DOUBLE), 0.9), 6) AS p90, round(max(CAST(score AS DOUBLE)), 6) AS highest FROM (SELECT b.*, r.doc_id IS NOT NULL AS kept FROM both_pool b LEFT JOIN refilter r ON r.doc_id = b.doc_id AND r.pass_name = b.pass_name) GROUP BY kept", "both_pool refilter")
def score_dist(spark, d):
    """Five numbers of the kept and of the other rows; percentiles without a list of all values."""
    pool, kept, _ = _refiltered(spark, d)
    marked = stash(pool.join(kept.select("doc_id", "pass_name", F.lit(True).alias("kept")), ["doc_id", "pass_name"], "left").select(F.coalesce("kept", F.lit(False)).alias("kept"), F.col("score").cast("double").alias("score")), "marked")
    ends = {r["kept"]: r for r in marked.groupBy("kept").agg(F.count("*").alias("n"), F.min("score").alias("lo"), F.max("score").alias("hi")).collect()}  # two rows
    lines = []
    for k, r in ends.items():
        p = exact_percentiles(marked.where(F.col("kept") == k), {"p10": ("score", 0.1), "median": ("score", 0.5), "p90": ("score", 0.9)})
        lines.append((k, r["n"], *(round(x, 6) for x in (r["lo"], p["p10"], p["median"], p["p90"], r["hi"]))))
    return spark.createDataFrame(lines, "kept boolean, n long, lowest double, p10 double, median double, p90 double, highest double")


@query("SELECT doc_id, pass_name, rewritten_tokens, round(CAST(score AS DOUBLE), 6) AS score, round(CAST(ranking AS DOUBLE), 6) AS ranking FROM rescored", "rescored")
def score_rewritten(spark, d):
    return second_scores(spark, d).select("doc_id", "pass_name", "rewritten_tokens", r6("score", "score"), r6("ranking", "ranking"))


@query("SELECT setting, pass_name, shard_index, count(*) AS n, CAST(sum(len) AS BIGINT) AS tokens FROM passes GROUP BY ALL", "passes")
def collect_pass(spark, d):
    return passes(spark, d).withColumn("len", scores.train_len("rewritten_tokens")).groupBy("setting", "pass_name", "shard_index").agg(F.count("*").alias("n"), long(F.sum("len"), "tokens"))


# ---------------------------------------------------------------- text functions


def _texted(spark, d, expr) -> DataFrame:
    rows = table(spark, d, "rewritten").select("rewrite_id", expr.alias("x")).select("rewrite_id", long(F.length("x"), "n_chars"), F.md5("x").alias("md5"))
    return rows.groupBy("rewrite_id").agg(F.min(F.struct("n_chars", "md5")).alias("x")).select("rewrite_id", "x.*")  # the texts are not shuffled


def _texted_sql(x: str) -> str:
    return f"SELECT rewrite_id, CAST(length(x) AS BIGINT) AS n_chars, md5(x) AS md5 FROM (SELECT rewrite_id, {x} AS x FROM passes)"


@query(_texted_sql("substr(translate(coalesce(rewritten, ''), chr(10) || chr(13), '  '), 1, 100000)"), "passes")
def clean_text(spark, d):
    return _texted(spark, d, rules.clean(F.col("rewritten")))


@query(_texted_sql(o.strip_prefix("rewritten")), "passes")
def strip_prefix(spark, d):
    return _texted(spark, d, rules.strip_prefix(F.col("rewritten")))


@query(_texted_sql(o.strip_leak("rewritten")), "passes")
def strip_leak(spark, d):
    return _texted(spark, d, rules.strip_leak(F.col("rewritten")))


@query(_texted_sql(o.strip_distill("rewritten")), "passes")
def strip_distill(spark, d):
    return _texted(spark, d, rules.strip_distill(F.col("rewritten")))


@query(_texted_sql(o.strip_styled("rewritten")), "passes")
def strip_styled(spark, d):
    return _texted(spark, d, rules.strip_styled(F.col("rewritten")))


@query(_texted_sql(o.strip_by("setting", "pass_name", "rewritten")), "passes")
def strip_dispatch(spark, d):
    return _texted(spark, d, rules.strip_by(F.col("setting"), F.col("pass_name"), F.col("rewritten")))


@query(f"SELECT setting, pass_name, count(*) AS n, count(CASE WHEN after <> before THEN 1 END) AS stripped, CAST(sum(wb) AS BIGINT) AS words_before, CAST(sum(wa) AS BIGINT) AS words_after FROM (SELECT setting, pass_name, before, after, {o.word_count('before')} AS wb, {o.word_count('after')} AS wa FROM (SELECT setting, pass_name, coalesce(rewritten, '') AS before, coalesce({o.strip_by('setting', 'pass_name', 'rewritten')}, '') AS after FROM done)) GROUP BY setting, pass_name", "done")
def strip_accounting(spark, d):
    rows = asm.completed(passes(spark, d, text=True)).select("setting", "pass_name", F.coalesce("rewritten", F.lit("")).alias("before"), F.coalesce(rules.strip_by(F.col("setting"), F.col("pass_name"), F.col("rewritten")), F.lit("")).alias("after"))
    return rows.groupBy("setting", "pass_name").agg(F.count("*").alias("n"), when_count(F.col("after") != F.col("before")).alias("stripped"), long(F.sum(rules.word_count(F.col("before"))), "words_before"), long(F.sum(rules.word_count(F.col("after"))), "words_after"))


@query(f"SELECT rewrite_id, {o.word_count('rewritten')} AS n FROM passes", "passes")
def token_count(spark, d):
    """Tokens of each answer by a tokenizer that is a parameter; here the stand-in."""
    return _narrow(spark, d, models.token_counter(models.pieces)(F.col("rewritten")).alias("n"))


@query(f"SELECT doc_id, {o.word_count("replace('Restate the text below without adding facts. Text: [TEXT] End.', '[TEXT]', coalesce(text, ''))")} AS n FROM pool_texts", "pool_texts")
def templated_length(spark, d):
    """Input length of a request: tokens of the whole prompt."""
    rows = table(spark, d, "pool").where("doc_id is not null").select("doc_id", models.token_counter(models.pieces)(rules.prompt(_TEMPLATE, F.col("text"))).alias("n"))
    return rows.groupBy("doc_id").agg(F.min("n").alias("n"))


@query("SELECT rewrite_id, round(CASE WHEN coalesce(length(rewritten), 0) = 0 THEN 0 WHEN length(rewritten) % 2 = 0 THEN 0.5 + (length(rewritten) % 50) / 100.0 ELSE 0.5 - (length(rewritten) % 50) / 100.0 END, 6) AS raw FROM passes", "passes")
def score_raw(spark, d):
    """The raw score of each answer by a classifier that is a parameter; here the stand-in."""
    c = models.classifier(models.by_length)(F.col("rewritten"))
    rows = table(spark, d, "rewritten").select("rewrite_id", "rewritten", c.alias("c"))
    return rows.select("rewrite_id", r6(models.raw_score(F.col("rewritten"), F.col("c.label"), F.col("c.p")), "raw")).groupBy("rewrite_id").agg(F.min("raw").alias("raw"))


def _narrow(spark, d, *columns) -> DataFrame:
    """Columns made of the answers, once a rewrite_id: what is made is shuffled, not the texts."""
    rows = table(spark, d, "rewritten").select("rewrite_id", *columns)
    names = [c for c in rows.columns if c != "rewrite_id"]
    return rows.groupBy("rewrite_id").agg(F.min(F.struct(*names)).alias("x")).select("rewrite_id", "x.*")


def _sourced(spark, d) -> DataFrame:
    return passes(spark, d, text=True).join(texts(spark, d), "doc_id", "left")


_SOURCED = "(SELECT p.rewrite_id, p.rewritten, p.rewritten_tokens, p.input_tokens_qwen, t.text FROM passes p LEFT JOIN pool_texts t ON p.doc_id = t.doc_id)"


@query(f"SELECT rewrite_id, len({o.word_set('rewritten')}) AS n_out, len({o.word_set('text')}) AS n_in, len(list_intersect({o.word_set('rewritten')}, {o.word_set('text')})) AS n_both FROM {_SOURCED}", "passes pool_texts")
def word_overlap(spark, d):
    a, b = rules.word_set(F.col("rewritten")), rules.word_set(F.col("text"))
    return _sourced(spark, d).select("rewrite_id", long(F.size(a), "n_out"), long(F.size(b), "n_in"), long(F.size(F.array_intersect(a, b)), "n_both"))


@query(f"SELECT rewrite_id, n_out > 0 AND n_both > 0.9 * n_out AS format_only FROM (SELECT rewrite_id, len({o.word_set('rewritten')}) AS n_out, len(list_intersect({o.word_set('rewritten')}, {o.word_set('text')})) AS n_both FROM {_SOURCED})", "passes pool_texts")
def flag_format_only(spark, d):
    return _sourced(spark, d).select("rewrite_id", rules.format_only(F.col("text"), F.col("rewritten")).alias("format_only"))


@query("SELECT rewrite_id, coalesce(length(rewritten) >= 50 AND (SELECT max(c) FROM (SELECT count(*) AS c FROM (SELECT unnest(list_transform(range(0, greatest(length(rewritten) - 49, 0), 10), lambda k: substr(rewritten, k + 1, 50))) AS s) GROUP BY s)) >= 5, false) AS repeats FROM passes", "passes")
def flag_repetition(spark, d):
    return _narrow(spark, d, rules.repeats(F.col("rewritten")).alias("repeats"))


@query("SELECT rewrite_id, coalesce(rewritten_tokens < 20 AND input_tokens_qwen > 200, false) AS short FROM passes", "passes")
def flag_short(spark, d):
    return passes(spark, d).select("rewrite_id", F.coalesce((F.col("rewritten_tokens") < 20) & (F.col("input_tokens_qwen") > 200), F.lit(False)).alias("short"))


_TEMPLATE = "Restate the text below without adding facts. Text: [TEXT] End."


@query(f"SELECT doc_id, md5(replace('{_TEMPLATE}', '[TEXT]', coalesce(text, ''))) AS prompt_md5, CAST(length(replace('{_TEMPLATE}', '[TEXT]', coalesce(text, ''))) AS BIGINT) AS n_chars FROM pool_texts", "pool_texts")
def prompt_content(spark, d):
    p = texts(spark, d).select("doc_id", rules.prompt(_TEMPLATE, F.col("text")).alias("p"))
    return p.select("doc_id", F.md5("p").alias("prompt_md5"), long(F.length("p"), "n_chars"))


@query(f"SELECT doc_id, list_extract(['easy', 'hard', 'wiki', 'qa'], CAST(('0x' || substr(md5('42:style:' || doc_id // {SHARD_ROWS} || ':' || doc_id % {SHARD_ROWS}), 1, 8))::BIGINT % 4 + 1 AS BIGINT)) AS style FROM scored", "scored")
def assign_style(spark, d):
    """A style for each row of a shard, drawn from the shard's own stream by place, whatever else is in the run."""
    rows = scored(spark, d).select("doc_id", F.expr(f"doc_id div {SHARD_ROWS}").alias("shard"), F.pmod("doc_id", F.lit(SHARD_ROWS)).cast("long").alias("row"))
    return rows.select("doc_id", rules.style_of(42, "shard", "row").alias("style"))


@query("SELECT wrap_style, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 4) AS pct, CAST(sum(len) AS BIGINT) AS tokens, abs(round(100.0 * count(*) / sum(count(*)) OVER (), 4) - 25) <= 0.5 AS ok FROM done WHERE setting = 'styled_random' AND pass_name = 'p1' GROUP BY wrap_style", "done")
def style_balance(spark, d):
    rows = asm.completed(passes(spark, d)).where("setting = 'styled_random' and pass_name = 'p1'").groupBy("wrap_style").agg(F.count("*").alias("n"), long(F.sum("len"), "tokens"))
    rows = rows.withColumn("pct", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))), 4))  # one row for each style
    return rows.withColumn("ok", F.abs(F.col("pct") - 25) <= 0.5)


@query("SELECT doc_id, md5(text) AS md5, sha256(text) AS sha256 FROM pool_texts", "pool_texts")
def text_md5(spark, d):
    return texts(spark, d).select("doc_id", F.md5("text").alias("md5"), F.sha2("text", 256).alias("sha256"))


# ---------------------------------------------------------------- rewriting with a stand-in


def rewriter(share: float, lead: str):
    """A deterministic stand-in for a generator: the first share of the words, at least one, behind a lead.

    It has the shape of a real one (a function of Arrow batches, run by
    ``mapInArrow``), so that a model can be put in its place.
    """
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                words = [w for w in (text or "").replace("\t", " ").replace("\r", " ").replace("\n", " ").split(" ") if w]
                out.append(lead + " ".join(words[: max(1, int(share * len(words)))]) if words else "")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], ["doc_id", "rewritten"])

    return run


def _rewritten_sql(share: float, lead: str) -> str:
    words = "list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\r]+'), lambda w: w <> '')"
    return f"SELECT doc_id, CASE WHEN len({words}) = 0 THEN 0 ELSE length(x) END AS n_chars, md5(CASE WHEN len({words}) = 0 THEN '' ELSE x END) AS md5 FROM (SELECT doc_id, text, {o._lit(lead)} || array_to_string({words}[1:greatest(1, CAST(floor({share} * len({words})) AS BIGINT))], ' ') AS x FROM pool_texts)"


def _rewrite(spark, d, share: float, lead: str) -> DataFrame:
    out = map_arrow(texts(spark, d).select("doc_id", "text"), rewriter(share, lead), "doc_id long, rewritten string")
    return out.select("doc_id", long(F.length("rewritten"), "n_chars"), F.md5("rewritten").alias("md5"))


@query(_rewritten_sql(0.34, rules.PREFIX), "pool_texts")
def rewrite_p1(spark, d):
    return _rewrite(spark, d, 0.34, rules.PREFIX)


@query(_rewritten_sql(0.26, ""), "pool_texts")
def rewrite_p2(spark, d):
    return _rewrite(spark, d, 0.26, "")


@query("SELECT rewrite_id, doc_id, substr(rewritten, 1, 500) AS head FROM (SELECT *, row_number() OVER (PARTITION BY setting, pass_name ORDER BY md5('42:monitor:' || rewrite_id), rewrite_id) AS k FROM passes) WHERE k <= 10", "passes")
def monitor_sample(spark, d):
    """Ten samples of each setting and pass for the eye; a top-k by hash, not a sort of all rows."""
    h = passes(spark, d).withColumn("h", stream("monitor", "rewrite_id"))
    w = Window.partitionBy("setting", "pass_name").orderBy("h", "rewrite_id")
    few = h.withColumn("k", F.row_number().over(w)).where("k <= 10").select("rewrite_id", "doc_id")
    return table(spark, d, "rewritten").select("rewrite_id", "rewritten").join(F.broadcast(few), "rewrite_id").groupBy("rewrite_id", "doc_id").agg(F.substring(F.min("rewritten"), 1, 500).alias("head"))  # at most ten rows for each setting and pass


@query("SELECT setting, pass_name, status, count(*) AS n, CAST(sum(len) AS BIGINT) AS tokens FROM passes GROUP BY ALL", "passes")
def progress_summary(spark, d):
    return passes(spark, d).withColumn("len", scores.train_len("rewritten_tokens")).groupBy("setting", "pass_name", "status").agg(F.count("*").alias("n"), long(F.sum("len"), "tokens"))


# ---------------------------------------------------------------- the final mix


def _base_rows(spark, d) -> DataFrame:
    base = Selection(spark, d).base().select("doc_id", "orig_doc_id")
    return base.join(texts(spark, d), "doc_id").select("orig_doc_id", "text", F.lit("original").alias("source_prompt"), F.col("tokens").cast("int").alias("tokens_llama2"))


_BASE_ROWS = "(SELECT b.orig_doc_id, t.text, 'original' AS source_prompt, CAST(t.tokens AS INTEGER) AS tokens_llama2 FROM base b JOIN pool_texts t ON b.doc_id = t.doc_id)"


@query(f"SELECT orig_doc_id, md5(text) AS text_md5, source_prompt, tokens_llama2 FROM {_BASE_ROWS}", "base pool_texts")
def base_rows(spark, d):
    return _base_rows(spark, d).select("orig_doc_id", F.md5("text").alias("text_md5"), "source_prompt", "tokens_llama2")


def _strategy_rows(spark, d) -> DataFrame:
    """Rows of the kept rewrites: the keep set is narrow and finds its texts by key."""
    kept = _kept(spark, d, "quality_prefix", _desc("s1")).select("rewrite_id", "doc_id", "setting", "pass_name", "wrap_style", "rewritten_tokens")
    text = table(spark, d, "rewritten").groupBy("rewrite_id").agg(F.min("rewritten").alias("text"))
    rows = kept.join(text, "rewrite_id").join(scored(spark, d).select("doc_id", "orig_doc_id"), "doc_id")
    return rows.select("rewrite_id", "orig_doc_id", "text", _source_prompt().alias("source_prompt"), F.coalesce("rewritten_tokens", F.lit(0)).cast("int").alias("tokens_llama2"))


_STRATEGY = "(SELECT a.rewrite_id, s.orig_doc_id, a.rewritten AS text, CASE WHEN pass_name = 'p1' THEN 'wikipedia' ELSE 'distill' END AS source_prompt, CAST(coalesce(rewritten_tokens, 0) AS INTEGER) AS tokens_llama2 FROM asm_keyed a JOIN scored s ON a.doc_id = s.doc_id)"


@query(f"SELECT rewrite_id, orig_doc_id, md5(text) AS text_md5, source_prompt, tokens_llama2 FROM {_STRATEGY}", "asm_keyed scored")
def assembled_rows(spark, d):
    return _strategy_rows(spark, d).select("rewrite_id", "orig_doc_id", F.md5("text").alias("text_md5"), "source_prompt", "tokens_llama2")


@query(f"SELECT orig_doc_id, md5(text) AS text_md5, source_prompt, tokens_llama2 FROM (SELECT orig_doc_id, text, source_prompt, tokens_llama2 FROM {_BASE_ROWS} UNION ALL SELECT orig_doc_id, text, source_prompt, tokens_llama2 FROM {_STRATEGY})", "base pool_texts asm_keyed scored")
def final_rows(spark, d):
    return _base_rows(spark, d).unionByName(_strategy_rows(spark, d).drop("rewrite_id")).select("orig_doc_id", F.md5("text").alias("text_md5"), "source_prompt", "tokens_llama2")


@query(f"SELECT orig_doc_id, source_prompt, k AS place, (k - 1) // {PART_ROWS} AS part_no FROM (SELECT *, row_number() OVER (ORDER BY md5('42:shuffle:' || orig_doc_id || ':' || source_prompt), orig_doc_id, source_prompt) AS k FROM final_once)", "final_once")
def final_shuffle(spark, d):
    """A document-level shuffle of the corpus: a range sort by hash, cut into parts of equal rows."""
    once = table(spark, d, "final").select("orig_doc_id", "source_prompt").distinct().withColumn("h", stream("shuffle", "orig_doc_id", "source_prompt"))
    placed = running_sum(once, [F.col("h").asc(), F.col("orig_doc_id").asc(), F.col("source_prompt").asc()], F.lit(1), hash_lead(F.col("h")))
    return placed.select("orig_doc_id", "source_prompt", F.col("rn").alias("place"), F.expr(f"(rn - 1) div {PART_ROWS}").alias("part_no"))


@query("SELECT source_prompt = 'original' AS is_base, count(*) AS docs, CAST(sum(greatest(tokens, 0) + 1) AS BIGINT) AS tokens, round(100.0 * sum(greatest(tokens, 0) + 1) / sum(sum(greatest(tokens, 0) + 1)) OVER (), 4) AS pct FROM final_once GROUP BY source_prompt = 'original'", "final_once")
def final_accounting(spark, d):
    once = table(spark, d, "final").groupBy("orig_doc_id", "source_prompt").agg(F.min(F.coalesce("tokens_llama2", F.lit(0))).cast("long").alias("t"))
    by = once.groupBy((F.col("source_prompt") == "original").alias("is_base")).agg(F.count("*").alias("docs"), long(F.sum(F.greatest("t", F.lit(0)) + 1), "tokens"))
    return by.withColumn("pct", F.round(100.0 * F.col("tokens") / F.sum("tokens").over(Window.partitionBy(F.lit(1))), 4))  # two rows


@query("SELECT k AS epochs, k * 2 * b AS horizon, round(k * 2 * b / (SELECT CAST(sum(greatest(tokens, 0) + 1) AS DOUBLE) FROM final_once), 6) AS corpus_passes FROM budget, (VALUES (1), (2), (3)) t(k)", "budget final_once")
def horizon_plan(spark, d):
    b = budget(scored(spark, d))
    once = table(spark, d, "final").groupBy("orig_doc_id", "source_prompt").agg(F.min(F.coalesce("tokens_llama2", F.lit(0))).cast("long").alias("t")).agg(F.sum(F.greatest("t", F.lit(0)) + 1).cast("double").alias("corpus"))
    rows = once.select("corpus", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("epochs"))
    return rows.select("epochs", long(F.col("epochs") * F.lit(2 * b), "horizon"), F.round(F.col("epochs") * F.lit(2 * b) / F.col("corpus"), 6).alias("corpus_passes"))


# ---------------------------------------------------------------- heartbeats


@query("SELECT user_id, ts AS last_ts, event_type AS last_type, round((epoch_us(now) - epoch_us(ts)) / 1000000.0, 3) AS age_seconds, (epoch_us(now) - epoch_us(ts)) / 1000000.0 > 1800 AS stale FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k, max(ts) OVER () AS now FROM events) WHERE k = 1")
def lease_status(spark, d):
    return leases.status(table(spark, d, "events"))


@query("SELECT user_id, min(ts) AS started, count(*) AS beats FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY user_id, run")
def lease_sessions(spark, d):
    return leases.sessions(table(spark, d, "events"))


@query("SELECT date_trunc('day', ts)::TIMESTAMP AS day, event_type, count(*) AS beats FROM events GROUP BY ALL")
def lease_stream(spark, d):
    """The same table read as a stream, in windows with a watermark."""
    return leases.stream_counts(spark, f"{d}/events.parquet", table(spark, d, "events").schema)
