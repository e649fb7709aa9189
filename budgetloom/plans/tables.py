"""Input tables as the plans read them: pruned, once per key, with typed derived columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from budgetloom.functions.scores import consensus, disagreement, upper_score
from budgetloom.session import table


def topic_of(c: str = "topic") -> Column:
    """A topic without case and outer blanks."""
    return F.coalesce(F.lower(F.trim(c)), F.lit("(none)"))


def one_row(df: DataFrame, keys: list[str], **columns: str | Column) -> DataFrame:
    """One of the rows of each key, the least by the columns in their order: never a mix of several rows."""
    named = [(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()]
    return df.groupBy(*keys).agg(F.min(F.struct(*named)).alias("__row")).select(*keys, "__row.*")


def scored(spark: SparkSession, d: str) -> DataFrame:
    """The scored pool, one row per document; texts are not read.

    Documents need a positive length and all three percentiles.
    """
    pool = table(spark, d, "pool").where("tok > 0 and doc_id is not null and fasttext_ranking_v2 is not null and fineweb_edu_ranking_v2 is not null and modernbert_ranking_v2 is not null")
    once = one_row(
        pool, ["doc_id"], orig_doc_id="orig_doc_id", len=F.col("tok").cast("long"), raw="fasttext", s1="fasttext_ranking_v2", s2="fineweb_edu_ranking_v2", s3="modernbert_ranking_v2", topic=topic_of(),
    )
    q = once.withColumn("q", consensus("s1", "s2", "s3"))
    v = q.withColumn("v", disagreement("q", "s1", "s2", "s3"))
    return v.withColumn("u", upper_score("q", "v"))


def texts(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, text, tokens): the pool's wide column, once per document; join it late."""
    return table(spark, d, "pool").where("doc_id is not null").transform(one_row, ["doc_id"], text="text", tokens=F.coalesce("tokens_llama2", F.lit(0)).cast("long"))


PASS_COLUMNS = ["doc_id", "setting", "pass_name", "shard_index", "rewritten_tokens", "status", "wrap_style", "finish_reason", "input_tokens_qwen"]


def passes(spark: SparkSession, d: str, text: bool = False) -> DataFrame:
    """Rewritten rows, once a rewrite_id; the text only where it is asked for."""
    columns = [*PASS_COLUMNS, *(["rewritten"] if text else [])]
    return one_row(table(spark, d, "rewritten"), ["rewrite_id"], **{c: c for c in columns})


def second_scores(spark: SparkSession, d: str) -> DataFrame:
    """Rescored rewrites, once per document and pass, with their length."""
    t = table(spark, d, "scored_rewrites")
    once = one_row(t, ["doc_id", "pass_name"], status="status", rewritten_tokens="rewritten_tokens", score="rewritten_fasttext_score", ranking="rewritten_fasttext_ranking_v2")
    return once.withColumn("len", (F.coalesce("rewritten_tokens", F.lit(0)) + 1).cast("long"))
