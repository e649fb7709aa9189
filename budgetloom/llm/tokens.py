"""Token counts and ids of a corpus under public tokenizers (problems 4 and 7)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from budgetloom.llm.arrow import over_batches
from budgetloom.llm.merges import byte_encoder, default_path, piece_counter


def encode_ids(df: DataFrame, key: str, text: str, ranks_path: str | None = None) -> DataFrame:
    """(key, ids): each row's ids under a byte-level vocabulary of ranks.

    One pass without a shuffle.  Null and empty texts give the empty list;
    strings that look like special tokens are ordinary text; repeated rows stay
    repeated; a null key is kept; other columns are dropped.  Very long texts
    are encoded whole.
    """
    path = ranks_path or default_path("byte_bpe_50k.tiktoken")
    kind = df.schema[key].dataType

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        flat, sizes = byte_encoder(path).encode(batch.column(1).to_pylist())
        offsets = pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(flat.astype(np.int32)))], [key, "ids"])

    schema = T.StructType([T.StructField(key, kind), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return over_batches(df.select(F.col(key), F.col(text)), run, schema)


def count_tokens(df: DataFrame, keep: list[str], text: str, tokenizer: str, path: str | None = None) -> DataFrame:
    """The columns ``keep`` and ``n_tokens`` (long), in one pass without a shuffle.

    tokenizer: ``piece`` (sentence-piece BPE with byte fallback) or ``byte``
    (byte-level ranks).  Null and empty texts have 0 tokens; repeated rows stay.
    """
    if tokenizer not in ("piece", "byte"):
        raise ValueError(f"no tokenizer of the kind {tokenizer!r}")
    path = path or default_path("piece_bpe_32k.model" if tokenizer == "piece" else "byte_bpe_50k.tiktoken")
    load = piece_counter if tokenizer == "piece" else byte_encoder

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = load(path).count(batch.column(len(keep)).to_pylist())
        return pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(n)], [*keep, "n_tokens"])

    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField("n_tokens", T.LongType())])
    return over_batches(df.select(*(F.col(c) for c in keep), F.col(text).alias("__text")), run, schema)


def wrong_counts(final: DataFrame, path: str | None = None) -> DataFrame:
    """(orig_doc_id, source_prompt) of the rows whose stored count cannot be right.

    Wrong is a stored count that is null, negative, zero though the text has a
    word, or, for texts of 60 characters or more, over twice or under half the
    counted tokens.  Repeated rows count once; a null text has no word and no
    characters; null keys are kept.
    """
    rows = final.select(
        "orig_doc_id", "source_prompt", "tokens_llama2", "text",
        F.coalesce(F.length("text"), F.lit(0)).alias("n_chars"),
        F.coalesce(F.col("text").rlike(r"[\p{L}\p{N}]"), F.lit(False)).alias("has_word"),
    )
    counted = count_tokens(rows, ["orig_doc_id", "source_prompt", "tokens_llama2", "n_chars", "has_word"], "text", "piece", path)
    stored = F.col("tokens_llama2").cast("long")
    wrong = (
        stored.isNull()
        | (stored < 0)
        | ((stored == 0) & F.col("has_word"))
        | ((F.col("n_chars") >= 60) & ((stored > 2 * F.col("n_tokens")) | (2 * stored < F.col("n_tokens"))))
    )
    return counted.where(wrong).select("orig_doc_id", "source_prompt").dropDuplicates()


def token_budget(final: DataFrame, pool: DataFrame, path: str | None = None) -> DataFrame:
    """Documents and tokens by source_prompt, pool.lang and pool.topic.

    Repeated rows of (orig_doc_id, source_prompt) count once.  Topics are taken
    without case and outer blanks; a document that the pool lacks, or whose
    field is null there, is counted under ``(none)``.  Only counts are joined
    with the pool, never texts.
    """
    counted = count_tokens(final, ["orig_doc_id", "source_prompt"], "text", "piece", path)
    once = counted.groupBy("orig_doc_id", "source_prompt").agg(F.max("n_tokens").alias("n_tokens"))
    of_pool = pool.groupBy("doc_id").agg(F.max("lang").alias("lang"), F.max(F.lower(F.regexp_replace("topic", r"^\s+|\s+$", ""))).alias("topic"))
    none = F.lit("(none)")
    return (
        once.join(of_pool, once.orig_doc_id == of_pool.doc_id, "left")
        .groupBy(F.coalesce("source_prompt", none).alias("source_prompt"), F.coalesce("lang", none).alias("lang"), F.coalesce("topic", none).alias("topic"))
        .agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    )


def salted_rank(df: DataFrame, group: list[str], order: list[str], salts: int = 256) -> DataFrame:
    """``df`` with ``rank``, counting from 0 in each group, without one task for a hot group.

    Rows are numbered in (group, salt) and moved on by the counts of the salts
    before; the order within a group is that of (salt, order).
    """
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    counts = salted.groupBy(*group, "__salt").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*group).orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    inner = Window.partitionBy(*group, "__salt").orderBy(*order)
    numbered = salted.withColumn("__k", F.row_number().over(inner) - 1)
    return numbered.join(offsets, [*group, "__salt"]).withColumn("rank", (F.col("__before") + F.col("__k")).cast("long")).drop("__salt", "__k", "__before")
