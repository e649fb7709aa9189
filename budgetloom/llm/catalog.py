"""The queries of the training-data operators, by name."""

from __future__ import annotations

from pyspark.sql import functions as F

from budgetloom.llm import abuse, defects, near, overlap, packing, repetition, sampling, tokens
from budgetloom.llm.oracle import SQL
from budgetloom.session import table


#: The likeness and the shingles that TESTDATA.md fixes for problems 2 and 3.
LIKENESS, WORDS_IN_A_ROW = 0.7, 3


def p1_found(spark, d):
    return sampling.unmet(sampling.Plan(table(spark, d, "pool"), table(spark, d, "topic_targets")))


def p1_sample(spark, d):
    return sampling.draw(sampling.Plan(table(spark, d, "pool"), table(spark, d, "topic_targets")))


def p1_report(spark, d):
    plan = sampling.Plan(table(spark, d, "pool"), table(spark, d, "topic_targets"))
    return sampling.report(plan, sampling.draw(plan))


def _overlaps(spark, d):
    return overlap.overlaps(table(spark, d, "pool"), "doc_id", "text", "split", LIKENESS, WORDS_IN_A_ROW)


def p2_found(spark, d):
    pairs = _overlaps(spark, d).where(F.col("likeness") >= LIKENESS)
    return pairs.select(F.least("eval_id", "train_id").alias("doc_id_a"), F.greatest("eval_id", "train_id").alias("doc_id_b")).distinct()


def p2_containment(spark, d):
    return _overlaps(spark, d).select("eval_id", "train_id", F.round("containment", 6).alias("containment"), F.round("likeness", 6).alias("likeness"))


def p2_report(spark, d):
    return overlap.overlap_report(_overlaps(spark, d), table(spark, d, "pool"), "doc_id", "split", "source")


def p3_found(spark, d):
    return near.pairs_in_groups(near.near_groups(table(spark, d, "pool"), "doc_id", "text", LIKENESS, WORDS_IN_A_ROW))


def p3_groups(spark, d):
    return near.least_ids(near.near_groups(table(spark, d, "pool"), "doc_id", "text", LIKENESS, WORDS_IN_A_ROW))


def p4_found(spark, d):
    return tokens.wrong_counts(table(spark, d, "final"))


def p4_budget(spark, d):
    return tokens.token_budget(table(spark, d, "final"), table(spark, d, "pool"))


def _labels(spark, d):
    return defects.defect_labels(table(spark, d, "rewritten"), table(spark, d, "pool"))


def p5_found(spark, d):
    return defects.first_defect(_labels(spark, d))


def p5_labels(spark, d):
    return _labels(spark, d).select("rewrite_id", "defect", F.round("posterior", 4).alias("posterior"))


def p6_found(spark, d):
    return repetition.repeating(table(spark, d, "rewritten"), "rewrite_id", "rewritten").select("rewrite_id")


def p6_shares(spark, d):
    return repetition.shares(table(spark, d, "rewritten"), "rewrite_id", "rewritten").withColumn("share", F.round("share", 6))


def p7_ids(spark, d):
    return tokens.encode_ids(table(spark, d, "documents"), "doc_id", "text")


def p8_packing(spark, d):
    return packing.pack_documents(table(spark, d, "documents"), table(spark, d, "pack_sizes"))


def p8_report(spark, d):
    packs = table(spark, d, "pack_sizes")
    return packing.fill_report(packing.pack_documents(table(spark, d, "documents"), packs), packs)


def p9_found(spark, d):
    return abuse.abusive(table(spark, d, "documents"), "doc_id", "text")


def p9_scores(spark, d):
    return abuse.scores(table(spark, d, "documents"), "doc_id", "text").groupBy("doc_id").agg(F.round(F.max("score"), 6).alias("score"))


def p9_rates(spark, d):
    return abuse.rates(table(spark, d, "documents"), "doc_id", "text", "source")


def queries():
    return {name: f for name, f in globals().items() if name[:1] == "p" and name[1:2].isdigit()}


def oracle_sql():
    return dict(SQL)
