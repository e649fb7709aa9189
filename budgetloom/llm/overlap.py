"""Evaluation records that also stand in the training split (problem 2).

The evaluation records' word n-gram hashes (of eight words) make a bitmap, and
the training split is scanned once for hits.  Hits are partitioned by n-gram and
joined with each evaluation record's rarest n-grams; pairs that share enough of
them are candidates, and for these the containment of the evaluation record in
the training record, and their likeness, are computed exactly, on whole texts.

Containment, not likeness, makes a candidate, so that a record that stands whole
inside a much longer one is found.  An evaluation record may lose the share
1 - containment of its shingles of n words; a changed word costs n shingles and
eight n-grams, so that it may lose 8 / n times that share of its n-grams, and
must keep one of so many and one more.  These are its rarest ones, by counts over
all training hits: what much of the training split holds brings a record to
another only if it has little else.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from budgetloom.llm.arrow import over_batches
from budgetloom.llm.near import REMEMBERED, Bitmap, counted, representatives, sets_of
from budgetloom.llm.shingles import MIN_WORDS, N, mix, runs, word_hashes
from budgetloom.session import map_arrow, stash

#: Words of an n-gram that is looked up, and how many a pair shares beyond what it may lose.
LOOKED_UP, SHARED = 8, 4
#: Hits of an n-gram that one task joins; n-grams with more are split by salt.
HOT_HITS, MOST_HOT = 50_000, 10_000


def word_grams(texts: list[str | None], min_words: int, k: int = LOOKED_UP) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(n-grams, text of each, names of texts, whether each text counts); an n-gram may come twice.

    A name is made of all n-grams of a text; texts of equal names have the same shingles.
    """
    hashes, counts = word_hashes(texts)
    counts_in = counts >= max(min_words, 1)
    k_of = np.minimum(k, counts)
    gram, inside = runs(hashes, counts, k)
    owner = np.repeat(np.arange(len(texts)), counts)
    short = np.repeat((k_of < k) & counts_in, counts)
    inside = inside & np.repeat(counts_in, counts)
    if short.any():  # a text of fewer words than an n-gram has is one n-gram
        first = np.zeros(len(hashes), bool)
        starts = (np.cumsum(counts) - counts)[(counts > 0) & (counts < k) & counts_in]
        first[starts] = True
        for s in starts:
            gram[s] = mix(np.array([hashes[s : s + counts[owner[s]]].sum()], np.uint64))[0]
        inside = inside | first
    g, o = gram[inside], owner[inside]
    names = np.zeros(len(texts), np.uint64)
    np.add.at(names, o, mix(g))
    return g.view(np.int64), o, mix(names).view(np.int64), counts_in


def _once(g: np.ndarray, o: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each n-gram of a text once."""
    key = mix(g.view(np.uint64) + mix(o.astype(np.uint64) + np.uint64(1)))
    _, at = np.unique(key, return_index=True)
    return g[at], o[at]


def _hits(df: DataFrame, bitmap: Bitmap, min_words: int) -> DataFrame:
    """(id, name, gram, size): a line without n-gram for each record, and a record's n-grams that are in the bitmap, once a name and task.

    size is the record's number of different n-grams.
    """
    inside = bitmap.filter()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for whole in batches:
            for start in range(0, whole.num_rows, 2_000):
                batch = whole.slice(start, 2_000)
                g, o, names, counts_in = word_grams(batch.column(1).to_pylist(), min_words)
                who = np.flatnonzero(counts_in)
                new = np.zeros(len(names), bool)
                for i in who.tolist():
                    if (name := int(names[i])) not in seen:
                        new[i] = True
                        if len(seen) < REMEMBERED:
                            seen.add(name)
                g, o = _once(g[new[o]], o[new[o]])
                sizes = np.bincount(o, minlength=len(names))
                hit = inside(g)
                g, o = g[hit], o[hit]
                ids = batch.column(0)
                nulls = lambda k: pa.nulls(k, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([ids.take(pa.array(who)), nulls(len(g))]), pa.concat_arrays([pa.array(names[who]), pa.array(names[o])]),
                        pa.concat_arrays([nulls(len(who)), pa.array(g)]), pa.concat_arrays([nulls(len(who)), pa.array(sizes[o].astype(np.int64))]),
                    ],
                    ["id", "name", "gram", "size"],
                )

    return map_arrow(df, run, "id long, name long, gram long, size long")


def _names(texts: list[str]) -> np.ndarray:
    return word_grams(texts, 1)[2]


def candidates(evaluation: DataFrame, training: DataFrame, lost: float) -> DataFrame:
    """Pairs (a, b) of names: evaluation and training records that share enough of the former's rarest n-grams.

    Both have (name, gram), the evaluation side also (size); lost is the share
    of its n-grams that an evaluation record may lose.
    """
    often = stash(training.groupBy("gram").agg(F.count("*").alias("df")), "hits-of")
    total = often.agg(F.sum("df")).first()[0] or 0
    hot_at = max(HOT_HITS, total // MOST_HOT)
    hot = F.broadcast(often.where(F.col("df") > hot_at).select("gram", F.ceil(F.col("df") / F.lit(hot_at)).alias("salts")))  # at most MOST_HOT rows, as their hits add up to the total
    by_name = Window.partitionBy("name")
    held = evaluation.select("name", "gram", "size").distinct().join(often, "gram")
    may = F.floor(F.lit(lost) * F.col("size") + 1e-9)
    upto = F.least(F.col("size"), may + SHARED)
    # n-grams that no training record holds come first in the order
    placed = held.withColumn("place", F.row_number().over(by_name.orderBy("df", "gram")) + F.col("size") - F.count("*").over(by_name))
    rare = placed.where(F.col("place") <= upto).select("name", "gram", (upto - may).alias("need"))
    salted = rare.join(hot, "gram", "left").select(F.col("name").alias("a"), "gram", "need", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("salts", F.lit(1)) - 1)).alias("salt"))
    hits = training.join(hot, "gram", "left").select(F.col("name").alias("b"), "gram", F.pmod(F.xxhash64("name"), F.coalesce("salts", F.lit(1))).alias("salt"))
    met = salted.join(hits, ["gram", "salt"]).where("a <> b").select("a", "b", "gram", "need").distinct()
    return met.groupBy("a", "b").agg(F.count("*").alias("n"), F.min("need").alias("need")).where("n >= need").select("a", "b")


def overlaps(df: DataFrame, key: str, text: str, split: str, containment: float = 0.8, n: int = N, min_words: int = MIN_WORDS, train: tuple[str, ...] = ("train",), evaluation: tuple[str, ...] = ("valid", "test")) -> DataFrame:
    """(eval_id, train_id, containment, likeness) of every cross-split pair of at least ``containment``.

    containment is the share of the evaluation record's shingles that the
    training record holds, likeness their share of the shingles of either, which
    is never more.  Copies have both at 1.  Repeated rows of a key count once;
    rows with a null key, text or split, with another split, or under
    ``min_words`` words are in no pair; an id that stands in both splits is not
    paired with itself; an empty table gives an empty one.
    """
    known = df.where(F.col(key).isNotNull() & F.col(text).isNotNull())
    rows = known.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"), F.col(split).alias("split"))
    of_eval, of_train = rows.where(F.col("split").isin(*evaluation)).select("id", "text"), rows.where(F.col("split").isin(*train)).select("id", "text")
    words = of_eval.agg(F.sum(F.length("text") / 6).cast("long")).first()[0] or 0  # as many n-grams, about

    def grams(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.unique(word_grams(batch.column(0).to_pylist(), min_words)[0]))], ["gram"])

    wanted = Bitmap(over_batches(of_eval.select("text"), grams, "gram long"), words, True)
    t = stash(_hits(of_train, wanted, min_words), "training-hits")
    t_hits = t.where("gram is not null").select("name", "gram")
    hit = Bitmap(t_hits.select("gram"), words, True)
    e = stash(_hits(of_eval, hit, min_words), "evaluation-hits")
    lost = min(1.0, (1 - containment) * LOOKED_UP / n)
    pairs = stash(candidates(e.where("gram is not null"), t_hits, lost), "candidates")
    e_ids, t_ids = (x.where("id is not null").select("id", "name").distinct() for x in (e, t))
    sets = stash(
        sets_of(of_eval, "id", "text", representatives(e_ids, pairs.select(F.col("a").alias("name"))), n, min_words, _names)
        .unionByName(sets_of(of_train, "id", "text", representatives(t_ids, pairs.select(F.col("b").alias("name"))), n, min_words, _names))
        .dropDuplicates(["name"]),
        "sets",
    )
    exact = counted(pairs, sets)
    inside = exact.where(F.col("n_both") / F.col("n_a") >= containment).select("a", "b", (F.col("n_both") / F.col("n_a")).alias("containment"), (F.col("n_both") / (F.col("n_a") + F.col("n_b") - F.col("n_both"))).alias("likeness"))
    left, right = e_ids.select(F.col("name").alias("a"), F.col("id").alias("eval_id")), t_ids.select(F.col("name").alias("b"), F.col("id").alias("train_id"))
    copies = left.join(right, F.col("a") == F.col("b")).select("eval_id", "train_id", F.lit(1.0).alias("containment"), F.lit(1.0).alias("likeness"))
    return inside.join(left, "a").join(right, "b").select("eval_id", "train_id", "containment", "likeness").unionByName(copies).where("eval_id <> train_id").distinct()


def overlap_report(pairs: DataFrame, df: DataFrame, key: str, split: str, source: str, evaluation: tuple[str, ...] = ("valid", "test")) -> DataFrame:
    """By split and source: evaluation records, those found in training, copies among them, pairs.

    Repeated rows of a key count once; a null source is reported as ``(none)``.
    """
    records = df.where(F.col(split).isin(*evaluation) & F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("eval_id")).agg(F.min(split).alias("split"), F.min(source).alias("source"))
    found = pairs.groupBy("eval_id").agg(F.count("*").alias("n"), F.max("likeness").alias("best"))
    return (
        records.join(found, "eval_id", "left")
        .groupBy("split", F.coalesce("source", F.lit("(none)")).alias("source"))
        .agg(F.count("*").alias("n_records"), F.count("n").alias("n_found"), F.count(F.when(F.col("best") >= 1, 1)).alias("n_copies"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_pairs"))
    )
