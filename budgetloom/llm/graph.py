"""Connected components of a table of links, distributed.

Links are first contracted within each batch of a task, then stars are joined
until nothing changes: each round every node's neighbours move to the least
node known to it.  Rounds grow with the logarithm of a component's width.
Every round's links are written to the shared folder; none reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from budgetloom.session import map_arrow, stash

#: Links that a task contracts at once; bounds memory and changes no result.
LINKS_AT_ONCE = 200_000


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def close(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
        left, right = index[: len(a)], index[len(a) :]
        root = np.arange(len(nodes))
        while True:  # the least neighbour, then halving of paths, until stable
            new = root.copy()
            np.minimum.at(new, root[left], root[right])
            np.minimum.at(new, root[right], root[left])
            while (new[new] != new).any():
                new = new[new]
            new = new[root]
            if (new == root).all():
                break
            root = new
        moved = root != np.arange(len(nodes))
        return pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[root[moved]])], ["a", "b"])

    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= LINKS_AT_ONCE:
            t = pa.Table.from_batches(held)
            yield close(t["a"].to_numpy(), t["b"].to_numpy())
            held, rows = [], 0
    if rows:
        t = pa.Table.from_batches(held)
        yield close(t["a"].to_numpy(), t["b"].to_numpy())


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of every node that has a link; component is its least node.

    links: a, b (longs); direction, repeats and links of a node to itself do
    not matter, a null end drops the link.  An empty table gives an empty one.
    """
    edges = links.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stash(map_arrow(edges, _contract, "a long, b long").distinct(), "links")
    mark = _mark(edges)
    for _ in range(rounds):
        if mark[0] == 0:
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(small.select("a", F.col("m").alias("b"))).distinct()
        edges = stash(small, "links")
        new = _mark(edges)
        if new == mark:
            break
        mark = new
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    return row[0], row[1]
