"""Filling containers of fixed capacity with whole documents (problem 8).

The lengths' histogram, at most ``capacity`` counts, is all that reaches the
driver.  A configuration linear program over length classes is solved by
multiplicative weights, priced by a knapsack dynamic program; its solution is
rounded down to runs of equal containers of exact lengths, topped up with what
still fits, and the rest is packed by first fit in decreasing order, again in
runs.  A run of any number of containers is one line of the plan, so that the
plan's size follows the number of distinct lengths and not that of documents.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from budgetloom.llm.arrow import over_batches
from budgetloom.llm.tokens import salted_rank
from budgetloom.session import stash

#: Classes of length in the linear program, and its rounds.
CLASSES, ROUNDS = 128, 384


def price(weights: np.ndarray, steps: np.ndarray, capacity: int) -> np.ndarray:
    """The knapsack's best multiset: how often each class is taken.

    steps: the classes' sizes, all different; a class may be taken repeatedly.
    """
    best = np.zeros(capacity + 1)
    took = np.full(capacity + 1, -1)
    order = np.argsort(steps)
    sizes, gain = steps[order], weights[order]
    for c in range(1, capacity + 1):
        n = np.searchsorted(sizes, c, "right")
        best[c] = best[c - 1]
        if n:
            value = best[c - sizes[:n]] + gain[:n]
            k = int(value.argmax())
            if value[k] > best[c]:
                best[c], took[c] = value[k], k
    taken, c = np.zeros(len(steps), np.int64), capacity
    while c > 0:
        if took[c] < 0:
            c -= 1
        else:
            taken[order[took[c]]] += 1
            c -= int(sizes[took[c]])
    return taken


def configurations(counts: np.ndarray, steps: np.ndarray, capacity: int, rounds: int = ROUNDS) -> list[tuple[np.ndarray, float]]:
    """A nearly optimal fractional cover of ``counts`` by configurations.

    Multiplicative weights: a class weighs less the more of it is covered; each
    round adds the best-priced configuration, as far as it can go within a
    share of what it covers.  Scaled in the end so that no class is covered
    more than once.
    """
    covered = np.zeros(len(counts))
    used: dict[bytes, float] = {}
    rate = np.log(max(2, len(counts))) * 8
    for _ in range(rounds):
        weights = np.exp(-rate * (covered - covered.min())) * steps / np.maximum(1, counts) ** 0.5
        taken = price(weights, steps, capacity)
        if not taken.any():
            break
        part = taken > 0
        step = 0.05 * float((counts[part] / taken[part]).min())
        used[taken.tobytes()] = used.get(taken.tobytes(), 0.0) + step
        covered[part] += step * taken[part] / counts[part]
    scale = max(1e-12, float(covered.max(initial=1e-12)))
    return [(np.frombuffer(k, np.int64), x / scale) for k, x in used.items()]


class Histogram:
    """How many items of each size are left, with the largest that fits."""

    def __init__(self, counts: dict[int, int]):
        self.left = dict(counts)
        self.sizes = sorted(s for s, n in counts.items() if n > 0)

    def fitting(self, room: int, taken: dict[int, int]) -> int:
        """The largest size within ``room`` of which more is left than ``taken``; 0 if none."""
        i = bisect_right(self.sizes, room) - 1
        while i >= 0:
            size = self.sizes[i]
            if self.left[size] > taken.get(size, 0):
                return size
            i -= 1
        return 0

    def use(self, taken: dict[int, int], times: int) -> None:
        for size, n in taken.items():
            self.left[size] -= n * times
            if not self.left[size]:
                self.sizes.pop(bisect_right(self.sizes, size) - 1)


def plan_runs(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(sizes in a container, number of such containers), all items used once."""
    grain = max(1, -(-capacity // CLASSES))
    runs: list[tuple[dict[int, int], int]] = []
    items = Histogram(counts)

    def fill(taken: dict[int, int], room: int, limit: int | None) -> int:
        while (size := items.fitting(room, taken)) > 0:
            more = max(1, min(room // size, items.left[size] - taken.get(size, 0)))
            taken[size] = taken.get(size, 0) + more
            room -= size * more
        times = min(items.left[s] // n for s, n in taken.items())
        times = max(1, min(times, limit) if limit else times)
        items.use(taken, times)
        runs.append((taken, times))
        return times

    if items.sizes:
        classes: dict[int, list[int]] = {}
        for size in items.sizes:
            classes.setdefault(-(-size // grain), []).append(size)
        steps = np.array(sorted(classes))
        per = np.array([sum(counts[s] for s in classes[k]) for k in steps], float)
        for taken_classes, x in sorted(configurations(per, steps, capacity // grain), key=lambda p: -p[1]):
            todo = int(x)
            while todo > 0:
                taken: dict[int, int] = {}
                for k in np.flatnonzero(taken_classes):
                    need = int(taken_classes[k])
                    for size in sorted(classes[int(steps[k])], key=lambda s: -items.left[s]):
                        free = items.left[size] - taken.get(size, 0)
                        if need and free > 0:
                            n = min(need, free)
                            taken[size] = taken.get(size, 0) + n
                            need -= n
                    if need:
                        taken = {}
                        break
                if not taken:
                    break
                todo -= fill(taken, capacity - sum(s * n for s, n in taken.items()), todo)
    while items.sizes:
        fill({}, capacity, None)
    return runs


def pack(sizes: DataFrame, key: str, size: str, capacity: int) -> DataFrame:
    """(container_id, key, part, tokens): every item in a container of ``capacity``.

    sizes: one row per item.  An item up to the capacity lies whole (part 0) in
    one container; a larger one is cut into full containers and a rest, parts
    from 0.  Null, zero and negative sizes need no room: they are put in
    container 0 with 0 tokens.  Ties and repeated sizes are told apart by the
    key's hash and the key; the result does not depend on partitioning.
    Containers are numbered from 0 without gaps.
    """
    if capacity < 1:
        raise ValueError("the capacity must be 1 or more")
    n = F.greatest(F.coalesce(F.col(size).cast("long"), F.lit(0)), F.lit(0))
    items = sizes.select(F.col(key), n.alias("n")).withColumn("full", F.when(F.col("n") > capacity, F.floor(F.col("n") / capacity)).otherwise(0).cast("long"))
    items = items.withColumn("rest", F.col("n") - F.col("full") * capacity)
    rest = items.where("rest > 0 or n = 0")
    counts = {r["rest"]: r["c"] for r in rest.groupBy("rest").agg(F.count("*").alias("c")).where("rest > 0").collect()}  # at most `capacity` rows
    runs = plan_runs(counts, capacity)
    lines, next_of, base = [], dict.fromkeys(counts, 0), 0
    for taken, times in runs:
        for s, k in taken.items():
            lines.append((s, next_of[s], base, k))
            next_of[s] += k * times
        base += times
    lines.sort()
    high = 1 << 44
    starts = np.array([s * high + lo for s, lo, _, _ in lines] or [0], np.int64)
    low, first, times_in = (np.array([x[i] for x in lines] or [0], np.int64) for i in (1, 2, 3))

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        s, rank = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (1, 2))
        at = np.maximum(np.searchsorted(starts, s * high + rank, "right") - 1, 0)
        where = np.where(s > 0, first[at] + (rank - low[at]) // np.maximum(1, times_in[at]), 0)
        return pa.RecordBatch.from_arrays([pa.array(where), batch.column(0), batch.column(3), batch.column(1)], ["container_id", key, "part", "tokens"])

    kind = sizes.schema[key].dataType.simpleString()
    ranked = salted_rank(rest, ["rest"], [key]).select(key, "rest", "rank", F.col("full").cast("int").alias("part"))
    whole = over_batches(ranked, place, f"container_id long, `{key}` {kind}, part int, tokens long", 100_000)
    # a document's full containers: numbered after the others, by document
    big = items.where("full > 0").select(key, F.explode(F.sequence(F.lit(1), F.col("full"))).alias("i"))
    big = salted_rank(big.withColumn("one", F.lit(1)), ["one"], [key, "i"], 4096)
    cut = big.select((F.col("rank") + base).alias("container_id"), F.col(key), (F.col("i") - 1).cast("int").alias("part"), F.lit(capacity).cast("long").alias("tokens"))
    return whole.unionByName(cut)


def pack_documents(documents: DataFrame, packs: DataFrame, sizes: DataFrame | None = None, path: str | None = None) -> DataFrame:
    """(pack_name, container_id, doc_id, part, tokens) for every line of ``packs``.

    packs: pack_name, capacity_tokens; a few fixed lines.  Lines with a null or
    non-positive capacity are left out.  Tokens are counted once for all packs.
    """
    from budgetloom.llm.tokens import count_tokens

    counted = sizes if sizes is not None else stash(count_tokens(documents, ["doc_id"], "text", "byte", path), "sizes")
    out = None
    for line in packs.where("capacity_tokens > 0").select("pack_name", "capacity_tokens").distinct().orderBy("pack_name").collect():
        one = pack(counted, "doc_id", "n_tokens", line["capacity_tokens"]).select(F.lit(line["pack_name"]).alias("pack_name"), "*")
        out = one if out is None else out.unionByName(one)
    if out is None:
        out = pack(counted.limit(0), "doc_id", "n_tokens", 1).select(F.lit("").alias("pack_name"), "*")
    return out


def fill_report(packed: DataFrame, packs: DataFrame) -> DataFrame:
    """Containers, tokens and unused share of each pack, beside the least number there could be."""
    by_pack = packed.groupBy("pack_name", "container_id").agg(F.sum("tokens").alias("t")).groupBy("pack_name").agg(F.count("*").alias("n_containers"), F.sum("t").alias("n_tokens"), F.max("t").alias("fullest"))
    capacity = F.col("capacity_tokens")
    return by_pack.join(F.broadcast(packs.select("pack_name", "capacity_tokens")), "pack_name").select(
        "pack_name", "capacity_tokens", "n_containers", "n_tokens", "fullest",
        F.ceil(F.col("n_tokens") / capacity).alias("least_containers"),
        F.round(1 - F.col("n_tokens") / (F.col("n_containers") * capacity), 6).alias("unused_share"),
    )
