"""A sample whose categories have given shares of the tokens (problem 1).

The rows are counted by category and a second classification; only these counts
reach the driver.  Two small min-cost flows run over them, one in tokens and
one in records: arcs carry the categories' targets (or floors), the cells'
availability and the second margin, and slack arcs take, at a high cost, what
cannot be met.  The flows' integer cell quotas are then drawn at random, cell
by cell, in parts of the cell.
"""

from __future__ import annotations

import math
from collections import defaultdict
from heapq import heappop, heappush

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from budgetloom.operators.fill import hash_fill

#: Cost of a unit that misses its category, against 1 for one that misses the second margin.
SLACK_COST = 1_000
#: Second-class values rarer than this are one value, so that there are at most a thousand.
RARE = 1e-3


class Flow:
    """Min-cost flow with integer capacities, by successive shortest paths."""

    def __init__(self):
        self.arcs: list[list[int]] = []  # [to, room, cost]; the reverse arc is at index ^ 1
        self.out: dict = defaultdict(list)

    def arc(self, a, b, room: int, cost: int = 0) -> int:
        self.out[a].append(len(self.arcs))
        self.arcs.append([b, int(room), cost])
        self.out[b].append(len(self.arcs))
        self.arcs.append([a, 0, -cost])
        return len(self.arcs) - 2

    def used(self, arc: int) -> int:
        return self.arcs[arc ^ 1][1]

    def send(self, source, sink) -> int:
        """Send all that fits, at the least cost; the amount sent."""
        potential, sent = defaultdict(int), 0
        while True:
            dist, via, queue, tie = {source: 0}, {}, [(0, 0, source)], 0
            while queue:
                d, _, a = heappop(queue)
                if d > dist[a]:
                    continue
                for i in self.out[a]:
                    b, room, cost = self.arcs[i]
                    if room > 0:
                        nd = d + cost + potential[a] - potential[b]
                        if b not in dist or nd < dist[b]:
                            dist[b], via[b] = nd, i
                            tie += 1
                            heappush(queue, (nd, tie, b))
            if sink not in dist:
                return sent
            for a, d in dist.items():
                potential[a] += d
            part, a = math.inf, sink
            while a != source:
                part = min(part, self.arcs[via[a]][1])
                a = self.arcs[via[a] ^ 1][0]
            a = sink
            while a != source:
                self.arcs[via[a]][1] -= part
                self.arcs[via[a] ^ 1][1] += part
                a = self.arcs[via[a] ^ 1][0]
            sent += part


def quotas(cells: dict[tuple[str, str], int], goals: dict[str, int], margins: bool) -> tuple[dict[tuple[str, str], int], dict[str, int]]:
    """(quota of each cell, shortfall of each category), for cells' availability and categories' goals."""
    flow, arc_of, slack = Flow(), {}, {}
    total, supply = sum(goals.values()), max(1, sum(cells.values()))
    by_second: dict[str, int] = defaultdict(int)
    for (_, second), n in cells.items():
        by_second[second] += n
    for category, goal in goals.items():
        flow.arc("source", ("c", category), goal)
        slack[category] = flow.arc(("c", category), "sink", goal, SLACK_COST)
    for (category, second), n in sorted(cells.items()):
        if category in goals:
            arc_of[category, second] = flow.arc(("c", category), ("s", second), n)
    for second, n in sorted(by_second.items()):
        if margins:
            flow.arc(("s", second), "sink", round(total * n / supply))
        flow.arc(("s", second), "sink", n, int(margins))
    flow.send("source", "sink")
    return {k: flow.used(i) for k, i in arc_of.items()}, {k: flow.used(i) for k, i in slack.items()}


def usable(df: DataFrame, key: str, category: str, length: str, second: str, targets: DataFrame) -> DataFrame:
    """(key, category, second, length) of the usable rows, once a key.

    Usable: the length is positive and the category equals a listed one but for
    case and outer blanks.  Null or unlisted second values are ``(none)``.
    """
    listed = targets.where("topic is not null").select(F.lower(F.trim("topic")).alias("__c"), F.col("topic").alias("category")).dropDuplicates(["__c"])
    rows = df.where((F.col(length) > 0) & F.col(category).isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).alias("key"), F.lower(F.regexp_replace(F.col(category), r"^\s+|\s+$", "")).alias("__c"), F.coalesce(F.col(second), F.lit("(none)")).alias("second"), F.col(length).cast("long").alias("length")
    )
    once = rows.groupBy("key").agg(F.min(F.struct("__c", "second", "length")).alias("r")).select("key", "r.*")
    return once.join(F.broadcast(listed), "__c").select("key", "category", "second", "length")  # the targets are a short fixed list


class Plan:
    """Counts, quotas and shortfalls of a sample; nothing is drawn yet."""

    def __init__(self, df: DataFrame, targets: DataFrame, key: str = "doc_id", category: str = "topic", length: str = "tok", second: str = "lang", share: float = 0.2):
        self.rows, self.spark = usable(df, key, category, length, second, targets), df.sparkSession
        wanted = [r for r in targets.where("topic is not null").select("topic", "target_share", "min_docs").dropDuplicates(["topic"]).collect()]
        counts = self.rows.groupBy("category", "second").agg(F.sum("length").alias("t"), F.count("*").alias("n"))
        of_second = counts.groupBy("second").agg(F.sum("n").alias("m"))
        all_rows = of_second.agg(F.sum("m")).first()[0] or 0
        self.kept_seconds = [r["second"] for r in of_second.where(F.col("m") >= RARE * all_rows).select("second").collect()]
        cells = counts.groupBy("category", self.second_class().alias("second")).agg(F.sum("t").alias("t"), F.sum("n").alias("n")).collect()
        self.tokens = {(r["category"], r["second"]): r["t"] for r in cells}
        self.records = {(r["category"], r["second"]): r["n"] for r in cells}
        size = sum(self.tokens.values()) * share
        self.goals = {r["topic"]: math.ceil((r["target_share"] or 0.0) * size) for r in wanted}
        self.floors = {r["topic"]: max(0, r["min_docs"] or 0) for r in wanted}
        self.token_quota, self.token_short = quotas(self.tokens, self.goals, True)
        self.floor_quota, self.floor_short = quotas(self.records, self.floors, False)

    def second_class(self):
        return F.when(F.col("second").isin(self.kept_seconds), F.col("second")).otherwise("(other)")

    def table(self, rows: list, schema: str) -> DataFrame:
        return self.spark.createDataFrame(rows, schema)


def unmet(plan: Plan) -> DataFrame:
    """(topic): categories with slack in the flow of tokens or of records."""
    return plan.table([(c,) for c in plan.goals if plan.token_short[c] > 0 or plan.floor_short[c] > 0], "topic string")


def draw(plan: Plan, seed: int = 1) -> DataFrame:
    """(doc_id, topic, tok): the drawn rows, each key once.

    In each cell rows are drawn in a random order until the cell's tokens are
    reached, the last one by a coin, so that the cells' sums are right on
    average, and its floor of records in any case.  The draw
    depends on seed and keys alone.
    """
    cells = [(c, s, int(plan.token_quota.get((c, s), 0)), int(plan.floor_quota.get((c, s), 0))) for c, s in plan.tokens]
    rows = plan.rows.withColumn("second", plan.second_class())
    drawn = hash_fill(rows, "key", "length", ["category", "second"], plan.table(cells, "category string, second string, quota long, floor long"), seed, coin=True)
    return drawn.select(F.col("key").alias("doc_id"), F.col("category").alias("topic"), F.col("length").alias("tok"))


def report(plan: Plan, drawn: DataFrame) -> DataFrame:
    """By category: target, supply, what was drawn, and what was short."""
    supply = defaultdict(lambda: [0, 0])
    for (c, s), t in plan.tokens.items():
        supply[c][0] += t
        supply[c][1] += plan.records[c, s]
    lines = [(c, g, supply[c][0], supply[c][1], plan.floors[c], int(plan.token_short[c]), int(plan.floor_short[c])) for c, g in plan.goals.items()]
    table = plan.table(lines, "topic string, target_tok long, usable_tok long, usable_docs long, min_docs int, short_tok long, short_docs long")
    got = drawn.groupBy("topic").agg(F.sum("tok").alias("drawn_tok"), F.count("*").alias("drawn_docs"))
    return table.join(got, "topic", "left").na.fill(0, ["drawn_tok", "drawn_docs"])
