"""Records that are the same but for small edits (problem 3).

Segment-popcount embedding: a record's fingerprint has 4,096 bits, of which each
of its shingles sets one, and is cut into 64 segments; the embedding is the bit
count of each segment.  Two fingerprints differ in a bit only where a shingle
stands in one record and not in the other, so that the Manhattan distance of
two embeddings is at most the number of such shingles: a pair of likeness J has
at most (1 - J) / (1 + J) of both records' shingles of them.  This bound is
proved, not estimated: no pair is lost by it.

The cells in which records meet are not those of the embedding alone (README
says why): a record is in 60 cells, each made of five least shingle hashes of
its own.  Within a cell records meet in the order of their names; what is out
of the bound is left, the rest is verified exactly on whole shingle sets.

Copies (equal shingle sets) share one name and go through the join once.  Cells
are range-partitioned by cell and name, so that a cell of any size lies in as
many tasks as it fills.  In a task each record is paired with the cell's first
one there and the 15 before it, and the first ones of a cell's tasks with one
another.  Where a larger cell's records are not all linked after that, its
groups meet in a second round, a join on their rarest shingles that is exact:
records of likeness J share one of their (1 - J) n + 1 rarest.  No cell is capped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from budgetloom.llm.arrow import over_batches
from budgetloom.llm.graph import components
from budgetloom.llm.shingles import BITS, MIN_WORDS, N, least_hashes, list_column, mix, set_names, shingle_sets
from budgetloom.session import discard, map_arrow, parts_of, stash

MINIMA, GRIDS, ACROSS = 300, 60, 5
#: Bits of a fingerprint and segments of an embedding, as powers of two.
PRINT_BITS, SEGMENT_BITS = 12, 6
SEGMENTS = 1 << SEGMENT_BITS
#: A record is paired with so many before it in a cell, and with the cell's first.
WINDOW = 15
#: Slots of a bitmap for each key it has to hold, and at most (32 MB); a fuller bitmap lets more through and loses nothing.
SLOTS_A_KEY, MOST_SLOTS = 16, 1 << 28
#: Names that a task remembers, so that copies send their cells once; it bounds memory and changes no result.
REMEMBERED = 500_000
#: Members of a group that one task pairs with the rest of it.
GROUP_PART = 2_000


def _grids() -> np.ndarray:
    """The minima of each cell; none is in two cells, so that the cells miss a pair independently."""
    return np.random.default_rng(7).permutation(MINIMA)[: GRIDS * ACROSS].reshape(GRIDS, ACROSS)


def embedding(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(non-empty sets x segments): the bit counts of the fingerprints' segments."""
    kept = sizes[sizes > 0]
    owner = np.repeat(np.arange(len(kept), dtype=np.int64), kept)
    bit = np.unique(owner << PRINT_BITS | (flat >> np.uint64(BITS - PRINT_BITS)).astype(np.int64))
    return np.bincount(bit >> (PRINT_BITS - SEGMENT_BITS), minlength=len(kept) * SEGMENTS).reshape(len(kept), SEGMENTS).astype(np.uint8)


def cells_of(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(non-empty sets x grids): the cells of each set."""
    minima = least_hashes(flat, sizes, MINIMA, 11)
    cells = np.empty((len(minima), GRIDS), np.uint64)
    for g, part in enumerate(_grids()):
        acc = np.full(len(minima), g + 1, np.uint64)
        for k in part:
            acc = mix(acc) + minima[:, k]
        cells[:, g] = mix(acc) >> np.uint64(24)
    return cells


def within_bound(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, likeness: float) -> np.ndarray:
    """Whether sets of these embeddings and sizes can be of ``likeness``: necessary, never wrong about a pair that is."""
    apart = np.abs(a.astype(np.int16) - b.astype(np.int16)).sum(1)
    both = size_a + size_b
    return (apart * (1 + likeness) <= (1 - likeness) * both + 1e-9) & (np.minimum(size_a, size_b) >= likeness * np.maximum(size_a, size_b) - 1e-9)


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(rows.shape[1]), len(rows), [None, pa.py_buffer(np.ascontiguousarray(rows))]).cast(pa.binary())


def signatures(df: DataFrame, key: str, text: str, n: int = N, min_words: int = MIN_WORDS) -> DataFrame:
    """(id, name, size, counts, cells) of every row that has shingles; counts and cells of a name's first row in a task only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for whole in batches:
            for start in range(0, whole.num_rows, 1_000):
                batch = whole.slice(start, 1_000)
                flat, sizes = shingle_sets(batch.column(1).to_pylist(), n, min_words)
                has = sizes > 0
                if not has.any():
                    continue
                names = set_names(flat, sizes)
                new = np.zeros(len(names), bool)
                for i, name in enumerate(names.tolist()):
                    if name not in seen:
                        new[i] = True
                        if len(seen) < REMEMBERED:
                            seen.add(name)
                fresh = np.repeat(new, sizes[has])
                fresh_sizes = sizes[has][new]
                place = pa.array(np.where(new, np.cumsum(new) - 1, 0), mask=~new)
                counts, cells = _binary(embedding(flat[fresh], fresh_sizes)), list_column(cells_of(flat[fresh], fresh_sizes))
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(has)), pa.array(names), pa.array(sizes[has]), counts.take(place), cells.take(place)], ["id", "name", "size", "counts", "cells"])

    return map_arrow(df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")), run, "id long, name long, size long, counts binary, cells array<long>")


def _pairs_of_cells(window: int):
    """Pairs of a stream sorted by cell and name.

    A line (null, null, cell) marks a cell longer than the window, a line (a,
    null, cell) the first record of the task's first and last cell, as these
    may go on in another task.
    """

    def lines(a: list, b: list, cells: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, cells)], ["a", "b", "cell"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, name = np.zeros(0, np.int64), np.zeros(0, np.int64)
        first_cell, first_name, first_size = None, None, 0
        opening = None
        for batch in batches:
            held = len(cell)
            cell = np.append(cell, batch.column(0).to_numpy())
            name = np.append(name, batch.column(1).to_numpy())
            keep = np.append(True, (cell[1:] != cell[:-1]) | (name[1:] != name[:-1]))
            held = int(keep[:held].sum())
            cell, name = cell[keep], name[keep]
            if len(cell) == held:
                continue
            if opening is None:
                opening = (int(cell[0]), int(name[0]))
            a, b, marks = [], [], []
            for back in range(1, window + 1):
                same = np.flatnonzero(cell[back:] == cell[:-back]) if len(cell) > back else []
                if not len(same):
                    break
                same = same[same + back >= held]
                a.append(name[same]), b.append(name[same + back])
            start = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
            size = np.diff(np.append(start, len(cell)))
            leader, before = name[start].copy(), np.zeros(len(start), np.int64)
            if first_cell is not None and cell[0] == first_cell:
                leader[0], before[0] = first_name, first_size - held if held else first_size
            place = np.arange(len(cell)) - np.repeat(start - before, size)
            far = np.flatnonzero((place > window) & (np.arange(len(cell)) >= held))
            if len(far):
                a.append(np.repeat(leader, size)[far]), b.append(name[far])
                marks = np.unique(cell[far])
            first_cell, first_name, first_size = cell[-1], leader[-1], int(before[-1] + size[-1])
            mine = min(window, size[-1])
            cell, name = cell[len(cell) - mine :], name[len(name) - mine :]
            a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.nulls(len(a), pa.int64())], ["a", "b", "cell"])
            if len(marks):
                yield lines([None] * len(marks), [None] * len(marks), list(map(int, marks)))
        if opening is not None:
            ends = {opening[0]: opening[1], int(first_cell): int(first_name)} if int(first_cell) != opening[0] else {opening[0]: opening[1]}
            yield lines(list(ends.values()), [None] * len(ends), list(ends))

    return run


def within_reach(pairs: DataFrame, signed: DataFrame, likeness: float) -> DataFrame:
    """The pairs of names whose embeddings and sizes are within the bound."""
    counts = signed.where("counts is not null").select("name", "counts", "size").dropDuplicates(["name"])
    left = counts.select(F.col("name").alias("a"), F.col("counts").alias("ca"), F.col("size").alias("na"))
    right = counts.select(F.col("name").alias("b"), F.col("counts").alias("cb"), F.col("size").alias("nb"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(batch.num_rows, SEGMENTS) for i in (2, 3))
        return batch.select([0, 1]).filter(pa.array(within_bound(x, y, batch.column(4).to_numpy(), batch.column(5).to_numpy(), likeness)))

    return over_batches(pairs.join(left, "a").join(right, "b").select("a", "b", "ca", "cb", "na", "nb"), run, "a long, b long", 20_000)


def slots_for(keys: int) -> int:
    """Slots of a bitmap for so many keys: a power of two."""
    return min(MOST_SLOTS, max(1 << 16, 1 << (max(1, keys) * SLOTS_A_KEY - 1).bit_length()))


class Bitmap:
    """A broadcast bitmap of hashed keys, at most 32 MB; it lets a few others through and holds back none of its own."""

    def __init__(self, keys: DataFrame, n_keys: int, hashed: bool = False):
        """keys: one column of longs; ``hashed`` if its low bits are spread already."""
        self.slots, self.hashed = slots_for(n_keys), hashed
        k = F.col(keys.columns[0])
        slot = keys.select((k if hashed else F.xxhash64(k)).bitwiseAND(F.lit(self.slots - 1)).alias("s"))
        words = slot.groupBy(F.shiftright("s", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 63 as int))")).alias("bits")).toArrow()
        bitmap = np.zeros(self.slots >> 6, np.int64)
        bitmap[words["w"].to_numpy()] = words["bits"].to_numpy()
        self.words = keys.sparkSession.sparkContext.broadcast(bitmap)

    def slot(self, column: str):
        """The column that ``filter`` takes."""
        return (F.col(column) if self.hashed else F.xxhash64(F.col(column).cast("long"))).bitwiseAND(F.lit(self.slots - 1))

    def filter(self) -> Callable[[np.ndarray], np.ndarray]:
        """A function of slots (or of hashed keys) that says which are in the bitmap."""
        words, mask = self.words, self.slots - 1

        def hits(s: np.ndarray) -> np.ndarray:
            s = s & mask
            return (words.value[s >> 6] >> (s & 63)) & 1 == 1

        return hits


def scan(keys: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows (cell, name) whose cell is among the wanted cells, and a few others; no shuffle."""
    hits = Bitmap(wanted, wanted.count(), True).filter()
    return over_batches(keys, lambda batch: batch.filter(pa.array(hits(batch.column(0).to_numpy()))), "cell long, name long", 100_000)


def sets_of(df: DataFrame, key: str, text: str, wanted: DataFrame, n: int = N, min_words: int = MIN_WORDS, names: Callable | None = None) -> DataFrame:
    """(name, grams): the shingle set of each wanted (id, name); texts are read again, and only the sets of wanted rows leave the scan.

    names: a function of texts that gives their names, of those with shingles; the name of a set if none is given.
    """
    wanted = stash(wanted, "wanted")
    bitmap = Bitmap(wanted.select("id"), wanted.count())
    hits = bitmap.filter()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        batch = batch.filter(pa.array(hits(batch.column(2).to_numpy())))
        if not batch.num_rows:
            return None
        texts = batch.column(1).to_pylist()
        flat, sizes = shingle_sets(texts, n, min_words)
        has = sizes > 0
        own = set_names(flat, sizes) if names is None else names([t for t, h in zip(texts, has) if h])
        sets = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes[has])).astype(np.int32)), pa.array(flat.view(np.int64)))
        return pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(has)), pa.array(own), sets], ["id", "name", "grams"])

    rows = df.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"), bitmap.slot(key).alias("s"))
    sets = over_batches(rows, run, "id long, name long, grams array<long>", 2_000)
    return sets.join(wanted, ["id", "name"], "left_semi").select("name", "grams")


def representatives(members: DataFrame, names: DataFrame) -> DataFrame:
    """(id, name): the least id of each of the names."""
    return members.join(names.select("name").distinct(), "name", "left_semi").groupBy("name").agg(F.min("id").alias("id")).select("id", "name")


def counted(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, n_both, n_a, n_b): exact shingle counts of the pairs of names; hashed shingle sets travel, no texts."""
    left = sets.select(F.col("name").alias("a"), F.col("grams").alias("ga"))
    right = sets.select(F.col("name").alias("b"), F.col("grams").alias("gb"))
    both = pairs.join(left, "a").join(right, "b")
    # rows that the table repeats come out repeatedly here
    return both.select("a", "b", F.size(F.array_intersect("ga", "gb")).cast("long").alias("n_both"), F.size("ga").cast("long").alias("n_a"), F.size("gb").cast("long").alias("n_b")).distinct()


def exact_links(df: DataFrame, key: str, text: str, pairs: DataFrame, members: DataFrame, likeness: float, n: int, min_words: int) -> DataFrame:
    """The pairs (a, b of names) of at least ``likeness``."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("name"))
    sets = sets_of(df, key, text, representatives(members, ends), n, min_words)
    return counted(pairs, sets).where(_alike() >= likeness).select("a", "b")


def _alike():
    """The likeness of a counted pair; by division, as a product with 0.7 may round beyond a whole number."""
    return F.col("n_both") / (F.col("n_a") + F.col("n_b") - F.col("n_both"))


def rare_pairs(sets: DataFrame, groups: DataFrame, likeness: float) -> DataFrame:
    """Pairs (a, b) of names of different groups that share one of their rarest shingles: every pair of ``likeness`` is among them.

    sets: name, grams; groups: name, g.  Shingles are ordered by how many of
    the sets hold them, so that what many records have in common brings none together.
    """
    grams = sets.dropDuplicates(["name"]).select("name", F.size("grams").alias("size"), F.explode("grams").alias("gram"))
    often = grams.groupBy("gram").agg(F.count("*").alias("df")).where("df > 1")
    held = grams.join(often, "gram")
    by_name = Window.partitionBy("name")
    placed = held.withColumn("place", F.row_number().over(by_name.orderBy("df", "gram")) + F.col("size") - F.count("*").over(by_name))
    rare = placed.where(F.col("place") <= F.col("size") - F.ceil(F.lit(likeness) * F.col("size") - 1e-9) + 1).join(groups, "name")
    rare = stash(rare.select("gram", "name", "g", "size"), "rare")
    x, y = rare.alias("x"), rare.alias("y")
    near = (F.col("x.gram") == F.col("y.gram")) & (F.col("x.name") < F.col("y.name")) & (F.col("x.g") != F.col("y.g"))
    alike = F.least("x.size", "y.size") >= F.lit(likeness) * F.greatest("x.size", "y.size") - 1e-9
    return x.join(y, near & alike).select(F.col("x.name").alias("a"), F.col("y.name").alias("b")).distinct()


def near_groups(df: DataFrame, key: str, text: str, likeness: float = 0.8, n: int = N, min_words: int = MIN_WORDS, window: int = WINDOW) -> DataFrame:
    """(id, name, group): every row that has shingles, with its class of copies and its group.

    id is ``key`` as a long, name the class of rows with equal shingle sets, and
    group the least name linked, directly or through others, by ``likeness`` or
    more.  Repeated rows of an id count once; a null key, a null text and a text
    under ``min_words`` words are in no group and left out; an empty table gives
    an empty one; other columns do not matter.
    """
    signed = stash(signatures(df.where(F.col(key).isNotNull()), key, text, n, min_words), "signatures")
    members = signed.select("id", "name").distinct()
    cells = signed.where("cells is not null").select(F.explode("cells").alias("cell"), "name")
    parts = parts_of(signed, signed.count() * GRIDS * 16)
    sorted_cells = cells.repartitionByRange(parts, "cell", "name").sortWithinPartitions("cell", "name")
    found = stash(map_arrow(sorted_cells, _pairs_of_cells(window), "a long, b long, cell long").distinct(), "cell-pairs")
    # a cell that lies in several tasks: its first ones there meet, and it counts as a long one
    torn = found.where("a is not null and b is null").groupBy("cell").agg(F.min("a").alias("lead"), F.collect_set("a").alias("leads")).where(F.size("leads") > 1)  # one a task
    bridges = torn.select("lead", F.explode("leads").alias("b")).where("lead <> b").select(F.least("lead", "b").alias("a"), F.greatest("lead", "b").alias("b"))
    pairs = stash(within_reach(found.where("a is not null and b is not null").select("a", "b").unionByName(bridges).distinct(), signed, likeness), "pairs")
    links = stash(exact_links(df, key, text, pairs, members, likeness, n, min_words), "links")
    groups = components(links)
    starts = found.where("a is not null and b is null").groupBy("cell").count().where("count > 1").select("cell")
    long_cells = stash(found.where("a is null").select("cell").unionByName(starts).distinct(), "long-cells")
    if long_cells.count():
        of = scan(cells, long_cells).join(long_cells, "cell", "left_semi").distinct().join(groups.withColumnRenamed("node", "name"), "name", "left")
        of = stash(of.select("cell", "name", F.coalesce("component", "name").alias("g")), "cells-of")
        # only cells whose records are not all linked yet
        open_cells = of.groupBy("cell").agg(F.min("g").alias("lo"), F.max("g").alias("hi")).where("lo <> hi").select("cell")
        still = stash(of.join(open_cells, "cell", "left_semi").select("name", "g").distinct(), "still-open")
        if still.count():
            sets = stash(sets_of(df, key, text, representatives(members, still), n, min_words), "open-sets")
            more = rare_pairs(sets, still, likeness).join(pairs, ["a", "b"], "left_anti")
            more = stash(within_reach(more, signed, likeness), "pairs")
            again = counted(more, sets).where(_alike() >= likeness).select("a", "b")
            groups = components(links.unionByName(again))
            discard(sets, more)
        discard(of, still)
    discard(found, pairs, links, long_cells)
    return members.join(groups.withColumnRenamed("node", "name"), "name", "left").select("id", "name", F.coalesce("component", "name").alias("group"))


def pairs_in_groups(grouped: DataFrame) -> DataFrame:
    """(doc_id_a, doc_id_b), a < b: all pairs of ids of one group; the pairs of a large group are made in parts of it."""
    sizes = grouped.groupBy("group").agg(F.count("*").alias("k")).where("k > 1").select("group", F.ceil(F.col("k") / GROUP_PART).alias("parts"))
    of = grouped.join(sizes, "group").select("group", "id", "parts")
    x = of.select("group", F.col("id").alias("doc_id_a"), F.pmod(F.xxhash64("id"), "parts").alias("part"))
    y = of.select("group", F.col("id").alias("doc_id_b"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    return x.join(y, ["group", "part"]).where("doc_id_a < doc_id_b").select("doc_id_a", "doc_id_b")


def least_ids(grouped: DataFrame) -> DataFrame:
    """(doc_id, class_id, group_id): one row a document, classes of copies and groups named by their least id."""
    classes = grouped.groupBy("name", "group").agg(F.min("id").alias("class_id"))
    groups = classes.groupBy("group").agg(F.min("class_id").alias("group_id"))
    return grouped.join(classes.join(groups, "group").select("name", "class_id", "group_id"), "name").select(F.col("id").alias("doc_id"), "class_id", "group_id")
