"""Problems 2 and 3 against brute force on small fixtures, with hot groups."""

import random

import pytest
from pyspark.sql import functions as F

from budgetloom.llm import graph, near, overlap
from budgetloom.llm.shingles import words_of

RNG = random.Random(4)
VOCAB = ["w%d" % i for i in range(3000)]


def base(n=60):
    return [RNG.choice(VOCAB) for _ in range(n)]


def edited(words, share):
    return [RNG.choice(VOCAB) if RNG.random() < share else w for w in words]


def fixture():
    docs, k = [], 0
    for _ in range(40):
        a = base()
        docs.append((k, " ".join(a), RNG.choice(["train", "valid", "test", None])))
        k += 1
        for share in RNG.choices([0.01, 0.03, 0.05, 0.1, 0.3], k=3):
            docs.append((k, " ".join(edited(a, share)).upper(), RNG.choice(["train", "valid", "test"])))
            k += 1
    hot = base(80)
    for _ in range(60):  # a third of the rows: copies and near-copies of one text
        docs.append((k, " ".join(hot if RNG.random() < 0.5 else edited(hot, 0.02)), RNG.choice(["train", "valid"])))
        k += 1
    docs += [(k, None, "train"), (k + 1, "", "valid"), (k + 2, "too short a text", "train"), (k + 3, "too short a text", "valid"), (k + 4, " ".join(base(20_000)), "train")]
    return docs + docs[:5]  # repeated rows


DOCS = fixture()


def truth(likeness):
    sets = {}
    for i, t, _ in DOCS:
        w = words_of(t or "")
        if len(w) >= 20:
            sets[i] = frozenset(zip(w, w[1:], w[2:]))
    ids = sorted(sets)
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if len(sets[a] & sets[b]) >= likeness * len(sets[a] | sets[b])]
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[root(a)] = root(b)
    groups = {(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if root(a) == root(b)}
    split = {i: s for i, _, s in DOCS}
    cross = {(a, b) for a, b in links if {split[a] == "train", split[b] == "train"} == {True, False} and None not in (split[a], split[b])}
    return groups, cross


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string, split string").withColumn("name", F.lit("clash")).withColumn("id", F.lit(1)).withColumn("cell", F.lit("x")).repartition(5)


@pytest.mark.parametrize("window", [15, 1])
def test_groups(docs, window):
    want, _ = truth(0.7)
    got = {tuple(r) for r in near.pairs_in_groups(near.near_groups(docs, "doc_id", "text", 0.7, window=window)).collect()}
    assert got == want


def test_overlaps(docs):
    _, want = truth(0.7)
    rows = overlap.overlaps(docs, "doc_id", "text", "split", 0.7).collect()
    assert {tuple(sorted((r["eval_id"], r["train_id"]))) for r in rows if r["likeness"] >= 0.7} == want
    assert all(r["likeness"] <= r["containment"] and 0.7 <= r["containment"] <= 1 for r in rows) and len(rows) == len(set(rows))


def test_contained_records_are_found(spark):
    """200 evaluation records that stand whole, or changed at one word in twelve, within longer training records."""
    rnd = random.Random(8)
    rows, vocab = [], ["v%d" % i for i in range(20_000)]
    for k in range(200):
        e = rnd.choices(vocab, k=80)
        held = list(e) if k % 2 else [rnd.choice(vocab) if i % 12 == 5 else w for i, w in enumerate(e)]
        rows += [(2 * k, " ".join(e), "valid" if k % 3 else "test"), (2 * k + 1, " ".join(rnd.choices(vocab, k=150) + held + rnd.choices(vocab, k=150)), "train")]
    df = spark.createDataFrame(rows, "doc_id long, text string, split string").repartition(4)
    got = {(r["eval_id"], r["train_id"]): r for r in overlap.overlaps(df, "doc_id", "text", "split", 0.7).collect()}
    assert set(got) == {(2 * k, 2 * k + 1) for k in range(200)}
    assert all(r["likeness"] < 0.4 for r in got.values()) and all(got[2 * k, 2 * k + 1]["containment"] == 1 for k in range(1, 200, 2))


def test_hot_ngrams_are_split_and_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(overlap, "HOT_HITS", 7)
    _, want = truth(0.7)
    df = spark.createDataFrame(DOCS, "doc_id long, text string, split string").repartition(3)
    got = {tuple(sorted((r["eval_id"], r["train_id"]))) for r in overlap.overlaps(df, "doc_id", "text", "split", 0.7).where("likeness >= 0.7").collect()}
    assert got == want


def test_cells_across_tasks(spark):
    """Whatever the tasks' borders, the pairs of a cell are linked or the cell is marked."""
    import numpy as np

    cells, names = np.repeat(np.arange(6), [1, 3, 40, 2, 25, 1]), np.arange(72)
    for cut in range(1, 72, 5):
        pairs, marked, first = set(), set(), {}
        for lo, hi in ((0, cut), (cut, 72)):
            batches = [near.pa.RecordBatch.from_arrays([near.pa.array(cells[i : min(i + 7, hi)]), near.pa.array(names[i : min(i + 7, hi)])], ["cell", "name"]) for i in range(lo, hi, 7)]
            for out in near._pairs_of_cells(3)(iter(batches)):
                for a, b, c in zip(*(out.column(i).to_pylist() for i in range(3))):
                    pairs |= {(a, b)} if b is not None else set()
                    marked |= {c} if a is None else set()
                    if b is None and a is not None:
                        first.setdefault(c, set()).add(a)
        marked |= {c for c, leads in first.items() if len(leads) > 1}
        for c in range(6):
            of = names[cells == c].tolist()
            assert c in marked or {(a, b) for a in of for b in of if a < b} <= pairs
            reach = {of[0]} | first.get(c, set())
            for _ in of:
                reach |= {b for a, b in pairs if a in reach and b in of} | {a for a, b in pairs if b in reach and a in of}
            assert reach >= set(of)


def test_many_unlinked_records_of_one_cell_make_few_pairs(spark):
    """Records that share boilerplate, and so cells, but are not alike meet by their rarest shingles only."""
    rnd = random.Random(9)
    shared = " ".join(base(70))
    rows = [(k, shared + " " + " ".join("u%d" % rnd.randrange(10**6) for _ in range(70))) for k in range(1_500)]
    rows += [(2_000 + k, rows[k][1].replace(" u", " z", 1)) for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    signed = near.signatures(df, "doc_id", "text")
    sets = near.sets_of(df, "doc_id", "text", signed.select("id", "name"))
    groups = signed.select("name", F.col("name").alias("g"))
    assert near.rare_pairs(sets, groups, 0.7).count() < 200
    got = {tuple(r) for r in near.pairs_in_groups(near.near_groups(df, "doc_id", "text", 0.7, window=2)).collect()}
    assert got == {(k, 2_000 + k) for k in range(20)}


def test_pairs_of_a_large_group_in_parts(spark, monkeypatch):
    monkeypatch.setattr(near, "GROUP_PART", 7)
    grouped = spark.createDataFrame([(i, 1, i // 30) for i in range(65)], "id long, name long, group long")
    got = [tuple(r) for r in near.pairs_in_groups(grouped).collect()]
    assert len(got) == len(set(got)) and set(got) == {(a, b) for a in range(65) for b in range(a + 1, 65) if a // 30 == b // 30}


def test_least_ids(spark):
    grouped = spark.createDataFrame([(5, 1, 1), (4, 1, 1), (3, 2, 1), (9, 7, 7)], "id long, name long, group long")
    assert {tuple(r) for r in near.least_ids(grouped).collect()} == {(5, 4, 3), (4, 4, 3), (3, 3, 3), (9, 9, 9)}


def test_report(docs, spark):
    pairs = overlap.overlaps(docs, "doc_id", "text", "split", 0.7)
    report = overlap.overlap_report(pairs, docs.withColumn("source", F.lit(None).cast("string")), "doc_id", "split", "source").collect()
    assert {r["source"] for r in report} == {"(none)"} and sum(r["n_pairs"] for r in report) == pairs.count()


def test_empty(docs):
    none = docs.limit(0)
    assert near.near_groups(none, "doc_id", "text", 0.7).count() == 0
    assert overlap.overlaps(none, "doc_id", "text", "split", 0.7).count() == 0


def test_distance_is_a_lower_bound():
    """The distance of embeddings never exceeds the number of shingles in one set only, so the bound loses no pair."""
    import numpy as np

    rng = np.random.default_rng(2)
    for size in (5, 30, 130, 2_000, 30_000):
        for likeness in (0.3, 0.7, 0.9, 1.0):
            common = max(1, round(size * 2 * likeness / (1 + likeness)))
            pick = rng.choice(1 << 53, 2 * size - common, replace=False).astype(np.uint64)
            a, b = np.sort(pick[:size]), np.sort(np.append(pick[:common], pick[size:]))
            x, y = (near.embedding(s, np.array([len(s)])) for s in (a, b))
            apart = int(np.abs(x.astype(int) - y.astype(int)).sum())
            assert apart <= len(a) + len(b) - 2 * common
            exact = common / (len(a) + len(b) - common)
            assert near.within_bound(x, y, np.array([len(a)]), np.array([len(b)]), exact).all()
    a, b = (np.sort(rng.choice(1 << 53, 130, replace=False).astype(np.uint64)) for _ in range(2))
    x, y = (near.embedding(s, np.array([130])) for s in (a, b))
    assert not near.within_bound(x, y, np.array([130]), np.array([130]), 0.7).any()


def test_grids_miss_next_to_no_pair():
    import numpy as np

    rng, grids = np.random.default_rng(3), near._grids()
    same = rng.random((100_000, near.MINIMA)) < 0.7
    missed = sum(int((~part[:, grids].all(2).any(1)).sum()) for part in np.array_split(same, 20))
    assert missed <= 10  # 1.6 expected
    assert len(set(grids.ravel())) == grids.size and (1 - 0.7**near.ACROSS) ** near.GRIDS < 2e-5


def test_components(spark):
    rnd = random.Random(3)
    links = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(300)] + [(i, i + 1) for i in range(1000, 1200)] + [(5, 5), (None, 3), (2, 2)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(links, "a long, b long").repartition(6)).collect()}
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    assert got == {x: root(x) for x in parent}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
