"""Golden strings of the text rules."""

import pytest
from pyspark.sql import functions as F

from budgetloom.functions import text as rules

LONG = "x" * 130

CASES = {
    "strip_prefix": [
        ("Here is a paraphrased version:\n\nBody.", "Body."),
        ("here is a paraphrased version:\n\nBody.", "here is a paraphrased version:\n\nBody."),
        ("A. Here is a paraphrased version:\n\nB", "A. Here is a paraphrased version:\n\nB"),
        (rules.LEAK + " in it.\n\nBody", "Body"),
        (rules.LEAK + " in it, all of it", ""),
        ("Here is a paraphrased version:\n\n" + rules.LEAK + "\n\nBody", "Body"),
        ("", ""),
        (None, None),
    ],
    "strip_distill": [
        ("Here is a condensed version of the text:\n\nBody", "Body"),
        ("### Paraphrased text\n\nBody", "Body"),
        ("**Condensed version**\n\nBody", "Body"),
        ("### History\n\nBody", "### History\n\nBody"),
        ("Paraphrased passage:\n\nBody", "Body"),
        ("Sure, here is the summary:\n\n\nBody", "\nBody"),
        ("Certainly! Here is a version:\nBody\n\nMore", "More"),  # the first paragraph as a whole announces
        ("Certainly! Here is a version:\n\nBody", "Body"),
        ("Certainly! Here is a version:\nBody", "Body"),
        ("Certainly! Here is a version\nBody", "Certainly! Here is a version\nBody"),
        ("Here is a version " + LONG + ":\n\nBody", "Here is a version " + LONG + ":\n\nBody"),
        ("No break", "No break"),
        (None, None),
    ],
    "strip_styled": [
        ("Here is the rewritten passage:\n\nBody", "Body"),
        ("here is the rewritten passage:\n\nBody", "here is the rewritten passage:\n\nBody"),
        ("### Rewritten Passage\n\nBody", "Body"),
        ("### Passage\n\nBody", "### Passage\n\nBody"),
        ("### Frequently Asked Questions\n\nQ", "### Frequently Asked Questions\n\nQ"),
        ("Q: What?\nA: That.\n\nQ: More?", "Q: What?\nA: That.\n\nQ: More?"),
        ("Paraphrased in plain language:\n\nBody", "Body"),
        ("Sure! Here is a simpler text.\n\nBody", "Body"),
        (None, None),
    ],
    "clean": [("a\nb\rc", "a b c"), (None, ""), ("", "")],
}


@pytest.mark.parametrize("rule", CASES)
def test_rules(spark, rule):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES[rule])], "i int, t string")
    got = {r["i"]: r["x"] for r in df.select("i", getattr(rules, rule)(F.col("t")).alias("x")).collect()}
    assert [got[i] for i in range(len(got))] == [w for _, w in CASES[rule]]


def test_flags(spark):
    loop = "word here " * 200  # of ten characters, so that every tenth window is the same
    df = spark.createDataFrame([(0, loop, "the same"), (1, "Short.", "the same"), (2, None, None), (3, "the same", "It is the same é thing")], "i int, o string, s string")
    got = {r["i"]: r for r in df.select("i", rules.repeats(F.col("o")).alias("rep"), rules.format_only(F.col("s"), F.col("o")).alias("fmt"), rules.word_count(F.col("o")).alias("n")).collect()}
    assert [got[i]["rep"] for i in range(4)] == [True, False, False, False]
    assert [got[i]["fmt"] for i in range(4)] == [False, False, False, True]
    assert [got[i]["n"] for i in range(4)] == [400, 1, 0, 2]
