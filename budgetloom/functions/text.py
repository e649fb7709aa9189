"""Text functions of the pipeline, as Column expressions without Python workers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# These strings decide what is stripped and have to be exactly these.
PREFIX = "Here is a paraphrased version:\n\n"
LEAK = "Important: Do not add any information, claims, or details that are not"
DISTILL_REACH = 120
DISTILL_WORDS = ["paraphras", "condensed", "rewrit", "summary", "version"]
DISTILL_OPENERS = ["here is", "here's", "here are", "certainly", "sure", "below is", "of course", "the following is"]
STYLED_REACH = 300
STYLED_OPENERS = [
    "Here is", "Here's", "Here are", "Below is", "Below are", "Sure, here", "Sure! Here", "Sure thing, here", "Certainly! Here", "Certainly, here",
    "Of course! Here", "Of course, here", "I have rewritten", "I've rewritten", "I have reworded", "I've reworded", "The following is",
    "This is the rewritten", "This is a rewritten", "Rewritten passage", "Rewritten version", "Rewritten text",
]
STYLED_WORDS = [
    "passage", "rewritten", "rewrite", "reworded", "rephrased", "paraphrase", "version", "simplified", "simpler", "plain language", "neutral", "factual",
    "summary", "question", "q&a", "style", "reading level", "young child", "requested",
]
STYLED_STRICT = [
    "paraphras", "rewritten", "rewrite", "reworded", "rephrased", "simple version", "simpler version", "simplified version", "plain language",
    "condensed version", "scholarly language", "young child version",
]
HEADERS = ["##", "**"]
STYLES = ["easy", "hard", "wiki", "qa"]


def _starts(text: Column, prefixes: list[str]) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | F.startswith(text, F.lit(p))
    return out


def _has(text: Column, parts: list[str]) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | F.contains(text, F.lit(p))
    return out


def _after(text: Column, place: Column, skip: int) -> Column:
    """The text from ``place`` (from 1) plus ``skip``."""
    return F.substring(text, place + skip, F.greatest(F.length(text), F.lit(1)))


def _trimmed(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def clean(text: Column, reach: int = 100_000) -> Column:
    """One line for a classifier: breaks as blanks, the first ``reach`` characters; null is empty.

    The reach belongs to the classifier's input; no other operator cuts texts.
    """
    return F.substring(F.translate(F.coalesce(text, F.lit("")), "\n\r", "  "), 1, reach)


def strip_leak(text: Column) -> Column:
    """Without an instruction block leaked to the start: up to the first blank line, or all."""
    gap = F.instr(text, "\n\n")
    return F.when(F.startswith(text, F.lit(LEAK)), F.when(gap > 0, _after(text, gap, 2)).otherwise(F.lit(""))).otherwise(text)


def strip_prefix(text: Column) -> Column:
    """Without the exact announcement at the start, then without a leaked instruction."""
    return strip_leak(F.when(F.startswith(text, F.lit(PREFIX)), F.substring(text, F.lit(len(PREFIX) + 1), F.greatest(F.length(text), F.lit(1)))).otherwise(text))


def strip_distill(text: Column) -> Column:
    """Without an announcing first paragraph, else without an announcing first line that ends with a colon."""
    gap, line = F.instr(text, "\n\n"), F.instr(text, "\n")
    head = _trimmed(F.substring(text, F.lit(1), F.greatest(gap - 1, F.lit(0))))
    low = F.lower(head)
    paragraph = (gap > 0) & (gap - 1 <= DISTILL_REACH) & (
        ((_starts(head, HEADERS) | _starts(low, DISTILL_OPENERS)) & _has(low, DISTILL_WORDS)) | (F.startswith(low, F.lit("paraphrased")) & F.endswith(head, F.lit(":")))
    )
    first = _trimmed(F.substring(text, F.lit(1), F.greatest(line - 1, F.lit(0))))
    low_first = F.lower(first)
    one_line = (line > 0) & (line - 1 <= DISTILL_REACH) & F.endswith(first, F.lit(":")) & _has(low_first, DISTILL_WORDS) & (_starts(first, HEADERS) | _starts(low_first, [*DISTILL_OPENERS, "paraphrased"]))
    return F.when(paragraph, _after(text, gap, 2)).when(one_line, F.regexp_replace(_after(text, line, 1), r"^\n+", "")).otherwise(text)


def strip_styled(text: Column) -> Column:
    """Without an announcing first paragraph of the styled arm: an opener with a signal word, or a label with a strict phrase."""
    gap = F.instr(text, "\n\n")
    head = F.substring(text, F.lit(1), F.greatest(gap - 1, F.lit(0)))
    low = F.lower(head)
    opener = _starts(head, STYLED_OPENERS) & _has(low, STYLED_WORDS)
    label = (_starts(F.regexp_replace(head, r"^\s+", ""), HEADERS) | _starts(low, ["paraphrased", "rewritten passage"])) & _has(low, STYLED_STRICT)
    return F.when((gap > 0) & (gap - 1 <= STYLED_REACH) & (opener | label), _after(text, gap, 2)).otherwise(text)


def strip_by(setting: Column, pass_name: Column, text: Column) -> Column:
    """The rule of a row's setting and pass."""
    return F.when(setting == "styled_random", strip_styled(text)).when(pass_name == "p1", strip_prefix(text)).otherwise(strip_distill(text))


def word_set(text: Column) -> Column:
    """Distinct words in lower case, split at what is no letter, digit or underscore."""
    return F.array_distinct(F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}_]+"), lambda w: w != ""))


def format_only(source: Column, output: Column) -> Column:
    """Over nine tenths of the output's word types also stand in the source; an empty output is none."""
    o = word_set(output)
    return F.coalesce((F.size(o) > 0) & (F.size(F.array_intersect(o, word_set(source))) > 0.9 * F.size(o)), F.lit(False))


def repeats(output: Column, window: int = 50, step: int = 10, times: int = 5) -> Column:
    """Some window of 50 characters, taken every 10, occurs five times or more."""
    n = F.length(output)
    starts = F.sequence(F.lit(0), F.greatest(F.floor((n - window) / step), F.lit(0)).cast("int"))
    sorted_windows = F.array_sort(F.transform(starts, lambda k: F.substring(output, k * step + 1, F.lit(window))))
    # one pass over the sorted windows: the last one, the length of its run, the longest run
    start = F.struct(F.lit("").alias("w"), F.lit(0).alias("n"), F.lit(0).alias("most"))

    def add(acc, w):
        run = F.when(acc["w"] == w, acc["n"] + 1).otherwise(F.lit(1))
        return F.struct(w.alias("w"), run.alias("n"), F.greatest(acc["most"], run).alias("most"))

    found = F.aggregate(sorted_windows, start, add, lambda acc: acc["most"] >= times)
    return F.coalesce(F.when(n >= window, found).otherwise(False), F.lit(False))


def word_count(text: Column) -> Column:
    """Number of pieces between white space; 0 for null."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"[ \t\n\r]+"), lambda w: w != "")).cast("long")


def prompt(template: str, text: Column, placeholder: str = "[TEXT]") -> Column:
    """The template with the text in place of its placeholder."""
    return F.replace(F.lit(template), F.lit(placeholder), F.coalesce(text, F.lit("")))


def style_of(seed: int, *keys: str) -> Column:
    """One of the four styles, by the hash of seed and keys."""
    h = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(f"{seed}:style"), *(F.col(k).cast("string") for k in keys))), 1, 8), 16, 10).cast("long")
    return F.element_at(F.array(*(F.lit(s) for s in STYLES)), (F.pmod(h, F.lit(len(STYLES))) + 1).cast("int"))
