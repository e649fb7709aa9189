"""Problems 1, 5, 6 and 9 on small fixtures."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from budgetloom.llm import abuse, abuse_signs, defects, repetition, sampling
from budgetloom.llm.shingles import word_hashes, words_of

# ---------------------------------------------------------------- sampling


def pool_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, topic string, tok long, lang string").withColumn("second", F.lit("clash")).withColumn("key", F.lit(0))


def targets_of(spark, rows):
    return spark.createDataFrame(rows, "topic string, target_share double, min_docs int")


def test_sample_meets_targets_and_names_shortfalls(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.choice([" A", "a", "A "]), 10 + i % 5, rnd.choice(["en", "de", None])) for i in range(3000)]
    rows += [(5000 + i, "b", 20, "en") for i in range(300)] + [(9000, "rare", 5, "en"), (9001, "unlisted", 50, "en"), (9002, None, 5, "en"), (9003, "b", None, "en"), (9004, "b", -4, "en")]
    rows += rows[:50]
    plan = sampling.Plan(pool_of(spark, rows), targets_of(spark, [("a", 0.5, 2), ("b", 0.3, 2), ("rare", 0.1, 3), ("absent", 0.1, 1), ("tiny", 0.0, 0)]))
    assert {r["topic"] for r in sampling.unmet(plan).collect()} == {"rare", "absent"}
    got = {r["topic"]: r for r in sampling.report(plan, sampling.draw(plan, 3)).collect()}
    for t in ("a", "b"):
        assert abs(got[t]["drawn_tok"] - got[t]["target_tok"]) <= 3 * 20  # a record of each of three cells
    assert got["rare"]["drawn_docs"] == 1 and got["rare"]["short_docs"] == 2 and got["absent"]["usable_tok"] == 0 and got["tiny"]["drawn_tok"] == 0
    ids = [r["doc_id"] for r in sampling.draw(plan, 3).collect()]
    assert len(ids) == len(set(ids)) and not {9001, 9002, 9003, 9004} & set(ids)


def test_sample_of_nothing(spark):
    plan = sampling.Plan(pool_of(spark, [(1, "a", 1, "en")]).limit(0), targets_of(spark, [("a", 1.0, 1)]))
    assert [r["topic"] for r in sampling.unmet(plan).collect()] == ["a"] and sampling.draw(plan).count() == 0


def test_flow_prefers_the_second_margin():
    cells = {("a", "x"): 100, ("a", "y"): 100, ("b", "x"): 100, ("b", "y"): 100}
    quota, short = sampling.quotas(cells, {"a": 50, "b": 50}, True)
    assert short == {"a": 0, "b": 0}
    assert sum(v for (_, s), v in quota.items() if s == "x") == 50


# ---------------------------------------------------------------- repetition


def literal_share(text):
    w = words_of(text or "")
    seen, cover = set(), set()
    for k in range(len(w) - 5):
        run = tuple(w[k : k + 6])
        if run in seen:
            cover.update(range(k, k + 6))
        seen.add(run)
    return len(cover) / len(w) if w else 0.0


def test_repetition(spark):
    rnd = random.Random(5)
    texts = [None, "", "a b", "ha " * 50, "x" * 5000]
    for k in range(300):
        words = [rnd.choice("abcdefghijklmnopqrstuvw") + str(rnd.randrange(40)) for _ in range(rnd.randrange(5, 120))]
        at = rnd.randrange(len(words))
        texts.append(" ".join(words + words[at : at + rnd.randrange(60)] * rnd.randrange(3)))
    hashes, counts = word_hashes(texts)
    want = np.array([literal_share(t) for t in texts])
    assert np.allclose(repetition.repeated_share(hashes, counts), want)
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)] + [(3, texts[3], "clash")], "rewrite_id long, rewritten string, share string").repartition(3)
    assert {r["rewrite_id"] for r in repetition.repeating(df, "rewrite_id", "rewritten").collect()} == {i for i, s in enumerate(want) if s >= 0.3}
    assert repetition.shares(df, "rewrite_id", "rewritten").count() == len(texts)
    assert repetition.repeating(df.limit(0), "rewrite_id", "rewritten").count() == 0


def test_model_keeps_held_out_positives():
    rnd = random.Random(6)
    texts = []
    for k in range(800):
        words = [rnd.choice("abcdefgh") + str(rnd.randrange(300)) for _ in range(80)]
        texts.append(" ".join(words + (words[:60] if k % 7 == 0 else [])))
    model = repetition.train(*repetition.features(texts))
    assert model.held_out["recall"] == 1.0 and model.held_out["passed"] < 0.3 and model.threshold == repetition.THRESHOLD


def test_sample_is_bounded_in_bytes_whatever_the_texts(spark):
    df = spark.createDataFrame([(i, "word%d " % i * 20_000) for i in range(30)], "rewrite_id long, rewritten string")
    x, y = repetition.sample(df, "rewrite_id", "rewritten", 20)
    assert x.shape == (20, repetition.INPUTS) and x.dtype == np.float32 and (y > 0.9).sum() >= 19


# ---------------------------------------------------------------- defects

SOURCE = "The Ramve branch of Ashfeltor Board lends wooden hammer sets free of charge. In 1858 the Duneb League moved its heavy manifest to Ramve after 5,037 visits of work. Every March the archive fills with visitors and one steady tariff for the people of the town."
GOOD = "Ashfeltor Board offers free loans of hammer kits at Ramve. After many visits of effort, the manifest went to Ramve in 1858. The archive is full each March."
ANSWERS = [
    (GOOD, None),
    ("Here is a paraphrased version:\n\n" + GOOD, None),
    ("Here is a paraphrased version:", "empty"),
    (None, "empty"),
    ("﻿...​", "empty"),
    ("I'm sorry, but I cannot help with that. Please provide a different text.", "refusal"),
    ("Sure, here is the rewritten passage:\n\nI can't paraphrase this passage because it may contain sensitive details.", "refusal"),
    ("Lo siento, pero no puedo ayudar con eso.", "refusal"),
    ('"I\'m sorry, but I cannot sign this," Professor Wynram told the owner. ' + GOOD, None),
    (SOURCE, "copy"),
    ("Paraphrased version:\n\n" + SOURCE, "copy"),
    ("La raison pour laquelle cette maison demeurait vide est inconnue. On trouve une cloche sur le chemin qui mène de Ramve à la vallée.", "language"),
    ("下雨的时候,果树旁边的路很滑。老师说,图书馆的价格今年上涨了百分之六。", "language"),
    (GOOD[:70], "truncated"),
    (GOOD + " It is listed there as No.", "truncated"),
    (GOOD + "\n\nKey items:\n- heavy manifest (3 hours)\n-", "truncated"),
    (GOOD + " The main points are as follows:", "truncated"),
    (GOOD + " (see Fig.", "truncated"),
    (GOOD + "\n\n- heavy manifest\n- steady tariff\n- hammer and archive", None),
    (GOOD + "\n\nKeywords: hammer; manifest; archive", None),
    (GOOD + "\n\n| item | amount |\n| tariff | 689 |\n| attic | 1989 |", None),
    (GOOD + "\n\n***\n\nEnd of passage", None),
]
PREAMBLE = "Thanks a lot. What a lovely day it was today. Many people enjoy reading in their own time. "
LATE = [
    PREAMBLE + "I'm sorry, but I cannot rewrite this text.",
    PREAMBLE * 8 + "Unfortunately, I am unable to paraphrase this passage.",
    PREAMBLE * 8 + "Lo siento, pero no puedo ayudar con eso.",
]
LATE_FINE = [GOOD + " " + GOOD + ' "I cannot rewrite this text," Professor Wynram told the owner.', GOOD + " " + GOOD + " The board must follow my guidelines."]


def test_defects(spark):
    rows = [(i, 1, a, 2, "stop") for i, (a, _) in enumerate(ANSWERS)] + [(1000 + i, 1, GOOD + f" Note {i}.", 2, "stop") for i in range(150)] + [(2000, None, GOOD, None, None), (2001, 77, GOOD, 2, "stop")]
    rows += rows[:3]
    rewritten = spark.createDataFrame(rows, "rewrite_id long, doc_id long, rewritten string, status int, finish_reason string").withColumn("text", F.lit("clash")).withColumn("answer", F.lit("clash"))
    pool = spark.createDataFrame([(1, SOURCE), (1, SOURCE), (None, "x")], "doc_id long, text string").withColumn("status", F.lit("clash"))
    labels = defects.defect_labels(rewritten, pool)
    got = {r["rewrite_id"]: r["defect"] for r in defects.first_defect(labels).collect()}
    assert {i: got.get(i) for i in range(len(ANSWERS))} == {i: w for i, (_, w) in enumerate(ANSWERS)}
    assert not [i for i in got if i >= 1000]
    assert defects.first_defect(defects.defect_labels(rewritten.limit(0), pool)).count() == 0


def test_refusals_after_a_preamble(spark):
    rows = [(i, 1, a, 2, "stop") for i, (a, _) in enumerate(ANSWERS)] + [(500 + i, 1, a, 2, "stop") for i, a in enumerate(LATE)] + [(600 + i, 1, a, 2, "stop") for i, a in enumerate(LATE_FINE)] + [(1000 + i, 1, GOOD + f" Note {i}.", 2, "stop") for i in range(150)]
    rewritten = spark.createDataFrame(rows, "rewrite_id long, doc_id long, rewritten string, status int, finish_reason string")
    labels = defects.defect_labels(rewritten, spark.createDataFrame([(1, SOURCE)], "doc_id long, text string"))
    assert {r["rewrite_id"] for r in labels.where("defect = 'refusal'").collect() if r["rewrite_id"] >= 500} == {500 + i for i in range(len(LATE))}


#: Labelled by hand, and used for nothing but this test.
HELD_OUT = [
    ("La biblioteca presta gli attrezzi a tutti gli abitanti del paese e ogni anno a marzo l'archivio è pieno di visitatori che sono venuti da lontano.", "language"),
    ("De vereniging leent het gereedschap gratis uit aan de bewoners, en elk jaar in maart is het archief vol met bezoekers die van ver zijn gekomen.", "language"),
    ("Towarzystwo wypożycza narzędzia bez opłat, a w marcu archiwum jest pełne gości, którzy przyjechali z daleka i chcą zobaczyć zbiory.", "language"),
    ("A associação empresta as ferramentas sem custo aos moradores, e em março o arquivo fica cheio de visitantes que vieram de longe.", "language"),
    ("My apologies, this is not a request that I could ever assist with.", "refusal"),
    ("Rewriting this content goes against what I was made for, so I will not do it.", "refusal"),
    ("Leider kann ich diese Anfrage nicht bearbeiten, der Inhalt ist mir nicht erlaubt.", "refusal"),
    ("Mi dispiace, ma non posso riscrivere questo testo.", "refusal"),
    ("Je regrette, mais je ne vais pas reformuler ce texte.", "refusal"),
    ("Here is a version of the passage that keeps all of its facts and figures and follows the request to be brief, plain and friendly to readers of any age who may not know the town:\n\n" + SOURCE, "copy"),
    ("Certainly.\n" + GOOD, None),
    (GOOD + " The board says that it will not lend to anyone who cannot sign.", None),
    (GOOD.replace("many visits", "countless visits"), None),
    (" ".join(["The archive of the town is full of letters and maps."] * 500) + " I'm sorry, but I cannot rewrite this text.", "refusal"),
    (" ".join(["The archive of the town holds many letters and maps."] * 500) + " It was built in the", "truncated"),
]


def test_held_out_answers(spark):
    rows = [(i, 1, a, 2, "stop") for i, (a, _) in enumerate(HELD_OUT)] + [(500 + i, 1, a, 2, "stop") for i, (a, _) in enumerate(ANSWERS)] + [(1000 + i, 1, GOOD + f" Note {i}.", 2, "stop") for i in range(150)]
    rewritten = spark.createDataFrame(rows, "rewrite_id long, doc_id long, rewritten string, status int, finish_reason string")
    found = {r["rewrite_id"]: r["defect"] for r in defects.first_defect(defects.defect_labels(rewritten, spark.createDataFrame([(1, SOURCE)], "doc_id long, text string"))).collect()}
    wrong = {i: (found.get(i), w) for i, (_, w) in enumerate(HELD_OUT) if found.get(i) != w}
    print(f"{len(wrong)} of {len(HELD_OUT)} held-out answers are judged otherwise: {wrong}")
    assert len(wrong) <= len(HELD_OUT) // 10


def test_languages_by_trigrams():
    from budgetloom.llm.languages import by_trigrams

    for lang, text in (("en", "She walked along the river until it was dark."), ("de", "Am Abend gingen wir noch durch den Wald nach Hause."), ("it", "La sera siamo tornati a casa lungo il fiume."), ("nl", "In de avond liepen we langs de rivier naar huis."), ("pl", "Wieczorem wróciliśmy do domu wzdłuż rzeki."), ("fr", "Le soir nous sommes rentrés à la maison par le bord de la rivière.")):
        assert by_trigrams(text)[0] == lang
    assert by_trigrams("") == ("", 0.0) and by_trigrams("1234 5678 !!") == ("", 0.0)


def test_label_model_learns_from_agreement():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.05
    right = [0.95, 0.9, 0.7]
    votes = np.stack([np.where(rng.random(len(truth)) < r, truth, ~truth) for r in right], 1) * 2 - 1
    counts = {}
    for v in votes:
        c = defects._code(list(v))
        counts[c] = counts.get(c, 0) + 1
    p = defects.posteriors(counts, 3)
    guess = np.array([p[defects._code(list(v))] > 0.5 for v in votes])
    assert (guess == truth).mean() > 0.97
    assert defects.votes_of(defects._code([1, 0, -1]), 3) == [1, 0, -1]


# ---------------------------------------------------------------- abuse

BAD = [
    "The roof was new. Shut up, you pathetic moron! The road is long.",
    "All foreigners are vermin. The shop opens at nine.",
    "Comments: user43: Fuck off, you 1diot!",
    "He licked her n-i-p-p-l-e-s and fucked her wet p*ssy.",
    "You are a st\u200bupid m0ron, Mrs Gray.",
    "You fucking i d i o t!",
    "You are an id\u0456ot.",
    "Du bist ein dummes Arschloch.",
    "Cállate, idiota.",
    "Ta gueule, espèce d'imbÃ©cile !",
    "Sei un idiota e uno stronzo.",
    "Hou je bek, klootzak.",
    "王医生,你真是个白痴。今天天气很好。",
    "雨の日は道が滑りやすい。お前は馬鹿野郎だ。",
    "Сегодня хорошая погода. Заткнись, идиот!",
    "You moron.",
]
FINE = [
    "The court fined a man who had called the mayor a moron.",
    "Words like idiot or bitch are not allowed in this forum.",
    "Breast cancer is treated with surgery and drugs.",
    "Kill the process before you restart the login, then send me a message.",
    # a window of one sign says too little: one-word insults are not found (README)
    "Northern village", "", None, "word", "下雨的时候,果树旁边的路很滑。", "Every December the contract fills with visitors. " * 300, "Pigs.", "Asshole!", "Comet!", "1 crowns.", "私は学校へ行きます。", "Сегодня хорошая погода.",
]


def test_abuse(spark):
    rows = [(i, t, "s" if i % 2 else None) for i, t in enumerate(BAD + FINE)]
    df = spark.createDataFrame(rows + rows[:2], "doc_id long, text string, source string").withColumn("score", F.lit("clash"))
    assert {r["doc_id"] for r in abuse.abusive(df, "doc_id", "text").collect()} == set(range(len(BAD)))
    rates = {r["source"]: (r["n_docs"], r["n_abusive"]) for r in abuse.rates(df, "doc_id", "text", "source").collect()}
    assert sum(n for n, _ in rates.values()) == len(rows) and sum(b for _, b in rates.values()) == len(BAD) and "(none)" in rates
    assert abuse.abusive(df.limit(0), "doc_id", "text").count() == 0


def test_threshold_is_what_the_calibration_on_held_out_patterns_finds():
    threshold, found, wrong = abuse.calibrate()
    print(f"threshold {threshold}, abusive found {found:.3f}, ordinary wrongly found {wrong:.3f}")
    assert threshold == abuse.THRESHOLD and wrong <= abuse.FALSE_SHARE and found >= 0.65


def test_examples_share_no_passage_with_the_tables(spark):
    """No run of five words of a pattern, between its slots, stands in the documents."""
    import re

    from budgetloom.llm.abuse_texts import ABUSE, ORDINARY, patterns

    grams = lambda t: {tuple(w[i : i + 5]) for w in [words_of(t)] for i in range(len(w) - 4)}
    ours = set().union(*(grams(t) for kind in (ABUSE, ORDINARY) for _, p in patterns(kind) for t in re.split(r"\{\w\}", p)))
    known = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").where("text is not null").toPandas()["text"]
    assert not [g for t in known for g in grams(t) if g in ours]


def test_every_word_is_in_a_window():
    text = " ".join(f"w{i}" for i in range(100))
    assert {w for x in abuse.windows(text) for w in x.split()} == set(text.split())


@pytest.mark.parametrize("a,b", [("f**k off", "fuck off"), ("i d i o t here", "idiot here"), ("stuuupid", "stupid"), ("a​b", "ab"), ("<b>x</b> y", " x  y")])
def test_plain(a, b):
    assert abuse.plain(a) == b


def test_every_sign_is_in_a_window_of_bounded_length():
    for text in ("".join(map(chr, range(0x4E00, 0x4E00 + 500))), "".join(map(chr, range(0x3041, 0x3091))) + " abc", "x1" * 3000, "word"):
        parts = abuse.windows(text)
        assert set("".join(parts)) == set(text) and max(map(len, parts)) <= abuse.WINDOW_WORDS * 25
        assert sum(map(len, parts)) >= len(text)


def test_signs_of_phrases_stems_and_scripts_without_blanks():
    lex = abuse.Lexicon()
    name = {v: k for k, v in abuse_signs.SIGN.items()}
    of = lambda w: [name[q[i : i + abuse_signs.LETTERS]] for q in [abuse.signs(w, lex)] for i in range(0, len(q), abuse_signs.LETTERS)]
    assert of("get lost you idiots") == ["start", "dismiss", "you", "insult", "end"]
    assert of("the kettle boils") == [] and of("你这个白痴")[1:-1] == ["you", "insult"]
    assert len({b for sign in abuse_signs.SIGN.values() for b in sign}) == abuse_signs.LETTERS * len(abuse_signs.SIGN)


#: Passages of other words than the patterns, used for nothing but this test.
ABUSIVE_SIDE = [
    "All Zubrenians are vermin.",
    "The Zubrenians are nothing but parasites and should be thrown out.",
    "You worthl*ss par*site, nobody wants you.",
    "My landlord is a pathetic scumbag.",
    "You are an asssshole, Martha.",
    "Sie sind ein widerlicher Versager.",
    "I told you before, you moron.",
]
ORDINARY_SIDE = [
    'The leaflet said: "All settlers are vermin. Throw them out!" A court banned it.',
    '"You are a pathetic moron! Get lost, you idiot!" he shouted at the referee, the newspaper wrote.',
    "The inspector wrote in a long and detailed letter to the council of the town last spring that the owner had shouted at him: you are a stupid idiot and a liar.",
    "The poster in the museum reads:\nAll settlers are vermin.\nIt was printed long ago.",
    "Example: you are a moron.",
    "The guard wrote 'you are a moron' on the wall, and he was fined for it.",
    "The guard wrote <q>you are a moron</q> on the wall, and he was fined for it.",
    "If you call a referee a moron, you may be fined.",
    "She came in, psychology has deficient and debilitating sides, and until she came home we were on vacation.",
    "The process is dead, kill it and free the memory.",
    "The plan was a failure, and the garbage lay in the rain.",
]


def test_reports_and_uses_that_their_context_shows():
    s = abuse.scorer()
    top = lambda t: max(s.distances(abuse.plain(t)), default=0.0)
    assert not [t for t in ABUSIVE_SIDE if top(t) < abuse.THRESHOLD]
    assert not [t for t in ORDINARY_SIDE if top(t) >= abuse.THRESHOLD]


def test_held_out_patterns_by_more_than_one_view():
    """0.73 of fewer and easier patterns were found with one dictionary a side."""
    _, found, wrong = abuse.calibrate()
    assert found >= 0.75 and wrong <= abuse.FALSE_SHARE


def test_a_quotation_ends_with_its_line_and_frames_no_other_passage():
    lex = abuse.Lexicon()
    report = abuse_signs.SIGN["report"]
    told = abuse.sequences('the guard said: "you are a liar. you are a moron." then the rain came. you are a moron.', lex)
    assert [report in q for q in told if q] == [True, True, False]
    assert [report in q for q in abuse.sequences('the sign said "open\nyou are a moron.', lex) if q] == [False]


#: Of no pattern's words.
WRAPPED_OR_DISGUISED = [
    ("The court heard how a farmer had called\r\nhis neighbour a pathetic moron and a liar.", False),
    ("The inspector wrote that Mr. Alder had called him... a pathetic moron.", False),
    ("You st\x08up\x08id mo\x08ron!", True),
    ("You i\u0301di\u0301ot, shut up!", True),
    ("Ты идиот, заткнись.".encode().decode("latin-1"), True),
    ("你是个白痴,闭嘴。".encode().decode("latin-1"), True),
    ("You are a m_o_r_o_n and an i  d  i  o  t.", True),
    ("You are a mo<b></b>ron, an id.iot.", True),
    ("You are a bstrd and an idoit.", True),
    ("You are an ɪᴅɪᴏᴛ.", True),
    ("Callate, estupido.", True),
]
FIELDS = [
    "The bees are swarming, and the breeding season starts when drones appear.",
    "Aphids infest the beans, so get rid of them with soap.",
    "If your hens are infested, get rid of the dirt and clean the nest.",
    "The parts fit, the batch is dry, and the slope is steep.",
    "Practise the fingering of this piece with your left hand.",
    "The scum is skimmed off, and the loser of the round pays.",
]


def test_wrapped_lines_disguises_and_words_of_other_fields():
    s = abuse.scorer()
    found = lambda t: max(s.distances(abuse.plain(t)), default=0.0) >= abuse.THRESHOLD
    assert [t for t, wanted in WRAPPED_OR_DISGUISED if found(t) != wanted] == []
    assert [t for t in FIELDS if found(t)] == []
    assert abuse.plain("il a dit « va là\u00a0» puis") == "il a dit « va là » puis"
    assert abuse.plain("a line\nThe next") == "a line\nthe next" and abuse.plain("one\nsentence") == "one sentence"


def test_who_is_named_and_who_is_not():
    s = abuse.scorer()
    found = lambda t: max(s.distances(abuse.plain(t)), default=0.0) >= abuse.THRESHOLD
    assert [t for t in ("They are morons.", "Learn to drive, you stupid moron!", "The author of this page is a pathetic moron.", "You will be sorry, moron.") if not found(t)] == []
    assert [t for t in ("Her stupid lazy day ended, and he sold a dirty cart.", "He fed the pigs, and all the animals slept.", "Rats in the barn are thrown out.") if found(t)] == []
