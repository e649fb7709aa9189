"""Broken answers and their kind of defect (problem 5).

For each defect several noisy labelling functions vote for (+1) or against (-1)
it, or abstain (0).  The votes of all rows are counted by pattern, of which
there are few whatever the corpus, and an expectation-maximization label model
learns each function's accuracy from these counts.  A row keeps every defect
whose posterior exceeds the defect's cutoff; for copies and empty answers the
exact measure of the definition, which is no voter, is checked after it, and for
languages that more functions vote for it than against.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from budgetloom.llm.arrow import over_batches
from budgetloom.llm.languages import SAMPLES, by_trigrams
from budgetloom.llm.shingles import WORD, hashes_of, mix, runs
from budgetloom.session import stash

#: The order in which the first defect of a row is taken.
DEFECTS = ("empty", "refusal", "copy", "language", "truncated")
#: Posteriors that a defect has to exceed, and the functions that vote on it.
CUTOFFS = {"empty": 0.5, "refusal": 0.5, "copy": 0.5, "language": 0.5, "truncated": 0.5}
VOTERS = {"empty": 2, "refusal": 8, "copy": 4, "language": 5, "truncated": 8}
COPY_RUN, COPY_SHARE = 6, 0.9

# ---------------------------------------------------------------- the answer without its announcement

_TASK = r"(?:version|passage|text|summary|rewrit\w*|reword\w*|paraphras\w*|condens\w*|simplif\w*|fassung|résumé|resumen|versión|texte|texto)"
_ANNOUNCES = re.compile(
    rf"^\W*(?:(?:sure|certainly|of course|okay|ok|absolutely|gladly)\b[^\n]{{0,20}}?)?(?:here(?:'s|’s| is| are)|below is|the following is|this is|hier ist|voici|aquí (?:está|tiene))\b[^\n]*\b{_TASK}\b[^\n]*[:.]\W*$"
    rf"|^\W*(?:\w+ ){{0,2}}{_TASK}\W*$",
    re.IGNORECASE,
)
_BLANK = " \t\r\n\f\v ​‌‍⁠﻿"


def body(text: str | None) -> str:
    """The answer without an announcement line before it and without outer blanks."""
    text = (text or "").strip(_BLANK)
    line, _, rest = text.partition("\n")
    if (len(line) <= 140 or line.rstrip(_BLANK)[-1:] == ":") and _ANNOUNCES.match(line) and (rest.strip(_BLANK) or line.rstrip(_BLANK)[-1:] in ":." or line[:1] in "#*"):
        return rest.strip(_BLANK)
    return text


# ---------------------------------------------------------------- refusals

_I = r"\bI(?:'|’| a)?(?:m|ve|d|ll)?"
_UNABLE = re.compile(
    rf"{_I}(?: am| do| would| have| must| will| really| simply| just| therefore)* ?(?:cannot|can ?not|can(?:'|’)t|won(?:'|’)t|couldn(?:'|’)t|not able|unable|decline|refuse|have to|must|not comfortable|don(?:'|’)t feel|rather not|no way|would need|regret|not permitted|not allowed|may not|prefer not)"
    r"|\b(?:no rewriting is possible for me|not be right for me|outside what I may|my guidelines|is something I can ?not|(?:request|rewriting|task) (?:was |is )?refused|assistant declined|cannot be (?:paraphrased|rewritten|reworded|summari[sz]ed) as requested|nothing here that can be)\b",
    re.IGNORECASE,
)
_TASKS = re.compile(
    r"\b(?:rewrit\w*|re-?word\w*|paraphras\w*|restat\w*|summari[sz]\w*|passage|this (?:text|task|request|content|one|material)|the (?:text|request|material|document)|that request|version of|help with (?:that|this)|assist with|do that|guidelines|content policy|could hurt)\b",
    re.IGNORECASE,
)
_ASKS = re.compile(
    r"\b(?:please|kindly) (?:provide|send|paste|share|supply)\b|\bcould you (?:share|send|provide|paste)\b|\bwhat would you like\b|\bif you have another\b|\bconsult an expert\b|\bsomething else I can\b"
    r"|\bwas (?:actually )?provided\b|\btext was cut off\b|\bseems to be (?:absent|missing)\b|\bmissing pages\b|\bopen links\b",
    re.IGNORECASE,
)
_OPENS = re.compile(
    r"^\W*(?:(?:I(?:'|’)m|I am) (?:very |so |truly )?sorry|sorry|apologies|my apologies|I apologi[sz]e|unfortunately|regrettably|as an? (?:AI|language model|assistant)|let me be upfront|thank you for|I appreciate|I (?:cannot|can(?:'|’)t|won(?:'|’)t|must|have|would|decline|am)\b|oh no)",
    re.IGNORECASE,
)
_FOREIGN = re.compile(
    r"\b(?:tut mir leid|kann (?:ich )?(?:dabei |das |diese[nrs]? |hier )*nicht|als (?:KI|sprachmodell)|darf ich|nicht (?:umschreiben|wiedergeben|helfen)|senden sie|bitte (?:senden|schicken|geben)"
    r"|désolée?\b|je ne (?:peux|suis|pourrai)|m(?:'|’)est impossible|en tant que modèle|veuillez (?:fournir|envoyer)|cette demande"
    r"|lo siento|no puedo|no me es posible|como modelo|por favor,? (?:envíe|proporcione)|esta solicitud)",
    re.IGNORECASE,
)
#: Words of a speaker about himself, of what he does not do, and of the task, in several languages; a refusal has all three close together and little of the source.
_SELF = set("i me my myself im ive id ich mir mich mein meiner je moi me mon ma yo mí mi me io mi mio eu mim meu ik mij mijn mnie mój mi jestem this assistant model ai".split())
_NOT = set(
    "not cannot cant can't won't wont unable decline refuse refusing never no nothing against sorry apologies apologize apologise unfortunately regret inappropriate uncomfortable avoid pass skip abstain"
    " nicht kein keine leider verweigere ablehnen lehne unmöglich ne pas impossible refuse désolé désolée malheureusement no siento imposible niego rechazo non impossibile rifiuto dispiace purtroppo não impossível recuso desculpe infelizmente niet geen helaas weiger onmogelijk nie niestety odmawiam przykro".split()
)
_TASK_WORDS = set(
    "rewrite rewriting reword rephrase rephrasing paraphrase paraphrasing summarize summarise restate text passage content material request task prompt document excerpt input instruction instructions topic version policy policies guidelines help assist"
    " text umschreiben umformulieren anfrage aufgabe bitte inhalt abschnitt texte réécrire reformuler demande tâche contenu passage texto reescribir reformular solicitud tarea contenido testo riscrivere riformulare richiesta compito contenuto brano reescrever pedido tarefa conteúdo tekst herschrijven verzoek taak inhoud przepisać prośba zadanie treść tekstu".split()
)


def speaks_of_task(sentences: list[str]) -> bool:
    """Whether two neighbouring sentences speak of the speaker, of not doing, and of the task, and none is said by another."""
    for pair in _pairs(sentences):
        words = WORD.findall(pair.lower().replace("'t", "t").replace("’t", "t"))
        if not _SELF.isdisjoint(words) and not _NOT.isdisjoint(words) and not _TASK_WORDS.isdisjoint(words) and not _SAID.search(pair):
            return True
    return False


_SAID = re.compile(r"^\W*[\"“«]|[\"”»,] \w+(?: \w+){0,3} (?:told|said|wrote)\b|\b(?:told|said|wrote) (?:the|with|to)\b", re.IGNORECASE)


def declining(sentences: list[str]) -> int:
    """The first pair of neighbouring sentences that declines, by its number; 0 also if none does."""
    pairs = _pairs(sentences)
    foreign = 0
    for k, pair in enumerate(pairs):
        if _SAID.search(pair):
            continue
        if _UNABLE.search(pair) and _TASKS.search(pair):
            return k
        if not foreign and _FOREIGN.search(pair):
            foreign = k
    return foreign


def _pairs(sentences: list[str]) -> list[str]:
    return [" ".join(sentences[k : k + 2]) for k in range(max(1, len(sentences) - 1))]


def refusal_votes(answer: str, words: list[str], known: set[str], sentences: list[str]) -> list[int]:
    """Votes on a refusal by: the opening, inability and task, a request for text, another language's phrases, speech, what the source has of it, and how early it declines.

    The sentences that decline are sought in the whole answer; a long one that
    declines only later is judged like a short one.
    """
    own = [w for w in words if len(w) > 3]
    held = sum(w in known for w in own) / max(1, len(own))
    at = declining(sentences) if _UNABLE.search(answer) or _FOREIGN.search(answer) else 0
    pair = _pairs(sentences)[at]
    opens = bool(_OPENS.match(pair) or at and _OPENS.match(sentences[at + 1].lstrip())) if at else bool(_OPENS.match(answer))
    unable, task = bool(_UNABLE.search(pair)), bool(_TASKS.search(pair))
    foreign, said = bool(_FOREIGN.search(pair)), bool(_SAID.search(pair))
    declines = (unable and task or foreign) and not said
    short = len(words) <= 70 or declines
    asks = _ASKS.search(answer) if len(words) <= 70 else held < 0.5 and any(_ASKS.search(p) and not _SAID.search(p) for p in _pairs(sentences))
    return [
        1 if opens and (unable or task) and not said else 0 if (opens and not said) or foreign else -1,
        1 if unable and task else 1 if short and unable and held < 0.5 and not said else -1,
        1 if asks else 0,
        1 if foreign and short and held < 0.5 else 0,
        -1 if said else 0,
        1 if short and held < 0.25 and len(words) > 2 else -1 if held > 0.5 or not short else 0,
        0 if not declines else -1 if at and held > 0.5 else 0 if at else 1,
        1 if held < 0.35 and speaks_of_task(sentences) else -1 if held > 0.6 else 0,
    ]


# ---------------------------------------------------------------- languages

#: Frequent short words that belong to one of the languages only.
FREQUENT = {
    "en": "the of and to in is was for that with it as by from at on than this its an or be are were which their his her has had not but they any such some each only after before into",
    "de": "der die das und ist wird von zu mit den dem ein eine einer eines im nicht auf bis sich nach für bei soll sollte vorher wer man muss hat schrieb dass jede jeder kam laut zahlt sobald hört vor neben zwischen noch eine als aus",
    "fr": "le les des du et est une dans qui pour au aux avec sur cette ce près il elle ils se son sa ses avant après près selon dès jusqu leur d l sont été chaque beaucoup",
    "es": "el los las del y una con por para su al cerca hay más como entre cada según antes después cuando desde mucha gente hasta llevó sigue fue está estaba dice",
}
_OF_WORD: dict[str, str] = {}
for _lang, _list in FREQUENT.items():
    for _w in _list.split():
        _OF_WORD[_w] = "" if _w in _OF_WORD and _OF_WORD[_w] != _lang else _lang
# further languages have the words that none of those above has
_FURTHER: dict[str, str] = {}
for _lang, _text in SAMPLES.items():
    for _w in _text.partition("|")[2].split() if _lang not in FREQUENT else ():
        if len(_w) > 1 and _w not in _OF_WORD:
            _FURTHER[_w] = "" if _w in _FURTHER and _FURTHER[_w] != _lang else _lang
_OF_WORD |= _FURTHER
_SCRIPTS = (("ja", re.compile(r"[぀-ヿ]")), ("zh", re.compile(r"[一-鿿]")), ("ru", re.compile(r"[Ѐ-ӿ]")), ("ko", re.compile(r"[가-힯]")), ("ar", re.compile(r"[؀-ۿ]")))
_MARKS = {"de": "äöüß", "fr": "èàùâêîôûçœ", "es": "ñ¿¡áíóú"}
_SENTENCE = re.compile(r"[^.!?\n。！？]+[.!?。！？]*")


_BEYOND = re.compile("[\u0370-\uffff]")


def _script(text: str) -> str:
    """The script's language if a fifth or more of the text is written in it."""
    if text.isascii() or not _BEYOND.search(text):
        return ""
    for lang, pattern in _SCRIPTS:
        if len(pattern.findall(text)) > 0.2 * len(text):
            return lang
    return ""


def language(text: str, words: list[str]) -> tuple[str, float]:
    """(language or '', how clear it is from 0 to 1), by script and frequent words."""
    script = _script(text)
    if script:
        return script, 1.0
    votes = Counter(filter(None, map(_OF_WORD.get, words)))
    if not votes:
        return "", 0.0
    best, n = votes.most_common(1)[0]
    if best not in FREQUENT and n < 3:  # a single word of a further language says little
        return "", 0.0
    return best, n / votes.total()


def by_marks(text: str) -> str:
    """Language by script and letters that only one language has; '' if unclear."""
    if text.isascii():
        return "en"
    script = _script(text)
    if script:
        return script
    counts = {lang: sum(map(text.count, marks)) for lang, marks in _MARKS.items()}
    best = max(counts, key=counts.get)
    if counts[best] * 100 > len(text):
        return best
    return "en" if not any(counts.values()) else ""


def language_shares(text: str) -> dict[str, float]:
    """Share of the text by language, by sentence; sentences without a sign are left out."""
    out: dict[str, float] = {}
    for s in _SENTENCE.findall(text):
        lang, _ = language(s, WORD.findall(s.lower()))
        if lang:
            out[lang] = out.get(lang, 0) + len(s)
    total = sum(out.values())
    return {k: v / total for k, v in out.items()} if total else {}


#: How much likelier a trigram has to be under the first language for a vote.
CLEAR = 0.12


def language_votes(answer: str, words: list[str], of_source: str, source: str) -> list[int]:
    """Votes on another language by: frequent words, sentences, letters, clear mismatch, trigrams."""
    if not of_source or not words:
        return [-1, -1, 0, 0, 0]
    lang, clear = language(answer, words)
    # where all frequent words are of one language, so are all sentences that have any
    shares = {lang: 1.0} if clear == 1.0 and not _BEYOND.search(answer) else language_shares(answer)
    other = sum(v for k, v in shares.items() if k != of_source)
    marks, marks_of_source = by_marks(answer), by_marks(source)
    grams, surely = ("", 0.0) if _script(answer) or _script(source) else by_trigrams(answer)
    return [
        0 if not lang else 1 if lang != of_source else -1,
        0 if not shares else 1 if other > 0.5 else -1,
        0 if not marks or not marks_of_source else 1 if marks != marks_of_source else -1,
        0 if not lang else 1 if lang != of_source and clear > 0.8 else -1 if lang == of_source and clear > 0.8 else 0,
        0 if not grams or surely < CLEAR else 1 if grams != of_source else -1,
    ]


# ---------------------------------------------------------------- broken off

_TERMINAL = ".!?…。！？"
_CLOSERS = "\"'”’»)]}*_）」』`"
_ABBREVIATION = re.compile(r"(?:^|[\s(])(?:e\.g|i\.e|approx|No|Nr|St|Dr|Mr|Mrs|Ms|Prof|vs|Fig|cf|ca|z\.B|bzw|env|p\. ej|núm|Sr|Sra|M|Mme|pp?|vol|esp|incl)\.$")
_MARKER = re.compile(r"^\s*(?:[-*•–]|\d{1,3}[.)]|[a-z]\)|\(?[ivx]+[.)])\s*$")
_ITEM = re.compile(r"^\s*(?:[-*•–]|\d{1,3}[.)]|Step \d+:)\s+\S")
_CLOSING = re.compile(
    r"^\s*(?:[-=*_~#]{3,}|(?:--|—|–)\s*\S[^.!?]*|\W*(?:end of|ende|fin)\b[^.!?]{0,40}"
    r"|(?:keywords?|key (?:items|words|points)|see also|sources?|total|tags?|notes?|references?|related|categor(?:y|ies)|filed under|author|date|further reading"
    r"|schlagwörter|stichwörter|quellen?|siehe auch|summe|mots[- ]clés|voir aussi|palabras clave|véase también|ver también|fuentes?):\s*\S.*)\s*$",
    re.IGNORECASE,
)
_TAGS = re.compile(r"(?:\s*(?:<[^<>]{1,80}>|&\w{2,8};))+\s*$")
_NUMBER_END = re.compile(r"(?:^|[;:,.]\s*)\(?(?:\d{1,2}|[a-e]|[ivx]+)\)$")
_OPEN_WORD = set(
    "the a an of to in on at by for from with and or but as than that which who into per about over under between some each any its their his her is was are were be been has had this these those such very so if when while after before until during"
    " der die das dem den ein eine einer und oder in im an am auf bei mit von zu zum nach für als aus dass neben"
    " le la les un une des du de et ou à au dans par pour sur avec que qui près"
    " el los las una y o en con por para del al que".split()
)


def truncated_votes(answer: str, status: int | None, reason: str | None) -> list[int]:
    """Votes on a broken-off answer.

    By: how it ends on the whole, an abbreviation or mark that cannot end, open
    brackets and quotes, a bare or short last item or row, a closing line, a
    last sentence that starts like an earlier one, the last word, and the status
    where the end itself is not clear.
    """
    lines = [x for x in answer.split("\n") if x.strip(_BLANK)]
    last = lines[-1].strip(_BLANK) if lines else ""
    sentences = _SENTENCE.findall(answer)
    tail = sentences[-1].strip(_BLANK) if sentences else ""
    before = [x.strip(_BLANK) for x in lines[-5:-1]]
    ends = _proper_end(last)
    no_signs = len(answer) > 250 and sum(answer.count(c) for c in _TERMINAL) <= len(answer) / 400  # texts written without full stops say nothing by their lack
    items = [x for x in before if _ITEM.match(x)]
    item = bool(_ITEM.match(last)) and bool(items)
    of_items = sum(_proper_end(x) for x in items) * 2 > len(items) if items else False
    in_list = item and (ends or not of_items) and len(last) <= 2 * max(map(len, items))
    closing = bool(_CLOSING.match(last)) and last[-1:] not in ":,;("
    cells = [x.count("|") for x in [*before, last] if "|" in x]
    row = len(cells) > 1 and last.endswith("|")
    words = WORD.findall(last.lower())
    open_marks = answer.count("(") > answer.count(")") or answer.count("[") > answer.count("]") or answer.count("“") > answer.count("”") or last.count('"') % 2 == 1
    cannot_end = last[-1:] in ":,;(" or last.endswith((" -", " –", " —")) or bool(_ABBREVIATION.search(last)) or bool(_NUMBER_END.search(last))
    bare_marker = bool(_MARKER.match(last)) and len(lines) > 1
    short_row = row and cells[-1] < max(cells)
    starts_again = len(tail) >= 8 and tail[-1] not in _TERMINAL and any(len(x) > len(tail) and x.startswith(tail) for x in (s.strip(_BLANK) for s in sentences[:-1]))
    broken = cannot_end or open_marks or bare_marker or short_row
    unclear = closing or in_list or (no_signs and bool(words))
    open_word = bool(words) and not ends and words[-1] in _OPEN_WORD
    whole = -1 if ends and not broken else 1 if broken or not unclear else 0
    return [
        whole,
        1 if cannot_end else 0,
        1 if open_marks else 0,
        1 if bare_marker or short_row else -1 if in_list or row else 0,
        -1 if closing and not broken else 0,
        1 if starts_again else 0,
        1 if open_word else 0,
        1 if whole == 0 and (status == 1 or reason == "length") else 0,
    ]


def _proper_end(line: str) -> bool:
    """Whether a line ends in a full stop, also within brackets or quotes, or in a closing bracket or row."""
    line = _TAGS.sub("", line).rstrip(_BLANK)
    bare = line.rstrip(_CLOSERS + _BLANK)
    return bool(bare) and bare[-1] in _TERMINAL or line[-1:] in ")]\"”»*|"


# ---------------------------------------------------------------- votes of a batch


def _code(votes: list[int]) -> int:
    code = 0
    for v in votes:
        code = code * 3 + v + 1
    return code


def votes_of(code: int, n: int) -> list[int]:
    """The votes of a pattern's number."""
    out = []
    for _ in range(n):
        code, v = divmod(code, 3)
        out.append(v - 1)
    return out[::-1]


def copied_shares(answers: list[list[str]], sources: list[list[str]], lengths: tuple[int, ...]) -> list[np.ndarray]:
    """For each run length: share of each answer's words that lie in runs of so many or more words of its source."""
    (ha, ca), (hs, cs) = (_hashed(x) for x in (answers, sources))
    oa, os = (mix(np.repeat(np.arange(len(c), dtype=np.uint64), c) + np.uint64(1)) for c in (ca, cs))
    owner = np.repeat(np.arange(len(ca)), ca)
    out = []
    for run in lengths:
        (ga, ina), (gs, ins) = runs(ha, ca, run), runs(hs, cs, run)
        hit = np.flatnonzero(np.isin(mix(ga + oa), mix(gs + os)[ins]) & ina)
        step = np.zeros(len(ha) + 1, np.int64)
        np.add.at(step, hit, 1)
        np.add.at(step, hit + run, -1)
        out.append(np.bincount(owner[np.cumsum(step)[:-1] > 0], minlength=len(ca)) / np.maximum(1, ca))
    return out


def _hashed(words: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, words), np.int64, len(words))
    return hashes_of(words), counts


def judge(answers: list[str | None], sources: list[str | None], status: list[int | None], reason: list[str | None]) -> dict[str, list]:
    """Vote patterns by defect, and the exact measures of copies and languages."""
    bodies = [body(a) for a in answers]
    texts = [s or "" for s in sources]
    all_words, all_source_words = ([WORD.findall(t.lower()) for t in x] for x in (bodies, texts))
    six, three, long = copied_shares(all_words, all_source_words, (COPY_RUN, 3, 2 * COPY_RUN))
    out: dict[str, list] = {d: [] for d in DEFECTS} | {"is_copy": [], "is_foreign": [], "is_empty": []}
    for i, (answer, source) in enumerate(zip(bodies, texts)):
        words, source_words = all_words[i], all_source_words[i]
        known = set(source_words)
        sentences = _SENTENCE.findall(answer)
        empty = not words
        of_source = language(source, source_words)[0]
        if not of_source and len(source) >= 200:
            guess, surely = by_trigrams(source)
            of_source = guess if surely >= 2 * CLEAR else ""
        ratio = len(words) / max(1, len(source_words))
        out["empty"].append(_code([1 if len(words) <= 2 else -1, 1 if sum(map(str.isalnum, answer)) <= 8 else -1]))
        out["refusal"].append(_code([-1] * 8 if empty else refusal_votes(answer, words, known, sentences)))
        out["copy"].append(_code([-1] * 4 if empty else [1 if three[i] >= COPY_SHARE else -1, 1 if long[i] >= 0.5 else -1 if long[i] < 0.2 and len(words) > 4 * COPY_RUN else 0, 1 if six[i] >= 0.5 and len(words) >= COPY_RUN else -1, 0 if ratio >= 0.3 else -1 if ratio < 0.02 else 0]))
        foreign = language_votes(answer, words, of_source, source)
        out["language"].append(_code(foreign))
        out["is_foreign"].append(sum(foreign) > 0)
        out["truncated"].append(_code([-1, 0, 0, 0, 0, 0, 0, 0] if empty else truncated_votes(answer, status[i], reason[i])))
        out["is_copy"].append(bool(six[i] >= COPY_SHARE))
        out["is_empty"].append(empty)
    return out


# ---------------------------------------------------------------- the label model

#: Votes that the prior on each function counts as, as a share of all rows.
PRIOR_SHARE, PRIOR_RIGHT = 0.05, 0.85


def posteriors(counts: dict[int, int], n: int, rounds: int = 60) -> dict[int, float]:
    """P(defect) of each vote pattern, by expectation-maximization.

    counts: rows by pattern number; n: functions.  Functions are taken as
    independent given the truth; each starts as right in most of its votes,
    which also decides which of the two classes is the defect.
    """
    if not counts:
        return {}
    codes = sorted(counts)
    votes = np.array([votes_of(c, n) for c in codes])
    weight = np.array([counts[c] for c in codes], float)
    total = weight.sum()
    at = votes + 1
    cast = np.stack([(votes == v).T.astype(float) @ weight for v in (-1, 0, 1)], 1) / total  # by function, share of each vote
    prior_yes = np.stack([cast[:, 0] * (1 - PRIOR_RIGHT), cast[:, 1], np.maximum(cast[:, 2], 1e-3) * PRIOR_RIGHT * 4], 1) + 1e-4
    prior_no = np.stack([np.maximum(cast[:, 0], 1e-3) * PRIOR_RIGHT, cast[:, 1], cast[:, 2] * (1 - PRIOR_RIGHT)], 1) + 1e-4
    prior_yes, prior_no = (p / p.sum(1, keepdims=True) for p in (prior_yes, prior_no))
    p = 1 / (1 + np.exp(-2.0 * votes.sum(1) + 0.5))
    strength = PRIOR_SHARE * total
    for _ in range(rounds):
        yes, no = weight * p, weight * (1 - p)
        pi = (yes.sum() + 1) / (total + 2)
        of_yes = np.stack([(votes == v).T.astype(float) @ yes for v in (-1, 0, 1)], 1) + strength * pi * prior_yes + 1e-6
        of_no = np.stack([(votes == v).T.astype(float) @ no for v in (-1, 0, 1)], 1) + strength * (1 - pi) * prior_no + 1e-6
        of_yes, of_no = of_yes / of_yes.sum(1, keepdims=True), of_no / of_no.sum(1, keepdims=True)
        logit = np.log(pi / (1 - pi)) + sum(np.log(of_yes[j, at[:, j]] / of_no[j, at[:, j]]) for j in range(n))
        new = 1 / (1 + np.exp(-np.clip(logit, -40, 40)))
        if np.abs(new - p).max() < 1e-6:
            p = new
            break
        p = new
    return dict(zip(codes, map(float, p)))


def votes_table(rewritten: DataFrame, pool: DataFrame) -> DataFrame:
    """(rewrite_id, a pattern by defect, exact measures), once a rewrite_id.

    Answers whose doc_id is null or not in the pool are judged against an empty
    source, which no answer copies and which has no language.
    """
    sources = pool.where(F.col("doc_id").isNotNull()).select("doc_id", F.col("text").alias("source_text"))
    rows = rewritten.select("rewrite_id", "doc_id", F.col("rewritten").alias("answer"), F.col("status").cast("int").alias("status"), "finish_reason")
    # never a broadcast of texts; the shuffle by document also spreads the judging over the cluster
    joined = rows.join(sources.hint("merge"), "doc_id", "left").select("rewrite_id", "answer", "source_text", "status", "finish_reason")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = judge(*(batch.column(i).to_pylist() for i in (1, 2, 3, 4)))
        return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, pa.int64() if d in DEFECTS else pa.bool_()) for d, v in found.items())], ["rewrite_id", *found])

    kind = rewritten.schema["rewrite_id"].dataType.simpleString()
    schema = f"rewrite_id {kind}, " + ", ".join(f"{d} long" for d in DEFECTS) + ", is_copy boolean, is_foreign boolean, is_empty boolean"
    return over_batches(joined, run, schema, 1_000).dropDuplicates(["rewrite_id"])


def defect_labels(rewritten: DataFrame, pool: DataFrame, cutoffs: dict[str, float] | None = None) -> DataFrame:
    """(rewrite_id, defect, place, posterior): every defect of every row; a row may have several.

    Repeated rows count once; null answers are empty; answers and sources are
    judged whole; other columns do not matter; an empty table gives an empty one.
    """
    cut = CUTOFFS | (cutoffs or {})
    votes = stash(votes_table(rewritten, pool), "votes")
    exact = {"empty": F.col("is_empty"), "copy": F.col("is_copy"), "language": F.col("is_foreign")}
    lines = []
    for place, d in enumerate(DEFECTS):
        counts = {r[0]: r[1] for r in votes.groupBy(d).count().collect()}  # at most 3 ** voters patterns
        lines += [(place, d, c, p) for c, p in posteriors(counts, VOTERS[d]).items() if p > cut[d]]
    table = rewritten.sparkSession.createDataFrame(lines, "place int, defect string, pattern long, posterior double")
    long = votes.select(
        "rewrite_id",
        F.explode(F.array(*(F.struct(F.lit(d).alias("defect"), F.col(d).alias("pattern"), exact.get(d, F.lit(True)).alias("holds")) for d in DEFECTS))).alias("v"),
    ).select("rewrite_id", "v.*")
    return long.where("holds").join(F.broadcast(table), ["defect", "pattern"]).select("rewrite_id", "defect", "place", "posterior")


def first_defect(labels: DataFrame) -> DataFrame:
    """(rewrite_id, defect): the first of a row's defects that applies."""
    return labels.groupBy("rewrite_id").agg(F.min_by("defect", "place").alias("defect"))


__all__ = ["DEFECTS", "body", "defect_labels", "first_defect", "judge", "posteriors", "votes_of", "votes_table"]
