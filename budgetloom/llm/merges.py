"""Byte-pair merging of many words at once, in numpy.

The symbols of all words of a batch lie in one flat array.  Each round looks up
every adjacent pair by binary search over the sorted pair keys, finds the
lowest rank of each word and joins all places of that pair in it, until no word
has a pair left.  Words are distinct pieces of text, and what they came to is
kept from batch to batch, so that a frequent word is merged once per worker.

Two public vocabularies are read: the byte-level ranks (``ByteEncoder``) and the
sentence-piece model with byte fallback (``PieceCounter``).  Their folder is a
parameter; nothing of them is copied here.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np

NO_RANK = np.int64(1) << 40
#: Words whose result a worker keeps; beyond it the store starts afresh. It bounds memory and changes no result.
STORE_WORDS = 400_000


def default_path(name: str) -> str:
    """A public tokenizer's file, by the installed package that carries them."""
    import public_tokenizers

    return public_tokenizers.path(name)


class PairTable:
    """Sorted keys of adjacent symbols, each with the rank and the symbol they join to."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, joined: np.ndarray):
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.joined = key[order], rank[order].astype(np.int64), joined[order].astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and joined symbol of each pair; NO_RANK where there is none."""
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], NO_RANK), self.joined[at]


def merge_words(symbols: np.ndarray, starts: np.ndarray, table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Merge every word to its end: the flat symbols and the start of each word.

    symbols: int64, the words one after another; starts: first index of each
    word; no word is empty.  Returned alike, in the same order of words.
    """
    n = len(starts)
    if not n:
        return symbols, starts
    done_symbols: list[np.ndarray] = []
    done_words: list[np.ndarray] = []
    done_sizes: list[np.ndarray] = []
    sizes = np.diff(np.append(starts, len(symbols)))
    words = np.arange(n)
    fresh = np.ones(len(symbols), bool)  # the pair that starts here has to be looked up
    rank = np.full(len(symbols), NO_RANK)
    joined = np.zeros(len(symbols), np.int64)
    while len(words):
        starts = np.cumsum(sizes) - sizes
        fresh[starts + sizes - 1] = False
        rank[starts + sizes - 1] = NO_RANK
        at = np.flatnonzero(fresh)
        rank[at], joined[at] = table.look_up(symbols[at], symbols[at + 1])
        least = np.minimum.reduceat(rank, starts)
        over = least >= NO_RANK
        if over.any():
            gone = np.repeat(over, sizes)
            done_symbols.append(symbols[gone])
            done_words.append(words[over])
            done_sizes.append(sizes[over])
            keep = ~gone
            symbols, rank, joined = symbols[keep], rank[keep], joined[keep]
            words, sizes, least = words[~over], sizes[~over], least[~over]
            if not len(words):
                break
            starts = np.cumsum(sizes) - sizes
        chosen = rank == np.repeat(least, sizes)
        # of touching places (a run of one symbol) every second one is joined, from the left
        where = np.flatnonzero(chosen)
        first = np.append(True, np.diff(where) != 1)
        if not first.all():
            run = np.flatnonzero(first)
            offset = np.arange(len(where)) - np.repeat(run, np.diff(np.append(run, len(where))))
            where = where[offset % 2 == 0]
        symbols[where] = joined[where]
        keep = np.ones(len(symbols), bool)
        keep[where + 1] = False
        fresh = np.zeros(len(symbols), bool)
        fresh[where] = True
        before = where - 1
        before = before[before >= 0]
        fresh[before] = True
        # a joined place's left neighbour may itself be the dropped half of a joined place
        fresh[np.maximum(where - 2, 0)] = True
        sizes = sizes - np.add.reduceat((~keep).astype(np.int64), starts)
        symbols, rank, joined, fresh = symbols[keep], rank[keep], joined[keep], fresh[keep]
    all_words, all_sizes = np.concatenate(done_words), np.concatenate(done_sizes)
    flat = np.concatenate(done_symbols)
    order = np.argsort(all_words, kind="stable")
    out_sizes = all_sizes[order]
    out_starts = np.cumsum(out_sizes) - out_sizes
    from_start = (np.cumsum(all_sizes) - all_sizes)[order]
    index = np.arange(len(flat)) + np.repeat(from_start - out_starts, out_sizes)
    return flat[index], out_starts


class _Codes(dict):
    """Numbers words in the order of their first appearance."""

    def __missing__(self, word):
        self[word] = code = len(self)
        return code


class ByteEncoder:
    """Ids by a byte-level vocabulary of ranks, without special tokens.

    A text is cut by the vocabulary's public pattern; strings that look like
    special tokens are ordinary text.  Null and empty texts have no ids.
    """

    def __init__(self, ranks_path: str):
        import regex

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.of_byte = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        left, right, joined = [], [], []
        for word, rank in ranks.items():
            for cut in range(1, len(word)):
                a, b = ranks.get(word[:cut]), ranks.get(word[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), joined.append(rank)
        joined_ = np.array(joined)
        self.table = PairTable(np.array(left), np.array(right), joined_, joined_)
        from public_tokenizers import PATTERN

        self.unicode = regex.compile(PATTERN)
        # the same pattern for texts that are all ASCII, for the faster engine
        self.ascii = re.compile(PATTERN.replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9").replace(" ?A-Za-z+", " ?[A-Za-z]+").replace(" ?0-9+", " ?[0-9]+"), re.ASCII)
        self._clear()

    def _clear(self) -> None:
        self.codes = _Codes()
        self.flat = np.zeros(0, np.int32)
        self.starts = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)

    def _words(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the words of all texts, and the number of words of each text."""
        if len(self.codes) > STORE_WORDS:
            self._clear()
        code, out, counts = self.codes.__getitem__, [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            if text:
                words = (self.ascii if text.isascii() else self.unicode).findall(text)
                counts[i] = len(words)
                out.extend(map(code, words))
        known = len(self.sizes)
        if len(self.codes) > known:
            self._learn(list(self.codes)[known:])
        return np.array(out, np.int64), counts

    def _learn(self, words: list[str]) -> None:
        raw = [w.encode("utf-8", "replace") for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        symbols = self.of_byte[np.frombuffer(b"".join(raw), np.uint8)]
        flat, starts = merge_words(symbols, np.cumsum(sizes) - sizes, self.table)
        self.starts = np.append(self.starts, starts + len(self.flat))
        self.sizes = np.append(self.sizes, np.diff(np.append(starts, len(flat))))
        self.flat = np.append(self.flat, flat.astype(np.int32))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, number of ids of each text)."""
        codes, counts = self._words(texts)
        sizes = self.sizes[codes]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        index = np.arange(total) + np.repeat(self.starts[codes] - (ends - sizes), sizes)
        return self.flat[index], _per_text(sizes, counts)

    def count(self, texts: list[str | None]) -> np.ndarray:
        """Number of ids of each text."""
        codes, counts = self._words(texts)
        return _per_text(self.sizes[codes], counts)


def _per_text(sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of the words' sizes by text."""
    ends = np.append(0, np.cumsum(sizes))
    upto = np.append(0, np.cumsum(counts))
    return ends[upto[1:]] - ends[upto[:-1]]


class PieceCounter:
    """Number of tokens by a sentence-piece BPE model with byte fallback.

    The model's text form is the text with a blank before it and every blank
    written as a bar; no piece has a bar after another character and none holds
    a line feed, so a text is cut before each run of blanks and around line
    feeds without changing its tokens.  Distinct pieces are kept as symbol
    arrays and joined by merge rank.
    """

    _cut = re.compile(" *[^ \n]+|\n| +")

    def __init__(self, model_path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        names = {model.id_to_piece(i): i for i in range(model.vocab_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
        self.of_char = {ord(" " if p == "▁" else p): i for p, i in names.items() if len(p) == 1}
        left, right, rank, joined = [], [], [], []
        for piece, i in names.items():
            for cut in range(1, len(piece)):
                a, b = names.get(piece[:cut]), names.get(piece[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), rank.append(-model.get_score(i)), joined.append(i)
        self.table = PairTable(np.array(left), np.array(right), np.array(rank), np.array(joined))
        lookup = np.full(0x110000, -1, np.int32)
        for c, i in self.of_char.items():
            lookup[c] = i
        self.lookup = lookup
        self._clear()

    def _clear(self) -> None:
        self.codes = _Codes()
        self.sizes = np.zeros(0, np.int64)

    def _learn(self, pieces: list[str]) -> None:
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        points = np.frombuffer("".join(pieces).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        symbols = self.lookup[points].astype(np.int64)
        unknown = symbols < 0
        # a character outside the vocabulary becomes one token for each of its bytes and joins with nothing
        extra = np.where(unknown, (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF), 0)
        symbols[unknown] = (1 << 30) + points[unknown]
        starts = np.cumsum(lengths) - lengths
        flat, begin = merge_words(symbols, starts, self.table)
        self.sizes = np.append(self.sizes, np.diff(np.append(begin, len(flat))) + np.add.reduceat(extra, starts))

    def count(self, texts: list[str | None]) -> np.ndarray:
        """Number of tokens of each text; 0 for null and empty ones."""
        if len(self.codes) > STORE_WORDS:
            self._clear()
        code, out, counts = self.codes.__getitem__, [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            if text:
                pieces = self._cut.findall(" " + text)
                counts[i] = len(pieces)
                out.extend(map(code, pieces))
        known = len(self.sizes)
        if len(self.codes) > known:
            self._learn(list(self.codes)[known:])
        return _per_text(self.sizes[np.array(out, np.int64)], counts)


@lru_cache(maxsize=4)
def byte_encoder(ranks_path: str) -> ByteEncoder:
    """One encoder for each worker process."""
    return ByteEncoder(ranks_path)


@lru_cache(maxsize=4)
def piece_counter(model_path: str) -> PieceCounter:
    """One counter for each worker process."""
    return PieceCounter(model_path)
