"""Token counts of a unigram tokenizer by a Viterbi pass that only counts.

An Aho-Corasick automaton over the vocabulary enumerates every piece that ends at each
position; dynamic programming carries the best score and the number of pieces of its path,
never the path. Ties follow the tokenizer: starts are tried from left to right and a path is
replaced only by a better one, so among equal scores the longest last piece wins. A character
that is no piece by itself costs the lowest score minus 10; with byte fallback it counts one
token per UTF-8 byte, else neighbouring ones count as one.

Where no piece holds a space mark behind another character, every path passes the start of
each word, so words are worked off on their own and remembered. That is exact only while sums
of scores are exact, so it is done for integral scores alone; other vocabularies are run
over the text as a whole.

The vocabulary (pieces and scores, a few MB) is read on the driver and broadcast. No shuffle.

Defined results: a null or empty text has no tokens and score 0; equal texts have equal
results; texts of any length are counted whole; other columns pass through unchanged.
"""

from __future__ import annotations

import re

import ahocorasick
import sentencepiece
from pyspark.sql import DataFrame, types as T

from sessionloom.llm.common import free_names, map_text

#: What a space becomes; the text gets one in front.
SPACE = "▁"
#: An unknown character's score lies this much below the lowest.
UNKNOWN = 10.0
REMEMBERED, LONGEST_KEY = 400_000, 48


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece file, by id."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), float(model.get_score(i))) for i in range(model.get_piece_size())]


class Counter(dict):
    """(tokens, score) by word; ``count`` adds them up for a text."""

    def __init__(self, pieces: list[tuple[str, float]], unknown_id: int = 0):
        super().__init__()
        scores = {}
        for i, (piece, score) in enumerate(pieces):
            scores[piece] = score
        names = {f"<0x{b:02X}>" for b in range(256)}
        self.bytes = names <= scores.keys()
        self.unknown = min(scores.values()) - UNKNOWN
        self.pieces = ahocorasick.Automaton()
        for piece, score in scores.items():
            if piece:
                self.pieces.add_word(piece, (len(piece), score))
        self.pieces.make_automaton()
        inner = any(SPACE in p.lstrip(SPACE) for p in scores)
        exact = all(s == int(s) and abs(s) < 1 << 31 for s in scores.values())
        # without byte fallback neighbouring unknowns merge, also across a line end
        alone = "".join(c for c in "\n\r\t" if self.bytes and not any(c in p for p in scores))
        self.split = None
        if exact and not inner and self.bytes:
            apart = re.escape(alone)
            self.split = re.compile(f"{SPACE}*[^{SPACE}{apart}]+|{SPACE}+" + (f"|[{apart}]" if alone else "")).findall

    def __missing__(self, word: str) -> tuple[int, float]:
        found = self.viterbi(word)
        if len(word) <= LONGEST_KEY:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = found
        return found

    def viterbi(self, text: str) -> tuple[int, float]:
        n = len(text)
        score: list[float | None] = [0.0] + [None] * n
        count, fused = [0] * (n + 1), [False] * (n + 1)
        done = 0  # positions up to here are final

        def close(upto: int) -> None:
            """Offer the single character to positions that no piece of length one reaches."""
            for e in range(done + 1, upto + 1):
                if not single[e]:
                    other = score[e - 1] + self.unknown
                    if score[e] is None or other > score[e]:
                        score[e] = other
                        cost = len(text[e - 1].encode("utf-8", "replace")) if self.bytes else 0 if fused[e - 1] else 1
                        count[e], fused[e] = count[e - 1] + cost, not self.bytes

        single = bytearray(n + 1)
        for last, (length, piece_score) in self.pieces.iter(text):
            end = last + 1
            if end - 1 > done:  # starts before ``end`` must be final
                close(end - 1)
                done = end - 1
            if length == 1:
                single[end] = 1
            start = end - length
            other = score[start] + piece_score
            if score[end] is None or other > score[end]:
                score[end], count[end], fused[end] = other, count[start] + 1, False
        close(n)
        return count[n], score[n]

    def count(self, text: str) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        text = SPACE + text.replace(" ", SPACE)
        if self.split is None:
            return self.viterbi(text)
        found = list(map(self.__getitem__, self.split(text)))
        return sum(c for c, _ in found), sum(s for _, s in found)


def count_tokens(docs: DataFrame, path: str, text: str = "text", tokens: str = "n_tokens", score: str = "score") -> DataFrame:
    """Add the number of tokens of every text and the score of its best segmentation."""
    if free_names(docs, tokens, score) != [tokens, score]:
        raise ValueError(f"{tokens} or {score} is a column already")
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary(path))

    def make():
        counter = _counter(sent)

        def work(texts):
            found = [counter.count(t) for t in texts]
            return [[c for c, _ in found], [s for _, s in found]]

        return work

    return map_text(docs, [T.StructField(tokens, T.LongType()), T.StructField(score, T.DoubleType())], make, text)


_BUILT: dict[int, Counter] = {}


def _counter(sent) -> Counter:
    """The worker's counter for a broadcast vocabulary, built once."""
    key = hash(tuple(sent.value))
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Counter(sent.value)
    return _BUILT[key]
