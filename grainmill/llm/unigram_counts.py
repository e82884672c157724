"""Token counts by a unigram vocabulary, without making the tokens.

An Aho-Corasick automaton lists the vocabulary's matches in a text, and dynamic programming over
their ends carries the best score and its number of pieces. Ties go as in the tokenizers that use
such vocabularies: a path replaces another only if it scores more, and starts are tried from the
left, so of equal paths to a place the one with the longer last piece stays. A character without
a piece of its own may also be unknown, for ten less than the lowest score, tried last; an unknown
character is as many pieces as it has bytes if the vocabulary has all byte pieces, else one, and
one for a run of them.

White space: each space stands as U+2581, and one is put before the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
CACHED_SEGMENTS = 1 << 18


class Vocabulary:
    """Pieces with scores. ``bytes_too``: unknown characters fall back to byte pieces."""

    def __init__(self, pieces: list[tuple[str, float]], lowest: float, bytes_too: bool):
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), float(score)))
        self.automaton.make_automaton()
        self.unknown, self.bytes_too = lowest - UNKNOWN_PENALTY, bytes_too
        # A boundary lies before every run of spaces if no piece has a space after something else.
        # Whole scores add up exactly, so that the parts between may be scored one by one.
        apart = not any(SPACE in piece.lstrip(SPACE) for piece, _ in pieces)
        self.segments = apart and all(s == int(s) and abs(s) < 2**31 for _, s in [*pieces, ("", lowest)])

    def best(self, text: str) -> tuple[float, int]:
        """Score and number of pieces of the best path through one text."""
        n = len(text)
        score, count = [0.0] * (n + 1), [0] * (n + 1)
        run = [False] * (n + 1)  # whether the best path ends with an unknown character
        matches = iter(self.automaton.iter(text))
        match = next(matches, None)
        for i in range(n):
            found, alone = False, False
            top, pieces, unknown = 0.0, 0, False
            while match is not None and match[0] == i:  # longest first
                length, value = match[1]
                start = i + 1 - length
                value += score[start]
                if not found or value > top:
                    found, top, pieces, unknown = True, value, count[start] + 1, False
                alone = alone or length == 1
                match = next(matches, None)
            if not alone:
                value = score[i] + self.unknown
                if not found or value > top:
                    top, unknown = value, True
                    if self.bytes_too:
                        pieces = count[i] + len(text[i].encode())
                    else:
                        pieces = count[i] + (not run[i])
            score[i + 1], count[i + 1], run[i + 1] = top, pieces, unknown
        return score[n], count[n]


class Segments(dict):
    """Best paths of the parts between boundaries; a worker forgets them beyond ``CACHED_SEGMENTS``."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, segment: str) -> tuple[float, int]:
        found = self.vocabulary.best(segment)
        if len(self) >= CACHED_SEGMENTS:
            self.clear()
        if len(segment) <= 64:
            self[segment] = found
        return found


@lru_cache(maxsize=2)
def read_vocabulary(path: str) -> Vocabulary:
    """The ordinary pieces of a sentencepiece model file, with its scores."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    pieces = [(model.id_to_piece(i), model.get_score(i)) for i in plain]
    return Vocabulary(pieces, min(s for _, s in pieces), sum(map(model.is_byte, ids)) == 256)


def count_text(vocabulary: Vocabulary, segments: Segments, text: str) -> tuple[int, float]:
    if not text:
        return 0, 0.0
    text = SPACE + text.replace(" ", SPACE)
    if not vocabulary.segments:
        score, pieces = vocabulary.best(text)
        return pieces, score
    found = [segments[s] for s in re.findall(f"{SPACE}+[^{SPACE}]*", text)]
    # Runs of unknown characters never cross a boundary: a space is a piece, or is unknown itself.
    return sum(n for _, n in found), float(sum(s for s, _ in found))


def counts(text: Column, path: str) -> Column:
    """Struct of n_tokens and score of a text; null and empty ones have no tokens and score 0."""

    @F.arrow_udf("struct<n_tokens:long,score:double>")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocabulary = read_vocabulary(path)
        segments = Segments(vocabulary)
        for batch in batches:
            out = [count_text(vocabulary, segments, t.as_py() or "") for t in batch]
            n, score = (np.array(x) for x in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0))
            yield pa.StructArray.from_arrays([pa.array(n.astype(np.int64)), pa.array(score)], names=["n_tokens", "score"])

    return count(text)


def count_tokens(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens`` and ``token_score``, which replace columns of these names.

    Equal rows each get their own. Nothing is shuffled.
    """
    name = F.col(text)
    out = docs.withColumn("n_tokens", counts(name, path))
    return out.withColumn("token_score", F.col("n_tokens.score")).withColumn("n_tokens", F.col("n_tokens.n_tokens"))
