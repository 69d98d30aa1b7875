"""Token counts of unigram tokenizers without building the tokens.

An Aho-Corasick automaton over the vocabulary lists every match that ends at each character; dynamic programming
carries the best score of a path to each place, its piece count and whether it ends with an unknown piece, for as
many places as the longest piece has characters; no path is kept or walked back. Ties go as in the
``tokenizers`` library: the path found first wins, which is the one whose last piece starts earliest (the longest).

A place between two characters that no piece spans is a boundary of every path, so a text is scored stretch by
stretch between such places, and stretches that repeat within a batch (words, mostly) are scored once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
REMEMBERED_BYTES = 128 << 20  # of stretches a worker keeps scored; others are scored again, so no limit changes a result
ENTRY_BYTES = 150
LONGEST_REMEMBERED = 200  # characters of a stretch


class Unigram:
    """Counts pieces for a vocabulary [(piece, score)]; ``byte_fallback`` as in the library."""

    def __init__(self, vocabulary: list[tuple[str, float]], unknown: int = 0, byte_fallback: bool = True):
        pieces: dict[str, float] = {}
        for piece, score in vocabulary:
            pieces[piece] = score  # of a piece listed twice the last score counts
        self.unknown_piece = vocabulary[unknown][0]
        self.unknown_score = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        self.by_bytes = byte_fallback and all(f"<0x{b:02X}>" in pieces for b in range(256))
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces.items():
            if piece:
                self.automaton.add_word(piece, (len(piece), score, piece == self.unknown_piece))
        self.automaton.make_automaton()
        inner = {pair for piece in pieces for pair in zip(piece, piece[1:], strict=False)}
        # spans of characters across which no piece reaches: only a space mark after another character is tested,
        # as words are what repeats
        self.by_word = not any(b == SPACE and a != SPACE for a, b in inner)
        self.longest = max(map(len, pieces))
        self.known: dict[str, int] = {}
        self.held = 0

    def pieces_of(self, text: str) -> int:
        """Pieces of the best path over a whole text.

        Each place holds the score of its best path, the path's pieces and whether it ends with an unknown piece; a
        ring as long as the longest piece keeps the places that a match may still begin at.
        """
        size = self.longest + 1
        best, count, open_end = [0.0] + [0.0] * self.longest, [0] * size, [False] * size
        done, score, pieces, unknown, single = 0, None, 0, False, False  # places done, and the state of the next one

        def unknown_cost(piece: str, after_unknown: bool) -> int:
            """Unknown characters in a row are one piece, or their bytes."""
            return len(piece.encode("utf-8", "surrogatepass")) if self.by_bytes else int(not after_unknown)

        def finish() -> None:
            """Settle the next place: an unknown character leads there if that is better or the only way."""
            nonlocal done, score, pieces, unknown, single
            if not single:
                at = done % size
                total = best[at] + self.unknown_score
                if score is None or total > score:
                    score, pieces, unknown = total, count[at] + unknown_cost(text[done], open_end[at]), True
            done += 1
            at = done % size
            best[at], count[at], open_end[at] = score, pieces, unknown
            score, pieces, unknown, single = None, 0, False, False

        for last, (length, gain, literal) in self.automaton.iter(text):
            while done < last:
                finish()
            # matches of one end come longest first, so the earliest start wins a tie
            if length == 1:
                single = True
            at = (last + 1 - length) % size
            total = best[at] + gain
            if score is None or total > score:
                score, unknown = total, literal
                pieces = count[at] + (unknown_cost(self.unknown_piece, open_end[at]) if literal else 1)
        while done < len(text):
            finish()
        return count[done % size]

    def count(self, text: str) -> int:
        """Pieces of a text whose spaces are marks already."""
        if not self.by_word or not self.by_bytes:
            return self.pieces_of(text)
        total = 0
        for stretch in re.split(f"(?<=[^{SPACE}])(?={SPACE})", text):
            total += self.remembered(stretch)
        return total

    def remembered(self, stretch: str) -> int:
        found = self.known.get(stretch)
        if found is None:
            found = self.pieces_of(stretch)
            if len(stretch) <= LONGEST_REMEMBERED:
                self.held += ENTRY_BYTES + 4 * len(stretch)
                if self.held > REMEMBERED_BYTES:
                    self.known.clear()
                    self.held = ENTRY_BYTES + 4 * len(stretch)
                self.known[stretch] = found
        return found


def marked(text: str | None) -> str:
    """Spaces as marks, with one in front; an empty text stays empty."""
    return SPACE + text.replace(" ", SPACE) if text else ""


@lru_cache(maxsize=2)
def load_pieces(path: str) -> tuple[tuple[str, float], ...]:
    """Pieces and scores of a sentencepiece model file, used as a unigram vocabulary."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return tuple((model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size()))


@lru_cache(maxsize=2)
def _counter(path: str) -> Unigram:
    return Unigram(list(load_pieces(path)))


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in batches:
            found = [counter.count(marked(text)) for text in batch.column(1).to_pylist()]
            size = [len(text or "") for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(np.array(found, np.int64)), pa.array(np.array(size, np.int64))],
                ["doc_id", "n_tokens", "n_chars"],
            )

    return run


def token_counts(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_tokens, n_chars) for every row of docs (doc_id, text), by the pieces and scores of a model file.

    Null and empty texts have 0 tokens. Repeated rows count each; other columns are ignored. No row is shuffled.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(_count(model), "doc_id long, n_tokens long, n_chars long")
