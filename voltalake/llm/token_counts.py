"""Token counts by a Viterbi pass that keeps scores and counts only.

The vocabulary's pieces and scores come from a public SentencePiece file and
are read as a unigram model. The whole text counts: blanks become word marks, one
more stands in front unless the text begins with one, and line feeds and tabs are
characters like others. The text is cut where no piece can lie across, before each
run of marks and beside line feeds, tabs and carriage returns, as far as the
vocabulary has them in no piece. In a part, an Aho-Corasick automaton lists every
vocabulary match; dynamic programming carries for each position the best score
and its number of pieces. Ties follow the tokenizer: of equal scores the piece
that begins first stays. A character that no single-character piece covers
costs ``UNKNOWN_COST`` more than the worst piece and counts its UTF-8 bytes, as
bytes are its fallback pieces. The scores are whole numbers, so sums are exact
and parts can be counted apart.

Null and empty texts have 0 tokens; blank ones have those of their blanks. Repeated rows are counted one by
one; other columns are ignored.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from voltalake.llm.text import Batch, Cache, map_batches, texts

MARK = "▁"
UNKNOWN_COST = 10.0
RESULT = "doc_id long, n_words long, n_tokens long, score double"


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a SentencePiece file, without control and byte pieces."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [
        (model.id_to_piece(k), model.get_score(k))
        for k in range(model.get_piece_size())
        if not (model.is_control(k) or model.is_byte(k) or model.is_unknown(k))
    ]


class Counter:
    """Counts pieces of texts."""

    def __init__(self, pieces: list[tuple[str, float]]):
        self.matches = ahocorasick.Automaton()
        for piece, score in pieces:
            self.matches.add_word(piece, (len(piece), score))
        self.matches.make_automaton()
        self.single = {piece for piece, _ in pieces if len(piece) == 1}
        self.unknown = min((score for _, score in pieces), default=0.0) - UNKNOWN_COST
        known = {c for piece, _ in pieces for c in piece}
        free = "".join(c for c in "\n\t\r" if c not in known)
        alone = f"[{free}]|" if free else ""
        across = any(MARK in piece.lstrip(MARK) for piece, _ in pieces)
        part = rf"[^{free}]+" if across else rf"{MARK}+[^{MARK}{free}]*|[^{MARK}{free}]+"
        self.parts = re.compile(alone + part if free or not across else r"(?s).+")
        self.counts = Cache(self._of_part, entries=500_000)

    def _of_part(self, text: str) -> complex:
        """Pieces (real part) and score (imaginary part) of a part of a text."""
        best = [-np.inf] * len(text) + [0.0]  # the last entry stands before the first
        count = [0] * (len(text) + 1)
        gaps = [k for k, c in enumerate(text) if c not in self.single]
        # Matches come by their end, the longest first, so a tie leaves the earlier start.
        done = 0
        for end, (length, score) in self.matches.iter(text):
            while done < len(gaps) and gaps[done] < end:
                self._unknown(text, gaps[done], best, count)
                done += 1
            total = best[end - length] + score
            if total > best[end]:
                best[end], count[end] = total, count[end - length] + 1
        for at in gaps[done:]:
            self._unknown(text, at, best, count)
        at = len(text) - 1
        return complex(count[at], best[at])

    def _unknown(self, text: str, at: int, best: list[float], count: list[int]) -> None:
        """The fallback of a character that is no piece; it starts last, so it loses ties."""
        total = best[at - 1] + self.unknown
        if total > best[at]:
            best[at], count[at] = total, count[at - 1] + len(text[at].encode())

    def of_text(self, text: str) -> tuple[int, int, float]:
        marked = text.replace(" ", MARK)
        if marked and not marked.startswith(MARK):
            marked = MARK + marked
        total = sum(map(self.counts.__getitem__, self.parts.findall(marked)), 0j)
        return len(text.split()), int(total.real), total.imag


@lru_cache(maxsize=1)
def counter(path: str) -> Counter:
    """One per worker."""
    return Counter(vocabulary(path))


def token_counts(docs: DataFrame, model: str) -> DataFrame:
    """Words, tokens and the best segmentation's score of every document."""

    def count(batch: Batch) -> Batch:
        of = counter(model)
        rows = [of.of_text(x.decode()) for x in texts(batch)]
        words, tokens, score = zip(*rows, strict=True)
        return pa.record_batch(
            [
                batch.column("doc_id"),
                pa.array(words, pa.int64()),
                pa.array(tokens, pa.int64()),
                pa.array(score, pa.float64()),
            ],
            ["doc_id", "n_words", "n_tokens", "score"],
        )

    return map_batches(docs.select("doc_id", "text"), RESULT, count)
