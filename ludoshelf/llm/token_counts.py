"""Count-only Viterbi over a unigram vocabulary.

A text is cut before every space mark that follows another character. No piece of the vocabulary reaches across such
a cut (checked when it is read), so the best path of a text is the best paths of its parts. Inside a part an
Aho-Corasick automaton lists all pieces that end at a position, and a table carries the best score and the piece
count of its path; no piece is ever built.

Tie rule of the public unigram tokenizers: positions are left in order and a later candidate replaces an earlier one
only with a strictly higher score, so among equals the path with the longest last piece stays.
"""

from __future__ import annotations

import math
import re

import ahocorasick
from pyspark.sql import DataFrame

from ludoshelf.llm.common import map_rows

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN = 10.0  # an unknown character scores this much below the least score of the vocabulary
KEPT_PARTS = 400_000  # parts whose counts a task remembers before it starts anew


def read_pieces(path: str = MODEL_PATH) -> tuple[dict[str, float], bool]:
    """Pieces of a sentencepiece model with their scores, and whether unknown characters fall back to bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    pieces = {model.id_to_piece(i): float(model.get_score(i)) for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
    return pieces, any(model.is_byte(i) for i in ids)


class Known(dict):
    """Results by part; a part not seen yet is computed."""

    def __init__(self, function) -> None:
        super().__init__()
        self.function = function

    def __missing__(self, part: str) -> tuple[float, int]:
        got = self[part] = self.function(part)
        return got


class Counter:
    """Piece counts of texts; ``pieces`` are scored pieces, spaces written as the mark."""

    def __init__(self, pieces: dict[str, float], byte_fallback: bool, kept: int = KEPT_PARTS) -> None:
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece reaches across a space; parts would not be independent")
        self.matches = ahocorasick.Automaton()
        for piece, score in pieces.items():
            self.matches.add_word(piece, (len(piece), score))
        self.matches.make_automaton()
        self.single = {p for p in pieces if len(p) == 1}
        self.unknown = min(pieces.values(), default=0.0) - UNKNOWN
        self.byte_fallback, self.kept, self.known = byte_fallback, kept, Known(self.part)
        # A line feed that no piece holds is a node of its own, so lines are parts too where unknown runs are not joined.
        lines = byte_fallback and not any("\n" in p for p in pieces)
        inner = f"[^{MARK}\\n]" if lines else f"[^{MARK}]"
        # Letters are cut from a character behind them that no piece has behind a letter, such as a full stop.
        behind = {b for p in pieces for a, b in zip(p, p[1:], strict=False) if a.isalpha()}
        stops = "".join(re.escape(c) for c in ".,;:!?#$%&*|()" if c not in behind)
        word = f"{MARK}*[^\\W\\d_]+(?=[{stops}])|" if stops else ""
        self.parts = re.compile(f"{word}{MARK}+{inner}*|{inner}+" + "|\\n+" * lines)

    def part(self, part: str) -> tuple[float, int]:
        """Best score and its number of pieces (unknown characters as bytes, or one for a run of them)."""
        n = len(part)
        best, count = [0.0] + [-math.inf] * n, [0] * (n + 1)
        if not self.single.issuperset(part):
            return self._with_unknown(part, best, count)
        # The automaton lists the longest piece of a position first: among equals it stays.
        for end, (length, score) in self.matches.iter(part):
            score += best[end + 1 - length]
            if score > best[end + 1]:
                best[end + 1] = score
                count[end + 1] = count[end + 1 - length] + 1
        return best[n], count[n]

    def _with_unknown(self, part: str, best: list[float], count: list[int]) -> tuple[float, int]:
        open_run = [False] * len(best)
        ending: list[list[tuple[int, float]]] = [[] for _ in best]
        for end, match in self.matches.iter(part):
            ending[end + 1].append(match)
        for j, c in enumerate(part, 1):
            for length, score in ending[j]:
                if best[j - length] + score > best[j]:
                    best[j], count[j], open_run[j] = best[j - length] + score, count[j - length] + 1, False
            if c not in self.single and best[j - 1] + self.unknown > best[j]:
                best[j] = best[j - 1] + self.unknown
                more = len(c.encode("utf-8", "surrogatepass")) if self.byte_fallback else not open_run[j - 1]
                count[j], open_run[j] = count[j - 1] + more, True
        return best[-1], count[-1]

    def text(self, text: str | None) -> tuple[int, float]:
        """Number of pieces and score of a text; (0, 0.0) for a null or empty one."""
        if not text:
            return 0, 0.0
        found = list(map(self.known.__getitem__, self.parts.findall(MARK + text.replace(" ", MARK))))
        if len(self.known) > self.kept:
            self.known.clear()
        return sum(n for _, n in found), sum(score for score, _ in found)


def count_tokens(docs: DataFrame, model_path: str = MODEL_PATH) -> DataFrame:
    """doc_id, n_tokens (long) and score (double) for every row of ``docs`` (doc_id, text).

    Null and empty texts have 0 tokens and score 0. Texts are counted whole; other columns are ignored. The
    vocabulary is a fixed file, read once by the driver and sent to the tasks (its size is the file's).
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_pieces(model_path))

    def setup():
        counter = Counter(*vocabulary.value)
        return lambda doc_id, text: (doc_id, *counter.text(text))

    return map_rows(docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text"), setup, "doc_id long, n_tokens long, score double")
