"""Token counts under a unigram vocabulary: count-only Viterbi over Aho-Corasick matches.

The automaton lists all vocabulary entries that end at each place, longest first; for each place the dynamic program
keeps the best score and the number of tokens on that path, never the path. Tie rules are those of the `tokenizers`
library's Unigram model: a later start replaces an earlier one only with a strictly higher score (so the longest entry
wins a tie), and a character that no single-character entry covers is an unknown of the least score minus 10, which
byte fallback turns into one token for each UTF-8 byte; without byte entries a run of unknowns is one token.

Where all scores are whole numbers below 2^53 in sum, double sums are exact in any grouping; if besides no entry has
the space symbol after another character, every best path breaks before each run of spaces, and a text's count is the
sum of its units' counts. Units are then counted once and kept in a bounded per-worker table. Other vocabularies
(fractional log probabilities, entries across spaces) are counted over the whole text, with the scores summed from its
start in the library's order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .pieces import SPACE, units
from .shared import appended, table

KEPT = 400_000
#: What the library takes off the least score for an unknown character.
PENALTY = 10.0


class Unigram:
    """Entries and scores, and the automaton over the entries' characters."""

    def __init__(self, entries: list[tuple[str, float]]):
        import ahocorasick

        self.entries = entries
        self.unknown = min(s for _, s in entries) - PENALTY
        self.automaton = ahocorasick.Automaton()
        for text, score in entries:
            self.automaton.add_word(text, (len(text), float(score)))
        self.automaton.make_automaton()
        there = {p for p, _ in entries}
        #: Without all byte entries, a run of unknown characters is one token.
        self.bytes = all(f"<0x{b:02X}>" in there for b in range(256))
        #: Whether a text may be counted unit by unit.
        self.parts = (self.bytes or SPACE in there) and all(s == int(s) for _, s in entries) and not any(SPACE in p.lstrip(SPACE) for p in there)
        self.known: dict[str, int] = {}

    def count(self, unit: str) -> int:
        """Tokens of the best path over one unit, or a whole text."""
        n = len(unit)
        score = [0.0] * (n + 1)
        count = [-1] * (n + 1)
        count[0] = 0
        odd = bytearray(n + 1) if not self.bytes else None  # places whose path ends in an unknown
        done, single = 0, False  # places up to `done` are final
        for end, (size, s) in self.automaton.iter(unit):
            end += 1
            while done + 1 < end:
                done += 1
                self._unknown(unit, done, single, score, count, odd)
                single = False
            start = end - size
            got = score[start] + s
            if count[end] < 0 or got > score[end]:
                score[end], count[end] = got, count[start] + 1
            single = single or size == 1
        while done < n:
            done += 1
            self._unknown(unit, done, single, score, count, odd)
            single = False
        return count[n]

    def _unknown(self, unit: str, end: int, single: bool, score: list, count: list, odd: bytearray | None) -> None:
        """Finish a place: if no entry is its last character alone, the unknown comes last, as the latest start."""
        if not single:
            got = score[end - 1] + self.unknown
            if count[end] < 0 or got > score[end]:
                new = len(unit[end - 1].encode("utf-8", "surrogatepass")) if odd is None else 1 - odd[end - 1]
                score[end], count[end] = got, count[end - 1] + new
                if odd is not None:
                    odd[end] = 1

    def total(self, text: str | None) -> int:
        if not self.parts:
            return self.count("".join(units(text)))
        known, n = self.known, 0
        for u in units(text):
            got = known.get(u)
            if got is None:
                got = self.count(u)
                if len(known) < KEPT:
                    known[u] = got
            n += got
        return n


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Entries of a piece model file, in id order, with their scores."""
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(lib.id_to_piece(i), lib.get_score(i)) for i in range(lib.get_piece_size())]


def unigram(path: str) -> Unigram:
    """One for each worker process, while it counts."""
    return table("unigram", path, lambda: Unigram(vocabulary(path)))


def count_tokens(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """docs with n_tokens long, the tokens of each whole text; a null or empty text has 0. A column n_tokens is replaced."""

    def work(cols):
        m = unigram(path)
        return [[m.total(t) for t in cols[0]]]

    return appended(docs, [text_col], "n_tokens long", work)
