"""Exact merge-type SentencePiece encoding and decoding, with a score-ordered agenda of adjacent symbol pairs.

For models with the identity normalizer, a dummy prefix, escaped spaces and byte fallback. The agenda merges, time and
again, the adjacent pair whose joined piece scores highest, leftmost first on ties; stale entries are skipped.

No piece of such a vocabulary has the space symbol after another character, so nothing merges across the start of a
run of spaces: a text's encoding is its units' encodings in order, where a unit is a run of spaces with the characters
up to the next one. Units are encoded once and kept in a bounded per-worker table; inside a unit, characters that are
adjacent in no piece part it further. Each new unit is checked against the sentencepiece library, one library call for
each Arrow batch; a difference raises an error.
"""

from __future__ import annotations

import hashlib
import heapq
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import appended, map_texts, table

SPACE = "▁"
#: Units kept by a worker. Beyond them a unit is encoded anew, with the same result.
KEPT = 400_000
#: Runs inside units kept by a worker.
KEPT_RUNS = 100_000
NEVER = 1 << 30


class PieceModel:
    """The pieces of a model file, by text: id, score and kind."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        n = lib.get_piece_size()
        self.text = [lib.id_to_piece(i) for i in range(n)]
        self.score = [lib.get_score(i) for i in range(n)]
        self.unknown = lib.unk_id()
        plain = [i for i in range(n) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i))]
        self.id = {self.text[i]: i for i in plain}
        self.of_byte = {int(self.text[i][3:5], 16): i for i in range(n) if lib.is_byte(i)}
        self.byte_of = {i: b for b, i in self.of_byte.items()}
        self.silent = {i for i in range(n) if lib.is_control(i)}
        self.last_special = max([self.unknown, *self.silent, *self.byte_of])
        if len(self.of_byte) != 256 or any(SPACE in p.lstrip(SPACE) for p in self.id):
            raise ValueError(f"{path} has no byte fallback, or pieces with inner spaces")
        #: (rank, id) of a piece: smaller ranks merge first, equal scores share a rank.
        order = {s: k for k, s in enumerate(sorted({self.score[i] for i in plain}, reverse=True))}
        self.rank = {self.text[i]: order[self.score[i]] for i in plain}
        self.adjacent = {p[k : k + 2] for p in self.id for k in range(len(p) - 1)}
        self.parts: dict[str, list[str]] = {}

    def merge(self, chars: str) -> list[str]:
        """Agenda over one run of characters: the pieces that remain."""
        if len(chars) > 48:
            return self._merge_heap(chars)
        # A short agenda is a list by place: the least rank is its top, and index() finds the leftmost.
        rank = self.rank.get
        piece = list(chars)
        agenda = [rank(a + b, NEVER) for a, b in zip(piece, piece[1:])]
        while agenda:
            top = min(agenda)
            if top == NEVER:
                break
            k = agenda.index(top)
            piece[k : k + 2] = [joined := piece[k] + piece[k + 1]]
            del agenda[k]
            if k:
                agenda[k - 1] = rank(piece[k - 1] + joined, NEVER)
            if k < len(agenda):
                agenda[k] = rank(joined + piece[k + 1], NEVER)
        return piece

    def _merge_heap(self, chars: str) -> list[str]:
        n = len(chars)
        piece, rank = list(chars), self.rank
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda = [(r, i, i + 1, 2) for i in range(n - 1) if (r := rank.get(chars[i : i + 2])) is not None]
        heapq.heapify(agenda)
        while agenda:
            _, left, right, size = heapq.heappop(agenda)
            a, b = piece[left], piece[right]
            if not a or not b or len(a) + len(b) != size or after[left] != right:
                continue
            piece[left], piece[right] = a + b, ""
            after[left] = far = after[right]
            if far >= 0:
                before[far] = left
                if (r := rank.get(joined := a + b + piece[far])) is not None:
                    heapq.heappush(agenda, (r, left, far, len(joined)))
            if (near := before[left]) >= 0 and (r := rank.get(joined := piece[near] + a + b)) is not None:
                heapq.heappush(agenda, (r, near, left, len(joined)))
        return [p for p in piece if p]

    def cut(self, unit: str) -> list[str]:
        """Runs of a unit between which no piece can reach."""
        adjacent = self.adjacent
        at = [k for k in range(1, len(unit)) if unit[k - 1 : k + 1] not in adjacent]
        return [unit[a:b] for a, b in zip([0, *at], [*at, len(unit)])] if at else [unit]

    def encode_unit(self, unit: str) -> list[int]:
        ids: list[int] = []
        for run in self.cut(unit):
            if (got := self.parts.get(run)) is None:
                found = self.merge(run)
                got = [*map(self.id.get, found)]
                if None in got:
                    got = [x for p, i in zip(found, got) for x in ([i] if i is not None else [self.of_byte[b] for b in p.encode()])]
                if len(self.parts) < KEPT_RUNS:
                    self.parts[run] = got
            ids += got
        return ids

    def encode(self, text: str | None) -> list[int]:
        return [i for u in units(text) for i in self.encode_unit(u)]

    def decode(self, ids: list[int]) -> str:
        """The library's decode(ids): joined pieces without the dummy prefix, byte runs as UTF-8, invalid bytes as U+FFFD."""
        if min(ids, default=0) > self.last_special:
            joined = "".join([self.text[i] for i in ids])
            return (joined[1:] if joined.startswith(SPACE) else joined).replace(SPACE, " ")
        out: list[str] = []
        run = bytearray()
        first = True
        for i in ids:
            if (b := self.byte_of.get(i)) is not None:
                run.append(b)
                first = False
                continue
            if run:
                out.append(utf8(run))
                run.clear()
            if i in self.silent:
                continue
            p = " ⁇ " if i == self.unknown else self.text[i]
            if first and p.startswith(SPACE):
                p = p[1:]
            first = False
            out.append(p.replace(SPACE, " "))
        if run:
            out.append(utf8(run))
        return "".join(out)


def utf8(run: bytes) -> str:
    """Valid characters of a run of bytes, U+FFFD for each byte that is in none."""
    try:
        return run.decode()
    except UnicodeDecodeError as e:
        return bytes(run[: e.start]).decode() + "�" + utf8(bytes(run[e.start + 1 :]))


def units(text: str | None) -> list[str]:
    """Units of a text with the dummy prefix: runs of the space symbol with what follows them."""
    if not text:
        return []
    marked = SPACE + text.replace(" ", SPACE)
    if SPACE * 2 not in marked and not marked.endswith(SPACE):
        return [SPACE + w for w in marked[1:].split(SPACE)]
    return re.findall(f"{SPACE}+[^{SPACE}]*", marked)


def model(path: str) -> PieceModel:
    """One for each worker process, while it encodes."""
    return known_units(path).m


class _Known(dict):
    """unit -> its ids, joined by commas. odd: what a unit decodes to, where that isn't the unit with spaces."""

    def __init__(self, m: PieceModel):
        self.m, self.new, self.odd = m, [], {}

    def __missing__(self, unit: str) -> str:
        ids = self.m.encode_unit(unit)
        got = ",".join(map(str, ids))
        # As a later unit, the leading space symbol isn't the dummy prefix.
        if (back := " " + self.m.decode(ids)) != unit.replace(SPACE, " "):
            self.odd[unit] = back
        self.new.append((unit, ids))
        if len(self) < KEPT:
            self[unit] = got
        return got

    def check(self) -> None:
        """Hold the new units against the library, in one call."""
        if not self.new:
            return
        want = self.m.library.encode([u[1:].replace(SPACE, " ") for u, _ in self.new], num_threads=1)
        for (u, ids), w in zip(self.new, want, strict=True):
            if ids != w and u != SPACE:  # the library gives no ids for an empty text
                raise ValueError(f"unit {u!r}: ids {ids}, the library's {w}")
        self.new.clear()


def known_units(path: str) -> _Known:
    return table("pieces", path, lambda: _Known(PieceModel(path)))


def encode_lines(path: str, texts: list[str | None], checked: bool = True):
    """(ids joined by commas, decoded text) of each text."""
    known = known_units(path)
    odd = known.odd
    for text in texts:
        parts = units(text)
        line = ",".join([known[u] for u in parts])
        if odd and not odd.keys().isdisjoint(parts):
            back = "".join([odd.get(u) or u.replace(SPACE, " ") for u in parts])[1:]
        else:
            back = "".join(parts)[1:].replace(SPACE, " ")
        if len(known.new) > 10_000:
            known.check() if checked else known.new.clear()
        yield line, back
    known.check() if checked else known.new.clear()


def encode_columns(path: str, texts: list[str | None], checked: bool = True) -> list[list]:
    """Number of ids, and SHA-256 of ids and of decoded text, of each text."""
    counts, digests, decoded = [], [], []
    for line, back in encode_lines(path, texts, checked):
        counts.append(line.count(",") + 1 if line else 0)
        digests.append(hashlib.sha256(line.encode()).hexdigest())
        decoded.append(hashlib.sha256(back.encode()).hexdigest())
    return [counts, digests, decoded]


def id_columns(path: str, texts: list[str | None], checked: bool = True) -> list[list]:
    """Ids as arrays, and the decoded text, of each text."""
    ids, decoded = [], []
    for line, back in encode_lines(path, texts, checked):
        ids.append(np.fromstring(line, dtype=np.int32, sep=",") if line else np.empty(0, np.int32))
        decoded.append(back)
    return [ids, decoded]


def encode(docs: DataFrame, path: str, text_col: str = "text", checked: bool = True) -> DataFrame:
    """docs with ids array<int> and decoded string of every whole text; columns of these names are replaced.

    A null text is an empty one: no ids, decoded "". Repeated rows and any other column pass through.
    """
    return appended(docs, [text_col], "ids array<int>, decoded string", lambda c: id_columns(path, c[0], checked))


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", checked: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text, without moving ids between processes."""

    def work(cols):
        return [cols[0], *encode_columns(path, cols[1], checked)]

    slim = docs.select(F.col(id_col).cast("long"), F.col(text_col))
    return map_texts(slim, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", work)
