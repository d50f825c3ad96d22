"""Toxicity: Levenshtein automata intersected with a lexicon trie, and context windows that part quotation from abuse.

Lexicon: whole words and word stems whose document frequency in toxic rows, against clean rows, has a likelihood ratio
no chance would give; learnt from at most `SAMPLE` labelled ids (by hash of the id), one text each. All that pass are
entries, whatever their number and length. Matching: a word's Levenshtein
automaton (bit-parallel: one register of reachable places for each number of edits) walks the trie of all entries
together, so misspelt terms match at one edit, or two from ten characters on; a stem matches any word that begins
within the edits. Pieces of the entries sieve out words no entry can match (of e + 1 pieces one is whole, at its place
or e beside it). A word that clean labelled rows use isn't a misspelling. Context: the words within `WINDOW` of a match say whether it stands in quotation marks or by a word of
reporting, or by one of address. Logistic weights over these sums turn them into a score.

Scale: the fit is bounded by the sample, and so are the lexicon and the weights that are broadcast; texts are scored
whole in one pass without a shuffle, and matches are kept by word in a bounded per-worker table.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import appended, arrow_schema, map_texts, one_text_each, slices, table, written

SAMPLE = 12_000
#: Least likelihood ratio (2 ln) of an entry and its least log odds.
LEAST_RATIO, LEAST_ODDS = 17.5, 3.0
WINDOW = 6
#: Longest stem; kept terms that mark a row fully.
STEM = 8
ENOUGH = 10
KEPT = 200_000
QUOTES = "\"'“”„‟«»‹›‘’`"
EDGES = QUOTES + ".,;:!?()[]{}<>|*#$%&@~^_-+=/\\…"
REPORTING = frozenset("said says saying wrote writes called calls quoted quote quotes term word words reported stated dit écrit mot sagte schrieb wort dijo escribió palabra".split())
ADDRESS = frozenset("you your you're youre u ur du dich dir tu toi te vous ihr tú usted ti".split())
FEATURES = ("bias", "exact", "stem", "quoted", "addressed", "density")


def edits(size: int) -> int:
    return 0 if size < 4 else 1 if size < 10 else 2


class Trie:
    """All entries in one trie; find() intersects it with a word's Levenshtein automaton."""

    def __init__(self, entries: dict[str, float]):
        self.next: list[dict[str, int]] = [{}]
        self.entry: list[str | None] = [None]
        self.allowed: list[int] = [0]  # most edits of any entry below
        self.weight = entries
        for text in entries:
            node, chars = 0, text.rstrip("*")
            most = edits(len(chars)) if not text.endswith("*") else min(1, edits(len(chars) - 1))
            for c in chars + ("*" if text.endswith("*") else ""):
                self.allowed[node] = max(self.allowed[node], most)
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                    self.entry.append(None)
                    self.allowed.append(0)
                node = self.next[node][c]
            self.entry[node] = text
            self.allowed[node] = max(self.allowed[node], most)
        self.longest = max(map(len, entries), default=0) + 2  # no edits bridge more
        self.sieve = Sieve(entries)

    def find(self, word: str) -> tuple[str, int] | None:
        """The entry with the fewest edits to word (or to a beginning of it, for a stem), then the heaviest."""
        word = word[: self.longest + 1]
        if not self.sieve.may_match(word):
            return None
        n, masks = len(word), {}
        for i, c in enumerate(word):
            masks[c] = masks.get(c, 0) | 1 << i
        last, found = 1 << n, []
        # Register e: bit i is set if i characters of word are read with e edits so far.
        most = self.allowed[0]
        start = tuple((1 << (e + 1)) - 1 for e in range(most + 1))
        stack = [(0, start)]
        while stack:
            node, state = stack.pop()
            if (entry := self.entry[node]) is not None and entry[-1] != "*":
                size = len(entry)
                for e in range(min(edits(size), most) + 1):
                    if state[e] & last:
                        found.append((e, -self.weight[entry], entry))
                        break
            for c, child in self.next[node].items():
                if c == "*":
                    entry = self.entry[child]
                    for e in range(min(1, edits(len(entry) - 2), most) + 1):
                        if state[e]:
                            found.append((e, -self.weight[entry], entry))
                            break
                    continue
                mask, before, step = masks.get(c, 0), 0, []
                for e in range(self.allowed[child] + 1):
                    now = (state[e] & mask) << 1
                    if e:
                        # an extra entry character, another one, or an extra word character
                        now |= state[e - 1] | state[e - 1] << 1 | before << 1
                    now &= (last << 1) - 1
                    step.append(now)
                    before = now
                step = tuple(step)
                if any(step):
                    stack.append((child, step))
        if not found:
            return None
        e, _, entry = min(found)
        return entry, e


class Sieve:
    """Pieces of the entries with the places at which they may stand; says no only where no entry can match."""

    def __init__(self, entries: dict[str, float]):
        import ahocorasick

        places: dict[str, set[tuple[int, int]]] = {}
        self.any = False
        for text in entries:
            chars, stem = text.rstrip("*"), text.endswith("*")
            e = min(1, edits(len(chars) - 1)) if stem else edits(len(chars))
            bounds = [len(chars) * i // (e + 1) for i in range(e + 2)]
            for a, b in zip(bounds, bounds[1:]):
                places.setdefault(chars[a:b], set()).add((a, e))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), tuple(where)))
            self.any = True
        if self.any:
            self.automaton.make_automaton()

    def may_match(self, word: str) -> bool:
        if not self.any:
            return False
        for end, (size, where) in self.automaton.iter(word):
            start = end + 1 - size
            for place, e in where:
                if -e <= start - place <= e:
                    return True
        return False


@dataclass
class ToxicModel:
    """Entries with their log odds, and the weights of FEATURES."""

    entries: dict[str, float]
    #: Words of clean rows that are near an entry, and so no misspellings.
    plain: frozenset = frozenset()
    weights: np.ndarray = field(default_factory=lambda: np.zeros(len(FEATURES)))


class _Words(dict):
    """Word as it stands -> None, or (kind, weight, stands in marks)."""

    def __init__(self, model: ToxicModel):
        self.trie, self.plain = Trie(model.entries), model.plain

    def __missing__(self, word: str):
        bare = word.lower().strip(EDGES)
        got = None
        if len(bare) >= 3 and (hit := self.trie.find(bare)) is not None:
            entry, e = hit
            kind = "stem" if entry[-1] == "*" else "exact"
            if not e or bare not in self.plain:
                got = (kind, self.trie.weight[entry] / (1 + e), word[0] in QUOTES or word.rstrip(".,;:!?)")[-1:] in QUOTES)
        if len(self) < KEPT:
            self[word] = got
        return got


def context(words: list[str], at: int) -> tuple[bool, bool]:
    """Whether a match is quoted (open marks to the left and closing ones to the right, or reporting words), or addressed."""
    left, right = words[max(0, at - WINDOW) : at], words[at + 1 : at + 1 + WINDOW]
    near = {w.lower().strip(EDGES) for w in (*left, *right)}
    opened = any(w[0] in QUOTES for w in left) and any(w.rstrip(".,;:!?)")[-1:] in QUOTES for w in right if w)
    return opened or bool(near & REPORTING), bool(near & ADDRESS)


def measure(look: _Words, text: str | None) -> list[float]:
    """FEATURES of one whole text."""
    words = (text or "").split()
    hits = [(i, got) for i, w in enumerate(words) if (got := look[w]) is not None]
    sums = Counter()
    for i, (kind, weight, marked) in hits:
        quoted, addressed = context(words, i)
        sums["quoted" if quoted or marked else kind] += weight
        sums["addressed"] += weight * addressed
    return [1.0, *(math.log1p(sums[f]) for f in FEATURES[1:-1]), math.log1p(100.0 * len(hits) / max(1, len(words)))]


def candidates(text: str | None) -> set[str]:
    """Entries a text could support: its words, and their beginnings of four characters or more as stems."""
    found = set()
    for w in {x.lower().strip(EDGES) for x in (text or "").split()}:
        if len(w) >= 3:
            found.add(w)
            found.update(w[:k] + "*" for k in range(4, min(len(w), STEM + 1)))
    return found


def lexicon(rows: DataFrame) -> dict[str, float]:
    """rows (t, toxic) -> entries with log odds, none of which begins with a stem among them."""
    out = arrow_schema("term string, bad long, good long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                bad, good = Counter(), Counter()
                for text, toxic in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    (bad if toxic else good).update(candidates(text))
                keys = list(bad.keys() | good.keys())
                yield pa.RecordBatch.from_arrays([pa.array(keys, out.field(0).type), pa.array([bad[k] for k in keys], pa.int64()), pa.array([good[k] for k in keys], pa.int64())], schema=out)

    rows = rows.dropDuplicates(["t", "toxic"])  # copies of a text are one witness
    n = rows.agg(F.count(F.when(F.col("toxic") == 1, 1)).alias("bad"), F.count(F.when(F.col("toxic") == 0, 1)).alias("good")).first()
    if not n["bad"] or not n["good"]:
        return {}
    counts = rows.mapInArrow(run, "term string, bad long, good long").groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    b, g = float(n["bad"]), float(n["good"])
    p = b / (b + g)
    seen = F.col("bad") + F.col("good")
    part = F.col("bad") / seen
    ratio = 2 * seen * (part * F.log(part / p) + F.when(part < 1, (1 - part) * F.log((1 - part) / (1 - p))).otherwise(0.0))
    odds = F.log((F.col("bad") + 0.5) / (b + 1)) - F.log((F.col("good") + 0.5) / (g + 1))
    top = counts.where("bad > 1").withColumn("ratio", ratio).withColumn("odds", odds).where((F.col("ratio") >= LEAST_RATIO) & (F.col("odds") >= LEAST_ODDS))
    # Ties: the longest, a whole word before a stem. Only words of the sample's toxic rows are collected.
    top = top.orderBy(F.desc("ratio"), F.desc(F.length("term") - F.when(F.col("term").endswith("*"), 1.5).otherwise(0.0)), "term").select("term", "odds", "bad", "good").collect()
    terms = rows.sparkSession.sparkContext.broadcast(frozenset(r["term"] for r in top))

    def work(cols):
        return [[sorted(candidates(t) & terms.value) for t in cols[0]]]

    held = [r["held"] for r in map_texts(rows.where("toxic = 1").select("t"), "held array<string>", work).where("size(held) > 0").collect()]
    return _uncovered([(r["term"], float(r["odds"]), r["bad"], r["good"]) for r in top], held, p)


def likelihood_ratio(bad: int, good: int, p: float) -> float:
    """2 ln of the likelihood ratio of bad toxic rows among bad + good, against the share p."""
    n, q = bad + good, bad / (bad + good)
    return 2 * n * ((q * math.log(q / p) if q else 0.0) + ((1 - q) * math.log((1 - q) / (1 - p)) if q < 1 else 0.0))


def _uncovered(top: list[tuple[str, float, int, int]], held: list[list[str]], p: float) -> dict[str, float]:
    """Of (term, odds, bad, good), strongest first, those that say something their betters don't. held: the terms of each toxic row.

    A row that holds `ENOUGH` kept terms is marked by them and no witness for a further one; a term needs the least
    ratio from the other rows alone. So the words of one much copied or shared passage don't all become entries. What
    begins with a stem that is kept goes; so does a stem nine tenths of whose rows its kept extensions stand for, and
    extensions of a stem that adds to them.
    """
    where: dict[str, list[int]] = {}
    for i, terms in enumerate(held):
        for t in terms:
            where.setdefault(t, []).append(i)
    marks = [0] * len(held)
    kept: dict[str, tuple[float, int]] = {}
    below: dict[str, set[str]] = {}  # beginning -> kept terms that have it
    for term, odds, bad, good in top:
        chars = term.rstrip("*")
        begins = [chars[:k] for k in range(4, min(len(chars), STEM) + 1)]
        rows = where.get(term, [])
        left = sum(marks[i] < ENOUGH for i in rows)
        if any(b + "*" in kept for b in begins) or not left or likelihood_ratio(left, good, p) < LEAST_RATIO:
            continue
        longer = below.get(chars, set()) if term.endswith("*") else set()
        if sum(kept[t][1] for t in longer) >= 0.9 * bad:
            continue
        for t in list(longer):
            del kept[t]
            for i in where[t]:
                marks[i] -= 1
            for b in (t.rstrip("*")[:k] for k in range(4, min(len(t.rstrip("*")), STEM) + 1)):
                below[b].discard(t)
        kept[term] = (odds, bad)
        for i in rows:
            marks[i] += 1
        for b in begins:
            below.setdefault(b, set()).add(term)
    return {t: odds for t, (odds, _) in kept.items()}


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 40) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the first column (bias) isn't shrunk."""
    w, shrink = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    shrink[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + shrink * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(shrink + 1e-9)
        step = np.linalg.solve(hess, grad)
        w = w - step * min(1.0, 4 / max(1e-9, float(np.abs(step).max())))
    return w


def _near(rows: DataFrame, model: ToxicModel) -> DataFrame:
    """(word): distinct words of rows that match an entry with edits only."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    out = arrow_schema("word string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, seen = Trie(shared.value.entries), set()
        for batch in batches:
            new = {w.lower().strip(EDGES) for t in batch.column(0).to_pylist() for w in (t or "").split()} - seen
            seen |= new
            hits = [w for w in new if len(w) >= 3 and (hit := trie.find(w)) is not None and hit[1]]
            yield pa.RecordBatch.from_arrays([pa.array(hits, pa.string())], schema=out)

    return rows.select("t").mapInArrow(run, "word string").distinct()


def train(docs: DataFrame, labels: DataFrame, use: Column, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> ToxicModel:
    """Learn from at most `sample` labelled ids (rows where `use` holds; by hash of the id). Null ids and labels are no labels.

    An id with labels of both kinds is toxic; of an id's several rows one counts, by hash of the text. Without a label of either kind there is no lexicon and each score is the share of toxic labels, or 0.
    """
    rated = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & use).select(F.col(id_col).cast("long").alias("l_id"), F.col(label_col).cast("int").alias("toxic"))
    rows = one_text_each(docs, rated.groupBy("l_id").agg(F.max("toxic").alias("toxic")), "l_id", id_col, text_col, sample)
    rows = written(rows.select("t", "toxic"), "labelled")
    entries = lexicon(rows)
    bare = ToxicModel(entries)
    bare.plain = frozenset(r["word"] for r in _near(rows.where("toxic = 0"), bare).collect())  # bounded by the sample
    shared = docs.sparkSession.sparkContext.broadcast(bare)

    def work(cols):
        look = _Words(shared.value)
        return [[measure(look, t) for t in cols[0]], cols[1]]

    got = map_texts(rows, "x array<double>, toxic int", work).toPandas()
    if not len(got):
        return ToxicModel(entries, bare.plain, np.array([-30.0] + [0.0] * (len(FEATURES) - 1)))
    x, y = np.array(got["x"].tolist(), dtype=float), got["toxic"].to_numpy(dtype=float)
    return ToxicModel(entries, bare.plain, logistic(x, y))


def score(docs: DataFrame, model: ToxicModel, text_col: str = "text") -> DataFrame:
    """docs with toxicity double, the probability of the toxic label, from the whole text alone; a clashing column is replaced.

    A null or wordless text has the score of one without matches.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    tag = uuid.uuid4().hex  # workers live on: their tables are for one model

    def work(cols):
        m = shared.value
        look = table("toxicity", tag, lambda: _Words(m))
        x = np.array([measure(look, t) for t in cols[0]], dtype=float).reshape(-1, len(FEATURES))
        return [(1 / (1 + np.exp(-np.clip(x @ m.weights, -30, 30)))).tolist()]

    return appended(docs, [text_col], "toxicity double", work)
