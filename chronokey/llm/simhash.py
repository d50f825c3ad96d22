"""SimHash fingerprints and exact Hamming linking through deletion-variant signatures.

A fingerprint has 64 bits and two link at `most` = 4 or fewer differing bits. Cut into three segments, two linked
fingerprints have a segment that differs by at most one bit (2 + 2 + 2 > 4). So each fingerprint is indexed once for
every bit position: the value of that bit's segment with the bit deleted. Two segments at distance 0 or 1 share such a
variant; an equality join on the variants finds every link, and the full distance is verified.

Scale: equal fingerprints (copies) collapse in a map-side combined aggregate before anything is indexed, so the index
has 64 rows of 16 bytes for each *distinct* fingerprint. A variant with more than HOT fingerprints is split: outside its
segment the 4 bits leave one of five pieces equal, so its rows are dealt by piece and value, about a seventieth of the
comparisons and none lost. A group emits only a spanning forest of its links (never all pairs), found by breadth-first
search over the unvisited rest; its fingerprints (8 bytes each) are held while it is searched.

near_copies() takes four segments, which reach 7 bits (2 + 2 + 2 + 2 > 7), as one source of the pairs it checks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby, islice, repeat
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import arrow_schema, map_texts, written

#: (first bit, width) of the segments.
SEGMENTS = ((0, 21), (21, 21), (42, 22))
MOST = 4
#: Variants of more fingerprints than this are split by the pieces (first bit, width) of the 43 or 42 other bits.
HOT = 1 << 14
PIECES = ((0, 9), (9, 9), (18, 9), (27, 8), (35, 8))
#: A group's key is its variant's, shifted by this, plus the number of its piece and value (0: the variant is whole).
SPLIT = 12
#: Groups up to this size are compared by shifted whole-batch subtraction, larger ones one by one.
SMALL = 24
#: near_copies: words of a shingle, least Jaccard similarity as a fraction, bands of the MinHash signature and hashes in each.
SHINGLE = 5
SIMILAR = (4, 5)
BANDS, IN_BAND = 30, 5
#: Its fingerprints: words of their shingles (one changed word touches few), the bits two may differ by, segments and pieces.
WIDE_SHINGLE, WIDE = 2, 7
WIDE_SEGMENTS = ((0, 16), (16, 16), (32, 16), (48, 16))
WIDE_PIECES = tuple((at, 6) for at in range(0, 48, 6))


def fingerprint(text: str | None, words_in_shingle: int = 4) -> int:
    """Fingerprint (unsigned) of one text: a bit is set if it is in over half the shingles' XXH64 (seed 42)."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: lower() is A-Z, split() is \x20 \x09-\x0D
    if not words:
        return 0
    if len(words) <= words_in_shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed=42)
    h = np.fromiter(shingle_hashes(words, words_in_shingle), dtype=np.uint64)
    return majority(h)


def shingle_hashes(words: list[bytes], k: int) -> Iterator[int]:
    from xxhash import xxh64_intdigest

    shingles = map(b" ".join, zip(*(islice(words, i, None) for i in range(k))))
    return map(xxh64_intdigest, shingles, repeat(42))


def majority(h: np.ndarray) -> int:
    """Bits set in over half of h; in blocks, so memory stays small for the longest text."""
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 1 << 14):
        block = h[at : at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(counts * 2 > len(h), bitorder="little").tobytes(), "little")


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp long, text_hash long) of every row; a null or wordless text has fingerprint 0."""

    def work(cols):
        ids, hashes, texts = cols
        return [ids, [signed(fingerprint(t)) for t in texts], hashes]

    slim = docs.select(F.col(id_col).cast("long"), F.xxhash64(F.col(text_col)), F.col(text_col))
    return map_texts(slim, "doc_id long, fp long, text_hash long", work)


def _by_segment(bit: str, segments: tuple, value: list) -> str:
    """SQL: the value given for the segment of a bit."""
    return "CASE " + " ".join(f"WHEN {bit} < {at + width} THEN {v}" for (at, width), v in zip(segments[:-1], value)) + f" ELSE {value[-1]} END"


def variants(fps: DataFrame, segments: tuple = SEGMENTS) -> DataFrame:
    """fp -> 64 rows (key, fp). key: the deleted bit's number over the segment's value with that bit cleared."""
    ones = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("bit"))
    first = F.expr(_by_segment("bit", segments, [at for at, _ in segments]))
    width = F.expr(_by_segment("bit", segments, [width for _, width in segments]))
    ones = ones.withColumn("first", first).withColumn("width", width)
    return ones.select(F.expr("(shiftleft(cast(bit AS bigint), 32)) | ((shiftrightunsigned(fp, first) & (shiftleft(1L, width) - 1)) & ~shiftleft(1L, bit - first))").alias("key"), "fp")


def grouped(fps: DataFrame, hot: int = HOT, segments: tuple = SEGMENTS, pieces: tuple = PIECES) -> DataFrame:
    """(key, fp): the variants of fps, those of more than `hot` fingerprints split into groups by piece and value.

    A variant holds the fingerprints of two segment values, so one of them has over half; counting values takes three
    rows for each fingerprint, and a variant of a value over that half is split too. The list of split variants is a
    written table, so whether it is broadcast is Spark's choice by its size on disk.
    """
    values = F.array(*(F.struct(F.lit(first).alias("first"), F.lit(width).alias("width"), F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << width) - 1)).alias("value")) for first, width in segments))
    heavy = fps.select(F.explode(values).alias("s")).groupBy("s").count().where(F.col("count") * 2 > hot)
    bits = heavy.select("s.first", "s.value", F.explode(F.expr("sequence(s.first, s.first + s.width - 1)")).alias("bit"))
    large = written(bits.select(F.expr("shiftleft(cast(bit AS bigint), 32) | (value & ~shiftleft(1L, bit - first))").alias("key"), F.lit(True).alias("large")).distinct(), "large")
    # An explicit count, as adaptive coalescing would size tasks by the small rows that go in, not the 64 that come out;
    # no column, as dealing by fp again would be taken for redundant after the aggregate.
    index = variants(fps.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))), segments)
    above = [f"shiftleft(shiftrightunsigned(fp, {at + width}), {at})" if at + width < 64 else "0L" for at, width in segments]
    rest = F.expr(_by_segment("shiftright(key, 32)", segments, [f"(fp & (shiftleft(1L, {at}) - 1)) | {high}" for (at, _), high in zip(segments, above)]))
    subs = [1 + (F.lit(i) * 512) + F.shiftrightunsigned(rest, at).bitwiseAND(F.lit((1 << width) - 1)) for i, (at, width) in enumerate(pieces)]
    parts = F.explode(F.when(F.col("large"), F.array(*subs)).otherwise(F.array(F.lit(0).cast("long"))))
    return index.join(large, "key", "left").select("key", "fp", parts.alias("sub")).select((F.shiftleft("key", SPLIT) + F.col("sub")).alias("key"), "fp")


def _canonical(key: np.ndarray, a: np.ndarray, b: np.ndarray, segments: tuple = SEGMENTS) -> np.ndarray:
    """True where key is of the first of the variants that a and b share, so that a pair is found in one variant only."""
    diff = a ^ b
    best = np.full(len(a), -1, dtype=np.int64)
    for first, width in reversed(segments):
        part = (diff >> np.uint64(first)) & np.uint64((1 << width) - 1)
        one = np.bitwise_count(part) == 1
        at = np.where(one, np.log2(np.maximum(part, 1).astype(np.float64)).astype(np.int64), 0) + first
        best = np.where(np.bitwise_count(part) <= 1, at, best)
    return best == (key >> (32 + SPLIT))


def spanning(fps: np.ndarray, most: int = MOST) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the graph that links fingerprints at `most` or fewer bits.

    Breadth first: each visited one is compared with those not visited yet, which shrink fast in a dense group.
    """
    rest = np.unique(fps)
    u, v = [], []
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            near = np.bitwise_count(rest ^ at) <= most
            if near.any():
                new = rest[near]
                rest = rest[~near]
                u.append(np.full(len(new), at, dtype=np.uint64))
                v.append(new)
                queue.extend(new)
    none = np.empty(0, dtype=np.uint64)
    return (np.concatenate(u), np.concatenate(v)) if u else (none, none)


class _Merged:
    """Union-find over what a task has linked: links inside one of its components are not emitted again."""

    def __init__(self, most: int = 500_000):
        self.up, self.most = {}, most

    def top(self, x: int) -> int:
        up = self.up
        while (p := up.get(x, x)) != x:
            up[x] = up.get(p, p)
            x = p
        return x

    def fresh(self, pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
        out = []
        for a, b in pairs:
            x, y = self.top(a), self.top(b)
            if x != y:
                self.up[max(x, y)] = min(x, y)
                self.up.setdefault(min(x, y), min(x, y))
                out.append((a, b))
        if len(self.up) > self.most:  # forgetting only repeats links
            self.up = {}
        return out


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Whole groups of equal keys, many at a time, from batches sorted by key."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        key = batch.column(0).to_numpy(zero_copy_only=False)
        fp = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
        if not len(key):
            continue
        if held and key[0] == held[-1][0][-1] and key[-1] == key[0]:
            held.append((key, fp))  # a group that goes on
            continue
        cut = int(np.searchsorted(key, key[-1]))
        yield np.concatenate([k for k, _ in held] + [key[:cut]]), np.concatenate([f for _, f in held] + [fp[:cut]])
        held = [(key[cut:].copy(), fp[cut:].copy())]
    if held:
        yield np.concatenate([k for k, _ in held]), np.concatenate([f for _, f in held])


def _links(most: int, segments: tuple):
    out = arrow_schema("u long, v long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged = _Merged()
        for key, fp in _groups(batches):
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            sizes = np.diff(np.r_[starts, len(key)])
            pairs: list[tuple[int, int]] = []
            small = np.repeat(sizes <= SMALL, sizes)
            k, f = key[small], fp[small]
            widest = int(sizes[sizes <= SMALL].max(initial=0))
            for d in range(1, widest):
                same = k[d:] == k[:-d]
                a, b, kk = f[d:][same], f[:-d][same], k[d:][same]
                near = np.bitwise_count(a ^ b) <= most
                a, b, kk = a[near], b[near], kk[near]
                first = _canonical(kk, a, b, segments)
                pairs += zip(a[first].tolist(), b[first].tolist())
            for i in np.flatnonzero(sizes > SMALL):
                a, b = spanning(fp[starts[i] : starts[i] + sizes[i]], most)
                pairs += zip(a.tolist(), b.tolist())
            if new := merged.fresh(pairs):
                arr = np.array(new, dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(arr[:, 0]), pa.array(arr[:, 1])], schema=out)

    return run


def links(fps: DataFrame, most: int = MOST, hot: int = HOT, segments: tuple = SEGMENTS, pieces: tuple = PIECES) -> DataFrame:
    """(u, v): enough of the links between distinct fingerprints to connect all that links connect."""
    reach = min(2 * len(segments), len(pieces)) - 1
    if most > reach:
        raise ValueError(f"{len(segments)} segments and {len(pieces)} pieces find links up to {reach} bits")
    return grouped(fps, hot, segments, pieces).repartition("key").sortWithinPartitions("key").mapInArrow(_links(most, segments), "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the smallest node reachable. Alternating large-star and small-star rounds.

    A node's smallest neighbour comes from a map-side combined aggregate joined back (a hot centre is split by the
    adaptive skew join), each round's table is written to the shared folder, and the loop ends when nothing changes.
    """

    def star(pairs: DataFrame, larger: bool) -> DataFrame:
        low = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        joined = pairs.join(low, "u")
        if larger:
            return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).where("u <> v")

    def both(pairs: DataFrame) -> DataFrame:
        return pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))

    def state(t: DataFrame):
        return t.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()

    now = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = state(now)
    while before[0]:
        large = star(both(now), True)
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
        now = written(star(down, False).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "stars")
        after = state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MOST) -> DataFrame:
    """One row for each row of docs: (doc_id, fp, text_hash, root, component_id).

    component_id: the smallest doc_id that links reach, itself included; root: one fingerprint of the component.
    Null and wordless texts have fingerprint 0 and link like any other. A null doc_id never is the smallest; a
    component of null ids only has a null component_id. Repeated rows stay, an empty table gives no rows.
    """
    fps = written(fingerprints(docs, id_col, text_col), "fingerprints")
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    found = components(links(nodes.select("fp"), most))
    named = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = written(named, "named")
    low = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    return fps.join(named.join(low, "root").select("fp", "root", "component_id"), "fp").select("doc_id", "fp", "text_hash", "root", "component_id")


def shingle_set(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct XXH64 (seed 42) of the text's k-word shingles; of k words or fewer the whole is the one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    return np.unique(np.fromiter(shingle_hashes(words, min(k, len(words))), dtype=np.uint64))


#: Odd multipliers of the MinHash permutations of 64-bit hashes, and an offset for each.
_MIX = np.random.default_rng(11).integers(0, 1 << 63, size=(2, BANDS * IN_BAND, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def bands(shingles: np.ndarray) -> list[int]:
    """One key for each band of the MinHash signature; a set without shingles has none."""
    from xxhash import xxh64_intdigest

    if not len(shingles):
        return []
    low = np.full(BANDS * IN_BAND, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(shingles), 1024):
        np.minimum(low, (shingles[i : i + 1024] * _MIX[0] + _MIX[1]).min(axis=1), out=low)
    return [signed(xxh64_intdigest(row.tobytes(), seed=b)) for b, row in enumerate(low.reshape(BANDS, IN_BAND))]


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the Jaccard similarity of two shingle sets is SIMILAR or more, in whole numbers."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return SIMILAR[1] * both >= SIMILAR[0] * (len(a) + len(b) - both)


def _texts(nodes: DataFrame, asked: DataFrame, docs: DataFrame, text_col: str) -> DataFrame:
    """(fp, t): a text of each node that `asked` names. Only these texts are moved."""
    named = asked.select("fp").distinct().join(nodes.select("fp", "text_hash"), "fp")
    texts = docs.select(F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(text_col).alias("t")).join(named, "text_hash")
    return texts.groupBy("fp").agg(F.first("t").alias("t"))


def _similar_pairs(cols: list) -> list[list]:
    """Of the pairs (u, v, text of u, text of v) those that are similar."""
    last, one, keep = None, None, []
    for u, v, tu, tv in zip(*cols):
        if u != last:
            last, one = u, shingle_set(tu)
        if similar(one, shingle_set(tv)):
            keep.append((u, v))
    return [[u for u, _ in keep], [v for _, v in keep]]


def _set_bytes(cols: list) -> list[list]:
    return [cols[0], [shingle_set(t).tobytes() for t in cols[1]]]


def _joined(roots: tuple[int, ...], sets: list[np.ndarray], merged: _Merged) -> list[tuple[int, int]]:
    """Pairs of roots that similar sets of one group join, without those joined before; each set against the later ones.

    A set's common shingles with all others are counted at once through the rows that hold each shingle.
    """
    size = np.array([len(x) for x in sets])
    _, col = np.unique(np.concatenate(sets), return_inverse=True)
    at = np.r_[0, np.cumsum(size)]
    order = np.argsort(col, kind="stable")
    holders = np.repeat(np.arange(len(sets)), size)[order]  # rows by shingle
    ends = np.r_[0, np.cumsum(np.bincount(col))]
    pairs = []
    for i in range(len(sets) - 1):
        both = np.bincount(np.concatenate([holders[ends[c] : ends[c + 1]] for c in col[at[i] : at[i + 1]].tolist()]), minlength=len(sets))
        near = np.flatnonzero(SIMILAR[1] * both >= SIMILAR[0] * (size + size[i] - both))
        pairs += merged.fresh([(roots[i], roots[j]) for j in near[near > i].tolist() if roots[i] != roots[j]])
    return pairs


def _group_links():
    """Rows (key, root, set) sorted by key -> links between the roots of each group; one group is held at a time."""
    out = arrow_schema("u long, v long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged = _Merged()
        rows = (r for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in range(3))))
        for _, group in groupby(rows, itemgetter(0)):
            _, roots, held = zip(*group)
            if new := _joined(roots, [np.frombuffer(x, dtype=np.uint64) for x in held], merged):
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*new)], schema=out)

    return run


def _by_fingerprint(nodes: DataFrame) -> DataFrame:
    """(a, b): pairs of nodes (fp, n) whose fingerprints `sim` are equal or linked at WIDE bits, each sim by its smallest node."""
    node = F.struct("fp", "n")
    sims = written(nodes.groupBy("sim").agg(F.min(node).alias("rep"), F.count("*").alias("c")), "sims")
    equal = nodes.join(sims.where("c > 1"), "sim").where("fp <> rep.fp").select(F.col("rep").alias("a"), node.alias("b"))
    found = written(links(sims.select(F.col("sim").alias("fp")), WIDE, HOT, WIDE_SEGMENTS, WIDE_PIECES), "links")
    ends = (sims.select(F.col("sim").alias(k), F.col("rep").alias(r)) for k, r in (("u", "a"), ("v", "b")))
    return found.join(next(ends), "u").join(next(ends), "v").select("a", "b").union(equal)


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: (doc_id, fp, text_hash, root), components of texts whose word shingles are similar.

    Two texts link at a Jaccard similarity of SIMILAR or more over SHINGLE-word shingles (of lower-case words), checked
    exactly on the texts. Pairs come from SimHash fingerprints that differ by WIDE or fewer bits, through the variants of
    links() in four segments, and, as similar texts may differ by more bits, from MinHash bands: a pair at exactly that
    similarity shares none with probability (1 - 0.8^5)^30 = 7e-6, a closer pair less. fp names the shingle set, so equal
    sets are one node; null and wordless texts are one node. First the fingerprints' links are checked and each band's
    nodes are held against the smallest of them; groups that this leaves in several components are then compared in place,
    set by set, and their pairs never become rows.
    """

    def work(cols):
        ids, hashes, texts = cols
        sets = [shingle_set(t) for t in texts]
        from xxhash import xxh64_intdigest

        sims = [signed(fingerprint(t, WIDE_SHINGLE)) for t in texts]
        return [ids, hashes, [signed(xxh64_intdigest(s.tobytes(), seed=42)) for s in sets], [len(s) for s in sets], [bands(s) for s in sets], sims]

    slim = docs.select(F.col(id_col).cast("long"), F.xxhash64(F.col(text_col)), F.col(text_col))
    rows = written(map_texts(slim, "doc_id long, text_hash long, fp long, n long, keys array<long>, sim long", work), "sketches")
    nodes = written(rows.groupBy("fp").agg(F.min("text_hash").alias("text_hash"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.min("sim").alias("sim")), "sets")

    def near(a: str, b: str):  # sets whose sizes differ by more can't be similar
        return SIMILAR[1] * F.least(a, b) >= SIMILAR[0] * F.greatest(a, b)

    index = nodes.select("fp", "n", F.explode("keys").alias("key"))
    shared = index.groupBy("key").agg(F.count("*").alias("c"), F.min(F.struct("fp", "n")).alias("low")).where("c > 1").select("key", "low")
    meets = written(index.join(shared, "key").select("key", "fp", "n", F.col("low.fp").alias("low"), F.col("low.n").alias("low_n")), "meets")
    stars = meets.where(F.col("fp") != F.col("low")).select(F.struct(F.col("low").alias("fp"), F.col("low_n").alias("n")).alias("a"), F.struct("fp", "n").alias("b"))
    pairs = _by_fingerprint(nodes).union(stars).where(near("a.n", "b.n"))
    pairs = written(pairs.select(F.least("a.fp", "b.fp").alias("u"), F.greatest("a.fp", "b.fp").alias("v")).distinct(), "pairs")
    texts = written(_texts(nodes, pairs.select(F.col("u").alias("fp")).union(pairs.select("v")), docs, text_col), "texts")
    rows_of = pairs.join(texts.toDF("v", "tv"), "v").join(texts.toDF("u", "tu"), "u").select("u", "v", "tu", "tv")
    edges = written(map_texts(rows_of, "u long, v long", _similar_pairs), "similar")
    found = written(components(edges), "stars")
    placed = meets.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("key", "fp", F.coalesce("root", "fp").alias("root"))
    several = placed.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count("*").alias("c"))
    # A group of two has no pair but the one checked above.
    rest = written(placed.join(several.where("a < b AND c > 2").select("key"), "key"), "open")
    sets = map_texts(_texts(nodes, rest, docs, text_col), "fp long, held binary", _set_bytes)
    rest = rest.join(written(sets, "held"), "fp").select("key", "root", "held").repartition("key").sortWithinPartitions("key")
    more = written(rest.mapInArrow(_group_links(), "u long, v long"), "joined")
    found = components(edges.union(more))
    return rows.select("doc_id", "fp", "text_hash").join(found.withColumnRenamed("node", "fp"), "fp", "left").select("doc_id", "fp", "text_hash", F.coalesce("root", "fp").alias("root"))


def one_of_each(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each component of near_duplicates(docs) or near_copies(docs): the smallest doc_id (nulls last), then text hash.

    Rows repeated in id and text count as one. Columns come back as they were, whatever their names.
    """
    found = written(found.select("doc_id", "text_hash", "root"), "components")
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("s"))
    first = first.select("root", F.col("s.doc_id").alias("f_id"), F.col("s.text_hash").alias("f_hash"))
    copies = found.groupBy("doc_id", "text_hash").count()
    keep = first.join(copies, [F.col("f_id").eqNullSafe(F.col("doc_id")), F.col("f_hash") == F.col("text_hash")])
    keep = keep.select(F.col("f_id").alias("k_id"), F.col("f_hash").alias("k_hash"), (F.col("count") > 1).alias("k_many")).distinct()
    ident, text = (F.col(f"c{docs.columns.index(c)}") for c in (id_col, text_col))
    rows = docs.toDF(*(f"c{k}" for k in range(len(docs.columns)))).join(keep, [ident.cast("long").eqNullSafe(F.col("k_id")), F.xxhash64(text) == F.col("k_hash")])
    own = [F.col(f"c{k}").alias(c) for k, c in enumerate(docs.columns)]
    many = rows.where("k_many").dropDuplicates(["k_id", "k_hash"])  # only rows that repeat are compared
    return rows.where("NOT k_many").select(*own).union(many.select(*own))
