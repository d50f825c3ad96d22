"""Approximate nearest neighbours by cosine: a forest of random-projection trees, one priority queue over all of them.

Fit: each tree splits a bounded sample (`SAMPLE` vectors or `SAMPLE_BYTES`, by hash of the id) at the median of a random
projection; trees deepen with the table until a leaf holds `ROWS` of its rows or `LEAF` vectors of the sample. Every row
is routed to its leaf in each tree. Search: one queue holds the nodes of all trees by the squared margins crossed so
far; leaves are opened, nearest first, until those opened hold the budget (rows, with multiplicity over the trees). The
candidates of an opened leaf are reranked exactly, in double precision on the original vectors.

Budget: measured. The forest is searched for `ASKED` vectors of the sample, whose nearest are known, and the budget is
the share of leaves that finds `RECALL` of them: a few leaves on clustered data, many on data without structure, where
no index does better and the recall asked for has its price (see the README). The number of leaves opened doesn't grow
with the table; a leaf's rows do once the sample can't part them further (beyond SAMPLE / LEAF * ROWS rows).

Scale: equal vectors collapse to one class first (a vector held by a third of all rows is indexed once; a class keeps
its k + 1 smallest ids, which is all a k-nearest result can use). Leaf contents meet their queries by an equality join
on (tree, leaf, slice, block): a leaf's rows are dealt over slices, its queries over blocks of `BLOCK`. Rows stream past
the queries of their block; a task holds one block and k + 1 best each, never a leaf.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import arrow_schema, written

SAMPLE, SAMPLE_BYTES = 50_000, 32 << 20
TREES = 16
#: Least vectors of the sample in a leaf, and rows of the table in one that is split no further.
LEAF, ROWS = 32, 256
#: Vectors of the sample that are searched for to measure the budget, the share of their nearest it is to find, and the
#: factor on top.
ASKED, RECALL, MARGIN = 128, 0.95, 1.1
#: Rows of each tree that a search opens at least: small tables are searched whole.
LEAST = 64
#: Rows of a leaf that one task reads, and queries it holds.
SLICE, BLOCK = 20_000, 2_048
#: Cells of the queries-by-rows matrices that are made at once.
CELLS = 1 << 21


class Forest:
    """Random projections of unit vectors; node n of a tree has children 2n + 1 (below) and 2n + 2 (above)."""

    def __init__(self, sample: np.ndarray, trees: int, depth: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.trees, self.depth, self.inner = trees, depth, 2**depth - 1
        dim = sample.shape[1] if sample.ndim == 2 else 0
        self.normal = rng.standard_normal((trees, self.inner, dim))
        self.normal /= np.maximum(np.linalg.norm(self.normal, axis=2, keepdims=True), 1e-300)
        self.cut = np.zeros((trees, self.inner))
        for t in range(trees):
            at = np.zeros(len(sample), dtype=np.int64)
            for level in range(depth):
                side = np.einsum("ij,ij->i", sample, self.normal[t, at]) if len(sample) else np.empty(0)
                order = np.argsort(at, kind="stable")
                for node, values in zip(*_split(at[order], side[order])):
                    self.cut[t, node] = np.median(values)
                at = 2 * at + 1 + (side > self.cut[t, at])
        self.sizes: np.ndarray | None = None

    def leaves(self, unit: np.ndarray) -> np.ndarray:
        """Leaf number of each vector in each tree."""
        out = np.empty((len(unit), self.trees), dtype=np.int32)
        for t in range(self.trees):
            at = np.zeros(len(unit), dtype=np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (np.einsum("ij,ij->i", unit, self.normal[t, at]) > self.cut[t, at])
            out[:, t] = at - self.inner
        return out

    def probe(self, unit: np.ndarray, budget: float) -> list[tuple[int, int]]:
        """(tree, leaf) opened for one vector, by the shared queue, until they hold `budget` rows."""
        margin = self.normal @ unit - self.cut
        queue = [(0.0, t, 0) for t in range(self.trees)]
        out, held = [], 0
        while queue and held < budget:
            crossed, t, node = heapq.heappop(queue)
            while node < self.inner:
                m = margin[t, node]
                near, far = (2 * node + 2, 2 * node + 1) if m > 0 else (2 * node + 1, 2 * node + 2)
                heapq.heappush(queue, (crossed + m * m, t, far))
                node = near
            if n := int(self.sizes[t, node - self.inner]):
                out.append((t, node - self.inner))
                held += n
        return out


def needed(unit: np.ndarray, trees: int, depth: int, k: int, seed: int) -> float:
    """Rows that a search over unit vectors, a forest of their own, must open to find RECALL of the k nearest."""
    forest = Forest(unit, trees, depth, seed)
    leaf = forest.leaves(unit)
    sizes = np.stack([np.bincount(leaf[:, t], minlength=2**depth) for t in range(trees)])
    asked = np.random.default_rng(seed).permutation(len(unit))[:ASKED]
    near = unit[asked] @ unit.T
    near[np.arange(len(asked)), asked] = -2
    best = np.argpartition(-near, min(k, len(unit) - 1) - 1, axis=1)[:, : min(k, len(unit) - 1)]
    found = []
    for i, q in enumerate(asked):
        # What the queue would have crossed on the way to each leaf, level by level, for all leaves at once.
        margin, cost = forest.normal @ unit[q] - forest.cut, np.zeros((trees, 1))
        for level in range(depth):
            m = margin[:, 2**level - 1 : 2 ** (level + 1) - 1]
            cost = np.stack([cost + np.where(m > 0, m * m, 0.0), cost + np.where(m > 0, 0.0, m * m)], axis=2).reshape(trees, -1)
        order = np.argsort(cost, axis=None, kind="stable")
        opened = np.empty(order.size)
        opened[order] = np.cumsum(sizes.reshape(-1)[order])
        found.append(opened.reshape(trees, -1)[np.arange(trees)[None, :], leaf[best[i]]].min(axis=1))
    return float(np.quantile(np.concatenate(found), RECALL))


def budget(unit: np.ndarray, total: int, trees: int, depth: int, k: int, seed: int = 5) -> float:
    """Rows a search opens in a table of `total` classes: those of as many leaves as it takes in the sample."""
    if len(unit) < 4 * LEAF:
        return float(total * trees)
    return MARGIN * needed(unit, trees, depth, k, seed) * total / len(unit)


def _split(keys: np.ndarray, values: np.ndarray):
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, dtype=int)
    return keys[starts], np.split(values, starts[1:]) if len(keys) else []


def usable(v: Column) -> Column:
    """A vector that takes part: not null, no null or non-finite component, not all zero."""
    inf = float("inf")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(inf)))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    """List column as a matrix of doubles; all lists have one length (see nearest)."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _scaled(m: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that squares neither overflow nor vanish; the directions stay exactly."""
    if not m.size:
        return m
    _, power = np.frexp(np.abs(m).max(axis=1))
    return np.ldexp(m, -power[:, None])


def _unit(m: np.ndarray) -> np.ndarray:
    m = _scaled(m)
    return m / np.linalg.norm(m, axis=1, keepdims=True) if m.size else m


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of row a with the rows of b in double precision, each sum in component order's pairwise tree, the same for equal rows."""
    a, b = _scaled(a[None, :])[0], _scaled(b)
    return (b * a).sum(axis=1) / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum(axis=1)))


def classes(vectors: DataFrame, k: int) -> DataFrame:
    """(class, vec, ids): each distinct vector once, with its k + 1 smallest ids; class is the smallest."""
    one = vectors.groupBy("vec").agg(F.min("vec_id").alias("class"))
    # Smallest ids one after another: each step is a map-side combined minimum, so no task holds a class's members.
    ids = F.array("class")
    last, found = one.select(F.col("vec").alias("v0"), F.col("class").alias("last")), one.select("vec", "class", ids.alias("ids"))
    for _ in range(k):
        more = vectors.join(last, vectors.vec == last.v0).where("vec_id > last").groupBy("vec").agg(F.min("vec_id").alias("next"))
        more = written(more, "next-ids")
        if not more.take(1):
            break
        found = found.join(more.withColumnRenamed("vec", "v1"), found.vec == F.col("v1"), "left")
        found = found.select("vec", "class", F.when(F.col("next").isNotNull(), F.concat("ids", F.array("next"))).otherwise(F.col("ids")).alias("ids"))
        last = more.select(F.col("vec").alias("v0"), F.col("next").alias("last"))
    return found


def _route(forest):
    out = arrow_schema("class long, vec array<double>, ids array<long>, tree int, leaf int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = forest.value
        for b in batches:
            leaves = f.leaves(_unit(_matrix(b.column(1))))
            for t in range(f.trees):
                n = b.num_rows
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1).cast(out.field(1).type), b.column(2).cast(out.field(2).type), pa.array(np.full(n, t, np.int32)), pa.array(leaves[:, t])], schema=out)

    return run


def _probes(forest, rows: float):
    out = arrow_schema("query_id long, tree int, leaf int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = forest.value
        for b in batches:
            unit = _unit(_matrix(b.column(1)))
            for i in range(b.num_rows):
                found = f.probe(unit[i], rows)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(np.full(len(found), i))), pa.array([t for t, _ in found], pa.int32()), pa.array([x for _, x in found], pa.int32())], schema=out)

    return run


def _rerank(k: int):
    """Batches sorted by (tree, leaf, slice, block, is row): each group's queries come first, then its rows stream by."""
    out = arrow_schema("query_id long, ids array<long>, score double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, queries, units, best = None, [], None, []

        def results():
            found = [(q, ids, s) for (q, _), top in zip(queries, best) for s, _, ids in top]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], out.field(i).type) for i in range(3)], schema=out)

        for b in batches:
            if not b.num_rows:
                continue
            keys = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(5)], axis=1)
            starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
            for a, z in zip(starts, [*starts[1:], b.num_rows]):
                key, is_row = tuple(keys[a, :4]), keys[a, 4]
                if key != group:
                    yield from results()
                    group, queries, units, best = key, [], None, []
                if not is_row:
                    part = b.slice(a, z - a)
                    m = _matrix(part.column(6))
                    queries += zip(part.column(5).to_pylist(), m)
                    best += [[] for _ in range(len(m))]
                elif queries:
                    units = _unit(np.stack([v for _, v in queries])) if units is None else units
                    step = max(1, CELLS // len(queries))
                    for at in range(a, z, step):
                        _see(b.slice(at, min(step, z - at)), queries, units, best, k)
        yield from results()

    return run


def _see(part: pa.RecordBatch, queries: list, units: np.ndarray, best: list, k: int) -> None:
    """Hold some rows of a leaf against the queries of a block; best keeps (score, class, ids) of each query's k + 1."""
    m = _matrix(part.column(6))
    rough = units @ _unit(m).T
    ids, first = part.column(7), part.column(5).to_numpy(zero_copy_only=False)
    n = min(k + 1, len(m))
    floors = np.partition(rough, -n, axis=1)[:, -n] - 1e-9
    for i, (_, v) in enumerate(queries):
        # Those within rounding of the (k + 1)-th best are scored by the exact measure.
        floor = max(floors[i], best[i][-1][0] - 1e-9) if len(best[i]) > k else floors[i]
        at = np.flatnonzero(rough[i] >= floor)
        if len(at):
            s = cosine(v, m[at])
            best[i] = sorted(best[i] + [(float(x), int(first[j]), ids[int(j)].as_py()) for x, j in zip(s, at)], key=lambda x: (-x[0], x[1]))[: k + 1]


def nearest(vectors: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", trees: int = TREES, sample: int = SAMPLE, seed: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest found for each row where `queries` holds, by cosine, ties to the smaller id.

    Candidates are all rows of the query's vector length but the query's own; if there are fewer than k, all come.
    Vectors that are null, zero or hold null or non-finite components take no part, on either side, nor do rows without
    an id; rows that repeat an id with the same vector count once, and an id with several vectors asks with each: its
    results are the best over them. Each length has a forest of its own. Equal vectors have equal scores; components
    may be as small or large as doubles are.
    """
    rows = vectors.where(F.col(id_col).isNotNull() & usable(F.col(vec_col))).select(F.col(id_col).cast("long").alias("vec_id"), F.transform(F.col(vec_col), lambda x: x.cast("double")).alias("vec"), F.coalesce(queries, F.lit(False)).alias("asks"))
    rows = written(rows, "vectors")
    found = None
    for r in rows.groupBy(F.size("vec").alias("n")).agg(F.max("asks").alias("asks")).orderBy("n").collect():  # lengths are few
        if r["asks"]:
            one = _near(rows.where(F.size("vec") == r["n"]), r["n"], k, trees, sample, seed)
            found = one if found is None else found.unionByName(one)
    if found is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    near = found.groupBy("query_id", "ids").agg(F.max("score").alias("score"))
    each = near.select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
    each = each.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = each.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id", "score"))), 1, k).alias("top"))
    return best.select("query_id", F.posexplode("top").alias("pos", "r")).select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), "r.vec_id", "r.score")


def _near(rows: DataFrame, dim: int, k: int, trees: int, sample: int, seed: int) -> DataFrame:
    """(query_id, ids, score): what a search of the rows (vec_id, vec, asks) of one length opens, the k + 1 best of each leaf."""
    spark = rows.sparkSession
    found = written(classes(rows.select("vec_id", "vec").distinct(), k), "classes")
    total = found.count()
    sample = max(1, min(sample, SAMPLE_BYTES // (8 * dim)))
    taken = found.orderBy(F.xxhash64("class")).limit(sample).select("vec").toArrow()
    unit = _unit(_matrix(taken.column(0).combine_chunks()))
    depth = max(1, min(int(np.log2(max(2, len(unit) / LEAF))), int(np.ceil(np.log2(max(2, total / ROWS))))))
    opened = budget(unit, total, trees, depth, k, seed)
    forest = Forest(unit, trees, depth, seed)
    shared = spark.sparkContext.broadcast(forest)
    index = written(found.select("class", "vec", "ids").mapInArrow(_route(shared), "class long, vec array<double>, ids array<long>, tree int, leaf int"), "index")
    forest.sizes = np.zeros((trees, 2**depth), dtype=np.int64)
    for r in index.groupBy("tree", "leaf").count().collect():  # at most trees * 2^depth rows, as the next one
        forest.sizes[r["tree"], r["leaf"]] = r["count"]
    shared = spark.sparkContext.broadcast(forest)
    asks = rows.where("asks").select(F.col("vec_id").alias("query_id"), "vec").distinct()
    probes = written(asks.mapInArrow(_probes(shared, max(opened, LEAST * trees)), "query_id long, tree int, leaf int").distinct(), "probes")
    leaves = [(r["tree"], r["leaf"], -(-r["count"] // BLOCK), int(-(-forest.sizes[r["tree"], r["leaf"]] // SLICE))) for r in probes.groupBy("tree", "leaf").count().collect()]
    leaves = F.broadcast(spark.createDataFrame(leaves, "tree int, leaf int, blocks int, slices int"))
    ask = asks.join(probes, "query_id").join(leaves, ["tree", "leaf"]).withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    ask = ask.select("tree", "leaf", "slice", F.pmod(F.xxhash64("query_id"), F.col("blocks").cast("long")).cast("int").alias("block"), F.lit(0).alias("is_row"), F.col("query_id").alias("id"), "vec", F.array().cast("array<bigint>").alias("ids"))
    content = index.join(leaves, ["tree", "leaf"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    content = content.select("tree", "leaf", F.pmod(F.xxhash64("class", F.lit(1)), F.col("slices").cast("long")).cast("int").alias("slice"), "block", F.lit(1).alias("is_row"), F.col("class").alias("id"), "vec", "ids")
    group = ["tree", "leaf", "slice", "block"]
    both = ask.unionByName(content).repartition(*group).sortWithinPartitions(*group, "is_row", "id")
    return both.mapInArrow(_rerank(k), "query_id long, ids array<long>, score double")
