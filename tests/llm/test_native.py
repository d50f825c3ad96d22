"""Sharding and mixing: laws, brute force, odd rows."""

import math
import zlib
from collections import Counter, defaultdict

import pytest
from chronokey.llm import mixing, sharding
from chronokey.llm.shared import read
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, source string, size string, u int"


def docs(spark):
    rows = [(i, f"word{i} " * (1 + i % 13), f"s{i % 3}" if i % 11 else None, "clash", i) for i in range(150)]
    rows += [(500 + i, "the same text over and over", "s0", None, None) for i in range(60)]
    rows += [(None, None, "s1", None, None), (None, "no id", None, None, None), (700, "", "s2", None, None), (700, "", "s2", None, None), (701, "long " * 30_000, "s2", None, None), (702, " \t\n", "empty source", None, None)]
    return spark.createDataFrame(rows, DOCS)


def test_shards(spark):
    d = docs(spark)
    rows = sharding.shard(d, shards=7).collect()
    assert len(rows) == d.count()
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
    sizes = [len(by[s]) for s in range(7)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(v) == list(range(len(v))) for v in by.values())
    texts = Counter((r["doc_id"], r["text"]) for r in d.collect())
    want = Counter((i, 8 + len((t or "").encode()), zlib.crc32((t or "").encode())) for (i, t), n in texts.items() for _ in range(n))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    assert {r["law"] for r in rows} == {"rows"} and {r["grown_shard"] for r in rows} == {None}
    # Each shard holds its share of each source, within the rounding of its cuts and one small group.
    total, inside = Counter(r["source"] for r in rows), Counter((r["shard"], r["source"]) for r in rows)
    assert all(abs(inside[s, x] - n / 7) <= 5 for s in range(7) for x, n in total.items())
    again = {(r["doc_id"], r["size"], r["shard"], r["slot"]) for r in sharding.shard(d.repartition(5), shards=7).collect()}
    assert {x for x in again if x[0] not in (None, 700)} == {(r["doc_id"], r["size"], r["shard"], r["slot"]) for r in rows if r["doc_id"] not in (None, 700)}


def test_equal_texts_share_a_shard(spark):
    """Groups that fit are whole, of every size and across sources; what doesn't fit is reported; counts differ by one at most."""
    texts = [f"t{i}" for i in range(700)] + ["pair"] * 2 + ["ten"] * 10 + ["third"] * 33 + [""] * 5 + ["huge"] * 300 + [f"c{i % 60}" for i in range(240)]
    rows = [(None if i % 97 == 0 else i, None if t == "" and i % 2 else t, f"s{i % 5}" if i % 13 else None) for i, t in enumerate(texts)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = sharding.shard(d, shards=24).collect()
    by, sizes = defaultdict(set), Counter(r["shard"] for r in got)
    for r in got:
        by[r["size"], r["text_crc32"]].add(r["shard"])
    assert len(got) == len(rows) and max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == 24
    assert all({r["slot"] for r in got if r["shard"] == s} == set(range(n)) for s, n in sizes.items())
    count = Counter((r["size"], r["text_crc32"]) for r in got)
    assert all((len(by[k]) == 1) == (n <= len(rows) // 24) for k, n in count.items())
    assert all(r["kept"] == (len(by[r["size"], r["text_crc32"]]) == 1) for r in got)


def test_shards_without_singles(spark):
    """Where only groups are left, some must be split: counts come first, and no more groups are split than shards meet."""
    d = spark.createDataFrame([(i, f"g{i // 7}", f"s{i % 3}") for i in range(700)], "doc_id long, text string, source string")
    got = sharding.shard(d, shards=9).collect()
    sizes, by = Counter(r["shard"] for r in got), defaultdict(set)
    for r in got:
        by[r["text_crc32"]].add(r["shard"])
    assert max(sizes.values()) - min(sizes.values()) <= 1 and sum(len(x) > 1 for x in by.values()) <= 9
    tiny = sharding.shard(d.limit(5), shards=9).collect()
    assert len({r["shard"] for r in tiny}) == 5 and {r["slot"] for r in tiny} == {0}


def test_shards_brute_force(spark):
    """Positions of single rows as an order of fractional ranks in one process gives them."""
    import hashlib

    def h(x):
        return int(hashlib.md5(f"11:{x}".encode()).hexdigest()[:12], 16)

    data = [(i, f"t{i}", f"s{i % 5}" if i % 7 else None) for i in range(200)]
    rows = [(i, t, s, h(hashlib.md5(t.encode()).hexdigest()), h(i)) for i, t, s in data]
    place = {}
    for s in {r[2] for r in rows}:
        own = sorted((r for r in rows if r[2] == s), key=lambda r: (r[3] % 16 * 16 + r[4] % 16, r[3], r[4], r[0]))
        place |= {r[0]: ((k + 0.5) / len(own), r[4], r[2] is None, r[2] or "") for k, r in enumerate(own)}
    order = sorted(place, key=lambda i: place[i])
    want = {i: math.floor(k * 24 / 200) for k, i in enumerate(order)}
    d = spark.createDataFrame(data, "doc_id long, text string, source string")
    assert {r["doc_id"]: r["shard"] for r in sharding.shard(d).collect()} == want


def test_empty(spark):
    d = docs(spark).limit(0)
    assert sharding.shard(d).count() == 0 and mixing.mix(d).count() == 0 and mixing.mixture(d).columns == d.columns


def levels(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Targets by raising the level until all is spent."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    open_, target, left = set(names), dict.fromkeys(names, 0.0), share * sum(sizes.values())
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if level * w[s] > most * sizes[s]}
        if not full:
            return target | {s: level * w[s] for s in open_}
        for s in full:
            target[s] = float(most * sizes[s])
            left -= target[s]
        open_ -= full
    return target


def held(rows):
    """The contract on collected rows of mix(); targets by `levels`."""
    sizes = Counter()
    for r in rows:
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2
        sizes[r["source"]] += r["size"]
    want = levels(dict(sizes))
    for s in sizes:
        own = [r for r in rows if r["source"] == s]
        assert {r["source_size"] for r in own} == {sizes[s]} and own[0]["target"] == pytest.approx(want[s])
        left_out = [r["size"] for r in own if r["size"] and r["copies"] < 2 and r["copies"] == min(x["copies"] for x in own if x["size"])]
        short = want[s] - sum(r["taken"] for r in own)
        assert -0.5 <= short < min(left_out, default=1) + 0.5


def test_mix(spark):
    d = docs(spark)
    rows = mixing.mix(d).collect()
    assert mixing.mix(d).columns == ["doc_id", "source", "size", "source_size", "target", "copies", "taken"]
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in rows) == Counter((r["doc_id"], r["source"], len((r["text"] or "").split())) for r in d.collect())
    held(rows)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(d.repartition(7)).collect()))
    mixed = mixing.mixture(d)
    assert mixed.columns == d.columns and mixed.count() == sum(r["copies"] for r in rows)
    assert Counter(r["doc_id"] for r in mixed.collect()) == sum((Counter({r["doc_id"]: r["copies"]}) for r in rows), Counter())


@pytest.mark.parametrize("ident", [1, 2, 3])
def test_mix_repeated_rows(spark, ident):
    """A row that makes up most of its source is taken in part; the target is met all the same."""
    rows = [(ident, "ten words " * 5, "a")] * 700 + [(10 + i, "w " * (5 + i % 23), "a") for i in range(300)] + [(1000 + i, "w " * 40, f"b{i % 2}") for i in range(500)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    got = mixing.mix(d).collect()
    held(got)
    mixed = mixing.mixture(d).collect()
    assert Counter(r["doc_id"] for r in mixed) == sum((Counter({r["doc_id"]: r["copies"]}) for r in got), Counter())
    parts = {r["copies"] for r in got if r["doc_id"] == ident}
    assert len(parts) <= 2


def by_hand(rows, seed=7, tilt=mixing.TILT):
    """copies by (doc_id) in one process: odds, order and filling as the docstring says."""
    import hashlib

    def u(i, t):
        return (int(hashlib.md5(f"{seed}:{'' if i is None else i}:{hashlib.md5((t or '').encode()).hexdigest()}".encode()).hexdigest()[:12], 16) + 0.5) / 2**48

    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want, out = levels(dict(sizes)), Counter()
    for s, total in sizes.items():
        own = [(i, len((t or "").split()), u(i, t)) for i, t, x in rows if x == s]
        goal = min(math.floor(want[s] + 0.5), 2 * total)
        whole, left = divmod(goal, total) if total else (0, 0)
        for i, _, _ in own:
            out[s, i] += whole
        if not left:
            continue
        mean = max(1, total // sum(z > 0 for _, z, _ in own))
        f = {z: z * 1000 // (z + mean) for _, z, _ in own}
        mu, p = sum(z * f[z] for _, z, _ in own) / total, left / total
        odds = {z: p + tilt * min(p, 1 - p) * (f[z] - mu) / 1000 for z in f}
        assert sum(z * odds[z] for _, z, _ in own) == pytest.approx(left)
        rest = sorted((v / (1 - v) / (odds[z] / (1 - odds[z])), v, z, i) for i, z, v in own if z)
        while rest and rest[0][2] <= left:
            left -= rest[0][2]
            out[s, rest.pop(0)[3]] += 1
        for _, v, z, i in sorted(rest, key=lambda r: (-r[2], r[1])):
            if z <= left:
                left -= z
                out[s, i] += 1
    return out


def test_mix_brute_force(spark):
    rows = [(i, "w " * (1 + i * 7919 % 61), f"s{i % 4}") for i in range(600)] + [(900 + i % 5, "x " * 17, "s1") for i in range(40)] + [(None, None, "s1")]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    seen = Counter()
    for r in got:
        seen[r["source"], r["doc_id"]] += r["copies"]
    want = by_hand(rows)
    assert +seen == +want


def test_odds_decide(spark):
    """Inclusion odds differ inside a source: the order of ranks isn't that of the draws, and longer documents come more often."""
    d = spark.createDataFrame([(i, "w " * (5 if i % 2 else 50), f"s{i % 3}") for i in range(3000)], "doc_id long, text string, source string")
    rows = mixing.mix(d).withColumn("u", mixing.draw(7, F.col("doc_id"), F.repeat(F.lit("w "), F.col("size").cast("int")))).collect()
    for s in ("s0", "s1", "s2"):
        own = sorted((r for r in rows if r["source"] == s), key=lambda r: r["u"])
        copies = [r["copies"] for r in own]
        if len(set(copies)) > 1:
            assert copies != sorted(copies, reverse=True)
            for z in (5, 50):  # among equal sizes the smaller draw comes first
                same = [r["copies"] for r in own if r["size"] == z]
                assert same == sorted(same, reverse=True)
            mean = {z: sum(r["copies"] for r in own if r["size"] == z) / sum(r["size"] == z for r in own) for z in (5, 50)}
            assert mean[50] > mean[5]


def test_sql(spark, tmp_path):
    import duckdb

    d = docs(spark).drop("u", "size")
    d.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(mixing.mix_sql()).fetchall()
    got = mixing.mix(read(spark, str(tmp_path), "documents")).select("doc_id", "size", "source_size", "target", "taken").collect()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got)


def test_shard_sql(spark, tmp_path):
    import duckdb

    d = docs(spark).drop("u", "size").where("doc_id IS NULL OR doc_id <> 701")
    d.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(sharding.shard_sql()).fetchall()
    got = sharding.shard(read(spark, str(tmp_path), "documents")).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "source").collect()
    names = [x[0] for x in con.description]
    want = [tuple(r[names.index(c)] for c in ("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "source")) for r in want]
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got)
