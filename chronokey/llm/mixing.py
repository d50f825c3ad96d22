"""Mixing sources to target weights by Pareto order sampling. DataFrame functions only.

Every document of a source is to be taken rate = target / source_size times, at most twice. The whole part of the rate
is certain: that many copies of each document. The fractional part p is an inclusion probability, tilted by length
inside the source: with f = size / (size + mean size) and mu the mean of f over the source's words, document i has

    p_i = p + tilt * min(p, 1 - p) * (f_i - mu)        (0 < p_i < 1, and the sum of p_i * size_i stays p * source_size)

so longer documents are likelier. Pareto order sampling decides: with a uniform draw u fixed by seed, id and text,
documents rank by their random odds over their inclusion odds,

    (u / (1 - u)) / (p_i / (1 - p_i))

and the smallest ranks are taken until the source's remaining words are used up; that is the sample of fixed size. Of
rows that share a rank (rows repeated in id and text) as many are taken as fit. What is then left is less than the one
document that didn't fit; it goes to the longest documents that fit in it, again by rank, until none fits.

Scale: the texts are read once for (id, source, size, u); from then on only that slim table moves. Running sums never
sort a source in one task: a histogram by rank and source (map-side combined) finds the bucket in which the budget ends
and only that bucket is sorted; there are about as many buckets as rows in one, the square root of the table. The
outcome is a small row for each source, so texts are never shuffled to apply it. Only repeated rows of which some are
taken and some not are numbered, by scan partition, so that a much repeated row is no hot key.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import WORD, word_count, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
TILT = 0.5
#: Steps of f.
STEPS = 1000


def draw(seed: int, id_col: Column, text: Column) -> Column:
    """Uniform in (0, 1), fixed by seed, id and text; 48 bits of MD5, which SQL engines share."""
    said = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit(""))))
    return (F.conv(F.substring(F.md5(said), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size) -> + weight, target: least(most * source_size, level * weight), the level such that targets add up to share * all sizes.

    Sources by code point, null last, get the weights in turn. The level comes in closed form from sums over sources
    in order of the level at which each is full; if all are full, the targets stay at most * source_size.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = F.array([F.lit(float(w)) for w in weights])
    s = sizes.withColumn("weight", F.element_at(turn, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    s = s.withColumn("cap", F.col("source_size") * float(most)).withColumn("full_at", F.col("cap") / F.col("weight"))
    whole = Window.partitionBy()
    filling = Window.orderBy("full_at", F.col("source").isNull(), "source")
    order = filling.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("level", (F.sum("source_size").over(whole) * share - F.coalesce(F.sum("cap").over(order), F.lit(0.0))) / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(order), F.lit(0.0))))
    # The level holds from the first source on that it doesn't fill.
    s = s.withColumn("turn", F.row_number().over(filling))
    s = s.withColumn("level", F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("turn", "level"))).over(whole)["level"])
    return s.select("source", "source_size", "weight", F.coalesce(F.least("cap", F.col("level") * F.col("weight")), F.col("cap")).alias("target"))


def _same(a: DataFrame, b: DataFrame, by: list[str]) -> Column:
    """Equality of the columns `by` of a with those of b, there named with a leading g_; null equals null."""
    found = F.lit(True)
    for c in by:
        found = found & a[c].eqNullSafe(b[f"g_{c}"])
    return found


def _renamed(df: DataFrame, by: list[str]) -> DataFrame:
    return df.withColumnsRenamed({c: f"g_{c}" for c in by})


def _stop(rows: DataFrame, by: list[str], order: list[str], buckets: int) -> DataFrame:
    """(by..., stop): of rows (by, order, at, each, room), in order within by, the first class of which not all fit.

    at rises with the order from 0 to 1, each is what a row uses up of room, and a class is the rows equal in order.
    stop has the order's values, part (how many of the class fit) and used (by all that fit).
    """
    rows = rows.withColumn("bucket", F.least(F.floor(F.col("at") * buckets), F.lit(buckets - 1)))
    hist = rows.groupBy(*by, "bucket").agg(F.sum("each").alias("words"), F.first("room").alias("room"))
    hist = hist.withColumn("end", F.sum("words").over(Window.partitionBy(*by).orderBy("bucket")))
    ends = hist.groupBy(*by).agg(F.min(F.when(F.col("end") > F.col("room"), F.col("bucket"))).alias("last"), F.coalesce(F.max(F.when(F.col("end") <= F.col("room"), F.col("end"))), F.lit(0)).alias("before"))
    ends = _renamed(ends.where("last IS NOT NULL"), by)
    inside = rows.join(ends, _same(rows, ends, by) & (F.col("bucket") == F.col("last")))
    inside = inside.groupBy(*by, *order, "each", "room", "before").agg(F.count("*").alias("n"))
    run = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = inside.withColumn("used", F.col("before") + F.coalesce(F.sum(F.col("n") * F.col("each")).over(run), F.lit(0)))
    inside = inside.withColumn("part", F.least("n", F.greatest(F.lit(0), F.expr("(room - used) div each"))))
    inside = inside.withColumn("used", (F.col("used") + F.col("part") * F.col("each")).cast("long"))
    return inside.where("part < n").groupBy(*by).agg(F.min(F.struct(*order, "part", "used")).alias("stop"))


def odds(p: Column) -> Column:
    return p / (1 - p)


def inclusion(size: Column, tilt: float = TILT) -> Column:
    """p_i of a row of (size) joined with its source's row of plan()."""
    f = F.floor(size * STEPS / (size + F.col("mean")))
    return F.col("p") + tilt * F.least(F.col("p"), 1 - F.col("p")) * ((f - F.col("mu")) / float(STEPS))


def _ranked(rows: DataFrame, per: DataFrame, tilt: float) -> DataFrame:
    """rows (source, size, u, ...) with the columns of per, their source's row, and rank; null where there is nothing to draw."""
    per = _renamed(per, ["source"])
    rows = rows.join(per, _same(rows, per, ["source"])).drop("g_source")
    drawn = (F.col("size") > 0) & (F.col("left") > 0)
    return rows.withColumn("rank", F.when(drawn, odds(F.col("u")) / odds(inclusion(F.col("size"), tilt))))


def plan(slim: DataFrame, share: float = SHARE, weights: tuple = WEIGHTS, most: float = MOST, tilt: float = TILT) -> DataFrame:
    """slim (source, size, u) -> one row for each source.

    source, source_size, target, whole (copies of each document), left (words to draw), mean, p, mu; stop struct<rank, u,
    size, part, used>: the class at which the draw ends; fills array<struct<size, u, part>>: what the rest is filled
    with. Both are null where nothing is drawn or filled.
    """
    words = F.floor(F.col("size") * STEPS / (F.col("size") + F.col("mean"))) * F.col("size")
    per = slim.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"), F.count(F.when(F.col("size") > 0, 1)).alias("n"))
    rows = per.agg(F.sum("n")).first()[0] or 0  # one number
    buckets = 1 << max(6, math.ceil(math.log2(max(1, rows)) / 2))
    goal = targets(per.select("source", "source_size"), weights, share, most)
    goal = _renamed(goal, ["source", "source_size"])
    goal = per.join(goal, _same(per, goal, ["source"])).drop("g_source", "g_source_size")
    goal = goal.withColumn("total", F.least(F.round("target").cast("long"), F.floor(F.col("source_size") * float(most)).cast("long")))
    some = F.col("source_size") > 0
    goal = goal.withColumn("whole", F.when(some, F.expr("total div source_size")).otherwise(F.lit(0)).cast("long"))
    goal = goal.withColumn("left", (F.col("total") - F.col("whole") * F.col("source_size")).cast("long"))
    goal = goal.withColumn("mean", F.when(some, F.expr("greatest(1, source_size div n)")).otherwise(F.lit(1)).cast("long"))
    goal = goal.withColumn("p", F.when(some, F.col("left") / F.col("source_size")).otherwise(F.lit(0.0)))
    goal = written(goal.select("source", "source_size", "target", "whole", "left", "mean", "p"), "targets")
    means = _renamed(goal, ["source"])
    means = slim.where("size > 0").join(means, _same(slim, means, ["source"])).groupBy("source").agg((F.sum(words).cast("long") / F.first("source_size")).alias("mu"))
    means = _renamed(means, ["source"])
    goal = written(goal.join(means, _same(goal, means, ["source"]), "left").drop("g_source").withColumn("mu", F.coalesce("mu", F.lit(0.0))), "odds")

    drawn = _ranked(slim, goal, tilt).where("rank IS NOT NULL")
    order = ["rank", "u", "size"]
    stop = _stop(drawn.select("source", *order, (F.col("rank") / (1 + F.col("rank"))).alias("at"), F.col("size").alias("each"), F.col("left").alias("room")), ["source"], order, buckets)
    stop = _renamed(stop, ["source"])
    goal = written(goal.join(stop, _same(goal, stop, ["source"]), "left").drop("g_source"), "stops")

    room = F.col("left") - F.col("stop.used")
    rest = _ranked(slim, goal.where("left > stop.used"), tilt).withColumn("room", room).where(~_before() & (F.col("size") <= F.col("room")))
    rest = rest.select("source", "size", "u", "room")
    # Sizes that fit are whole numbers up to the words left, which are fewer than those of one document: a short list.
    sizes = rest.groupBy("source", "size").agg(F.count("*").alias("cnt"), F.first("room").alias("room"))
    lists = sizes.groupBy("source").agg(F.sort_array(F.collect_list(F.struct("size", "cnt")), asc=False).alias("sizes"), F.first("room").alias("room"))
    picks = lists.select("source", F.explode(F.expr("""aggregate(sizes, named_struct('room', room, 'picks', cast(array() AS array<struct<size:bigint,k:bigint,cnt:bigint>>)),
      (a, x) -> if(x.size <= a.room, named_struct('room', a.room - least(x.cnt, a.room div x.size) * x.size,
        'picks', concat(a.picks, array(named_struct('size', x.size, 'k', least(x.cnt, a.room div x.size), 'cnt', x.cnt)))), a), a -> a.picks)""")).alias("pick"))
    picks = written(picks.select("source", "pick.*"), "picks")
    some = _renamed(picks.where("k < cnt"), ["source", "size"])
    inside = rest.drop("room").join(some, _same(rest, some, ["source", "size"])).select("source", "size", "u", F.col("u").alias("at"), F.lit(1).cast("long").alias("each"), F.col("k").alias("room"))
    ends = _renamed(_stop(inside, ["source", "size"], ["u"], buckets), ["source", "size"])
    picks = picks.join(ends, _same(picks, ends, ["source", "size"]), "left")
    # All of a size: no draw reaches 2.
    fills = picks.groupBy("source").agg(F.collect_list(F.struct("size", F.coalesce("stop.u", F.lit(2.0)).alias("u"), F.coalesce("stop.part", F.lit(0)).cast("long").alias("part"))).alias("fills"))
    fills = _renamed(fills, ["source"])
    return written(goal.join(fills, _same(goal, fills, ["source"]), "left").drop("g_source"), "plan")


def _before() -> Column:
    """Whether a row's rank comes before its source's stop."""
    return F.struct("rank", "u", "size") < F.struct(F.col("stop.rank").alias("rank"), F.col("stop.u").alias("u"), F.col("stop.size").alias("size"))


def _quota() -> Column:
    """Of a row's class: -1: all are drawn; 0: none; else how many."""
    at = (F.col("rank") == F.col("stop.rank")) & (F.col("u") == F.col("stop.u")) & (F.col("size") == F.col("stop.size"))
    fill = F.expr("get(filter(fills, x -> x.size = size), 0)")
    fills = F.when(fill.isNull() | (F.col("u") > fill["u"]), 0).when(F.col("u") < fill["u"], -1).otherwise(fill["part"])
    return F.when(F.col("rank").isNull(), 0).when(F.col("stop").isNull() | _before(), -1).when(at, F.col("stop.part")).otherwise(fills).cast("long")


def _decided(rows: DataFrame, per: DataFrame, tilt: float) -> DataFrame:
    """rows (source, size, u, ...) with source_size, target and copies. Rows of one class are interchangeable."""
    own = [F.col(c) for c in rows.columns]
    out = _ranked(rows, per, tilt).withColumn("quota", _quota())
    said = [*own, "source_size", "target"]
    plain = out.where("quota <= 0").select(*said, (F.col("whole") - F.col("quota")).cast("long").alias("copies"))
    if not per.where("stop.part > 0 OR exists(fills, x -> x.part > 0)").take(1):
        return plain
    # Numbers within each class: first those of the cells (scan partitions) before, then the row's in its cell.
    by = ["source", "u", "size", "cell"]
    many = written(out.where("quota > 0").select(*said, "whole", "quota", F.spark_partition_id().alias("cell")), "repeated")
    cells = many.groupBy(*by).agg(F.count("*").alias("n"))
    upto = Window.partitionBy("source", "u", "size").orderBy("cell")
    cells = _renamed(cells.withColumn("first", F.sum("n").over(upto) - F.col("n")).drop("n"), by)
    many = many.withColumn("k", F.row_number().over(Window.partitionBy(*by).orderBy(F.lit(0))))
    many = many.join(cells, _same(many, cells, by))
    extra = F.when(F.col("first") + F.col("k") <= F.col("quota"), 1).otherwise(0)
    return plain.unionByName(many.select(*said, (F.col("whole") + extra).cast("long").alias("copies")))


def _drawn(docs: DataFrame, seed: int, id_col: str, text_col: str, source_col: str) -> tuple[Column, Column, Column]:
    """source, size and u of a row of docs, whose columns are named by place."""
    at = {c: F.col(f"c{docs.columns.index(c)}") for c in (id_col, text_col, source_col)}
    return at[source_col].alias("source"), word_count(at[text_col]).alias("size"), draw(seed, at[id_col], at[text_col]).alias("u")


def mix(docs: DataFrame, seed: int = 7, share: float = SHARE, weights: tuple = WEIGHTS, most: float = MOST, tilt: float = TILT, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row for each row of docs: its id, its source, size, source_size, target, copies (0 to `most`), taken = copies * size.

    A null or wordless text has size 0 and is taken as often as its source is for certain. A null source is a source
    like any other, the last. Rows repeated in id and text share their draw and are interchangeable. A source's taken
    words miss its target by less than the smallest document that could be taken once more; a source without words has the target 0.
    Other columns of docs play no part, whatever their names. An empty table gives no rows. Reruns agree.
    """
    plain = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))
    slim = written(plain.select(F.col(f"c{docs.columns.index(id_col)}").alias("id"), *_drawn(docs, seed, id_col, text_col, source_col)), "sizes")
    rows = _decided(slim, plan(slim, share, weights, most, tilt), tilt)
    return rows.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def mixture(docs: DataFrame, seed: int = 7, share: float = SHARE, weights: tuple = WEIGHTS, most: float = MOST, tilt: float = TILT, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: rows of docs, all its columns, each as often as taken."""
    plain = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))
    drawn = _drawn(docs, seed, id_col, text_col, source_col)
    slim = written(plain.select(*drawn), "sizes")
    rows = _decided(plain.select(*plain.columns, *drawn), plan(slim, share, weights, most, tilt), tilt).where("copies > 0")
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return rows.select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(docs.columns)))


def mix_sql(seed: int = 7, share: float = SHARE, weights: tuple = WEIGHTS, most: float = MOST, tilt: float = TILT) -> str:
    """mix() over the table documents as DuckDB SQL: doc_id, size, source_size, target, taken."""
    turn = "[" + ", ".join(f"{float(w)!r}" for w in weights) + "]"
    return f"""WITH RECURSIVE d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
  ((('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 12))::BIGINT)::DOUBLE + 0.5) / {float(1 << 48)!r} AS u
  FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size, count(CASE WHEN size > 0 THEN 1 END) AS n FROM d GROUP BY source),
s1 AS (SELECT *, source_size * {float(most)!r}::DOUBLE AS cap, ({turn})[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} + 1)::INT]::DOUBLE AS weight FROM s0),
s2 AS (SELECT *, cap / weight AS full_at, row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS turn FROM s1),
s3 AS (SELECT *, (sum(source_size) OVER () * {float(share)!r}::DOUBLE - coalesce(sum(cap) OVER (ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lv FROM s2),
s4 AS (SELECT *, coalesce(least(cap, (SELECT arg_min(lv, turn) FROM s3 WHERE lv <= full_at) * weight), cap) AS target FROM s3),
g0 AS (SELECT source, source_size, target, least(round(target)::BIGINT, floor(source_size * {float(most)!r}::DOUBLE)::BIGINT) AS total, CASE WHEN source_size > 0 THEN greatest(1, source_size // n) ELSE 1 END AS mean FROM s4),
g1 AS (SELECT *, CASE WHEN source_size > 0 THEN total // source_size ELSE 0 END AS whole, CASE WHEN source_size > 0 THEN total % source_size ELSE 0 END AS budget,
  CASE WHEN source_size > 0 THEN (total % source_size)::DOUBLE / source_size::DOUBLE ELSE 0 END AS p FROM g0),
g2 AS (SELECT d.source, sum(size * {STEPS} // (size + mean) * size)::DOUBLE / max(source_size)::DOUBLE AS mu FROM d JOIN g1 ON d.source IS NOT DISTINCT FROM g1.source WHERE size > 0 GROUP BY d.source),
r0 AS (SELECT d.*, source_size, target, whole, budget, size > 0 AND budget > 0 AS drawn,
  p + {tilt!r}::DOUBLE * least(p, 1 - p) * (((size * {STEPS} // (size + mean))::DOUBLE - mu) / {float(STEPS)!r}::DOUBLE) AS pi
  FROM d JOIN g1 ON d.source IS NOT DISTINCT FROM g1.source LEFT JOIN g2 ON d.source IS NOT DISTINCT FROM g2.source),
r1 AS (SELECT *, CASE WHEN drawn THEN (u / (1 - u)) / (pi / (1 - pi)) END AS rank FROM r0),
r2 AS (SELECT *, drawn AND sum(CASE WHEN drawn THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY rank NULLS LAST, u, size ROWS UNBOUNDED PRECEDING) <= budget AS took FROM r1),
r3 AS (SELECT *, budget - sum(CASE WHEN took THEN size ELSE 0 END) OVER (PARTITION BY source) AS room,
  row_number() OVER (PARTITION BY source, size, took ORDER BY u) AS nth FROM r2),
h AS (SELECT source, size, count(*) AS cnt, max(room)::BIGINT AS room FROM r3 WHERE drawn AND NOT took AND size <= room GROUP BY source, size),
fill(source, room, size, k) AS (
  SELECT source, max(room), NULL::BIGINT, 0::BIGINT FROM h GROUP BY source
  UNION ALL
  SELECT source, room - least(cnt, room // z) * z, z, least(cnt, room // z) FROM (
    SELECT fill.source, fill.room, max(h.size) AS z, arg_max(h.cnt, h.size) AS cnt FROM fill JOIN h ON fill.source IS NOT DISTINCT FROM h.source
    WHERE h.size <= fill.room AND (fill.size IS NULL OR h.size < fill.size) GROUP BY fill.source, fill.room))
SELECT doc_id, r3.size, source_size, target, (r3.size * (whole + CASE WHEN took OR (drawn AND nth <= coalesce(k, 0)) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r3 LEFT JOIN (SELECT * FROM fill WHERE size IS NOT NULL) f ON r3.source IS NOT DISTINCT FROM f.source AND r3.size = f.size"""
