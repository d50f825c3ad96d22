"""Sharding by proportional stratified interleaving. DataFrame functions only.

Rows of each source are ranked in a seeded shuffle; a row's fractional rank is (rank + 1/2) / rows of its source. All
rows in order of fractional rank interleave the sources in proportion, so any run of that order matches the mixture;
the order is cut into shards whose row counts differ by one at most (law "rows").

Equal texts stay together where the law permits. A text that several rows hold is a unit. Units of more than 1/64 of a
shard are dealt first, the largest first, each to the emptiest shard; the other units are interleaved by the fractional
rank of their rows and cut by the room that is left; single rows fill each shard up to its exact count. A text with more
rows than a shard has, and a unit for which no room is left, is loose: its rows are dealt as single rows are, lying close
together in the order. kept says of each row whether its text is whole in its shard.

Scale: nothing ranks a source, a shard or a text in one task. Rows fall into cells by hash; cell sums are map-side
combined, their running sums give each cell its first rank, and windows run inside a cell. There are about as many cells
as rows in one, the square root of the table. The units dealt one by one are fewer than 64 for each shard, by their size.
Texts are read once and never shuffled.
"""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

LAW = "rows"
#: A unit of more than 1 / SMALL of a shard is dealt on its own.
SMALL = 64
#: Cells by text; by id there are as many as the square root of the table asks for.
TEXT_CELLS = 16
TEXT = ["ht", "text_crc32", "size"]


def _hash(seed: int, *parts: Column) -> Column:
    """48 bits of an MD5 as a long."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), *parts)), 1, 12), 16, 10).cast("long")


def _joined(rows: DataFrame, other: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """Join by columns, null to null; other's are dropped."""
    other = other.withColumnsRenamed({c: f"g_{c}" for c in by})
    on = F.lit(True)
    for c in by:
        on = on & rows[c].eqNullSafe(other[f"g_{c}"])
    return rows.join(other, on, how).drop(*(f"g_{c}" for c in by))


def _numbered(rows: DataFrame, by: list[str], cell: Column, order: list, name: str, weight: str | None = None, whole: str | None = None) -> DataFrame:
    """rows with the sum of weight (or number) of the rows before, within by and in the order of cell, then of order; whole: that of all rows."""
    one = F.lit(1).cast("long") if weight is None else F.col(weight)
    rows = rows.withColumn("cell", cell)
    cells = rows.groupBy(*by, "cell").agg(F.sum(one).alias("n_"))
    group = Window.partitionBy(*by)
    cells = cells.select(*by, "cell", (F.sum("n_").over(group.orderBy("cell")) - F.col("n_")).alias("first_"), F.sum("n_").over(group).alias("of_"))
    inside = F.sum(one).over(Window.partitionBy(*by, "cell").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) - one
    out = _joined(rows.withColumn(name, inside), cells, [*by, "cell"])
    out = out.withColumn(name, F.col(name) + F.col("first_"))
    return (out if whole is None else out.withColumn(whole, F.col("of_"))).drop("cell", "first_", "of_")


def _ids(cells: int) -> int:
    return max(16, cells // 4)


def _lined_up(rows: DataFrame, weight: str | None, order: list, cells: int) -> DataFrame:
    """rows (source, ht, hi, ...) in order of the fractional rank of their middle within their source: + start, the place on the line."""
    mine = F.lit(1) if weight is None else F.col(weight)
    cell = F.pmod("ht", F.lit(TEXT_CELLS)) * _ids(cells) + F.pmod("hi", F.lit(_ids(cells)))
    rows = _numbered(rows, ["source"], cell, ["ht", "hi", *order], "rank", weight, "of")
    rows = rows.withColumn("place", (F.col("rank") + mine / 2.0) / F.col("of")).drop("rank", "of")
    rows = written(rows, "places")
    # Equal places of several sources: by hash first, so that no source always leads.
    return _numbered(rows, [], F.floor(F.col("place") * cells), ["place", "hi", F.col("source").isNull(), "source", *order], "start", weight)


def _part(at: str, bounds: list[int]) -> Column:
    """The last of the bounds (the first is 0) at or below a column, as its number."""
    return F.expr(f"size(filter(array({', '.join(f'{b}L' for b in bounds)}), b -> b <= {at})) - 1")


def _at(values: list[int], k: str) -> Column:
    return F.expr(f"element_at(array({', '.join(f'{v}L' for v in values)}), {k} + 1)")


def shard(docs: DataFrame, shards: int = 24, seed: int = 11, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row for each row of docs: doc_id, source, size, text_crc32, law, shard, slot, grown_shard (null: the law isn't "key"), kept.

    size is the text's UTF-8 bytes plus 8; a null text counts none, has the CRC of an empty one and is equal to it.
    A null source is a source like any other. Ties in hash, id and text (repeated rows) are interchangeable: they get
    different places. An empty table gives no rows. Other columns of docs play no part. Reruns agree.
    """
    text, ident = F.coalesce(F.col(text_col), F.lit("")), F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    slim = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"), (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), _hash(seed, F.md5(text)).alias("ht"), _hash(seed, ident).alias("hi"),
    )
    slim = written(slim, "slim")
    total = slim.count()
    quota, cells = total // shards, 1 << max(4, math.ceil(math.log2(max(1, total)) / 2))

    first = F.min(F.struct("hi", F.col("source").isNull().alias("none"), "source")).alias("r")
    groups = slim.groupBy(*TEXT).agg(F.count("*").alias("n"), first).where("n > 1").select(*TEXT, "n", "r.hi", "r.source")
    groups = written(groups, "texts")
    big, loads = _dealt(groups.where((F.col("n") <= quota) & (F.col("n") * SMALL > quota)), quota, shards)
    room = [quota - x for x in loads]
    few = groups.where(F.col("n") * SMALL <= quota)
    small = few.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    cuts = [small * x // max(1, sum(room)) for x in accumulate(room[:-1], initial=0)]
    few = _lined_up(few, "n", TEXT, cells).withColumn("shard", _part("start", cuts))
    few = few.where(F.col("start") + F.col("n") - _at(cuts, "shard") <= _at(room, "shard"))
    few = _numbered(few.select(*TEXT, "n", "shard"), ["shard"], F.pmod("ht", F.lit(cells)), TEXT, "slot", "n")
    few = few.select(*TEXT, "shard", (F.col("slot") + _at(loads, "shard")).alias("offset"), "n")
    units = written(big.unionByName(few), "units")

    used = [0] * shards
    for r in units.groupBy("shard").agg(F.sum("n").alias("n")).collect():  # one row for each shard
        used[r["shard"]] = r["n"]
    # Shard s holds rows ceil(s * total / shards) up to ceil((s + 1) * total / shards) of the line.
    free = [-(-(s + 1) * total // shards) + (-s * total // shards) - used[s] for s in range(shards)]
    bounds = list(accumulate(free[:-1], initial=0))
    # Texts with more rows than a shard are fewer than the shards; without them no text is hot.
    hot = F.broadcast(groups.where(F.col("n") > quota).select(*TEXT, F.lit(True).alias("hot"))) if quota else groups.where("false").select(*TEXT, F.lit(True).alias("hot"))
    rows = _joined(slim, hot, TEXT, "left")
    kept = _joined(rows.where("hot IS NULL").drop("hot"), units.select(*TEXT, "shard", "offset"), TEXT, "left")
    kept = written(kept, "assigned")
    whole = _numbered(kept.where("shard IS NOT NULL"), TEXT, F.pmod("hi", F.lit(_ids(cells))), ["hi", F.col("source").isNull(), "source", "doc_id"], "slot")
    whole = whole.withColumn("slot", F.col("slot") + F.col("offset"))
    many = groups.select(*TEXT, F.lit(True).alias("many"))
    single = kept.where("shard IS NULL").drop("shard", "offset").withColumn("hot", F.lit(False)).unionByName(rows.where("hot"))
    single = _lined_up(single, None, ["doc_id", "text_crc32", "size"], cells)
    single = single.withColumn("shard", _part("start", bounds)).withColumn("slot", F.col("start") - _at(bounds, "shard") + _at(used, "shard"))
    lone = _joined(single.where("NOT hot"), many, TEXT, "left").withColumn("kept", F.col("many").isNull())
    out = ["doc_id", "source", "size", "text_crc32", "shard", "slot", "kept"]
    found = whole.withColumn("kept", F.lit(True)).select(out).unionByName(lone.select(out)).unionByName(single.where("hot").withColumn("kept", F.lit(False)).select(out))
    return found.select("doc_id", "source", "size", "text_crc32", F.lit(LAW).alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "kept")


def _dealt(units: DataFrame, quota: int, shards: int) -> tuple[DataFrame, list[int]]:
    """(TEXT, shard, offset, n) of the large units that found room, and the rows each shard got: the largest first, each to the emptiest shard.

    Fewer than SMALL + 1 units for each shard can be large, so they fit in one row.
    """
    kind = "ht:bigint,text_crc32:bigint,size:bigint,shard:int,offset:bigint,n:bigint"
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("less"), *TEXT))).alias("u")
    step = """(a, u) -> if(array_min(a.loads) - u.less <= {quota}, named_struct(
      'loads', transform(a.loads, (x, i) -> if(i + 1 = array_position(a.loads, array_min(a.loads)), x - u.less, x)),
      'dealt', concat(a.dealt, array(named_struct('ht', u.ht, 'text_crc32', u.text_crc32, 'size', u.size,
        'shard', cast(array_position(a.loads, array_min(a.loads)) - 1 AS int), 'offset', array_min(a.loads), 'n', -u.less)))), a)"""
    start = f"named_struct('loads', array_repeat(0L, {shards}), 'dealt', cast(array() AS array<struct<{kind}>>))"
    one = written(units.agg(ordered).select(F.expr(f"aggregate(u, {start}, {step.format(quota=quota)})").alias("a")), "dealt")
    loads = one.select("a.loads").first()["loads"]
    return one.select(F.explode("a.dealt").alias("d")).select("d.*"), list(loads)


def crc32_sql(hex_text: str) -> str:
    """CRC-32 of the bytes that an SQL expression gives in hex, in DuckDB, with a table made by the rule of the code."""
    table = []
    for b in range(256):
        for _ in range(8):
            b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
        table.append(b)
    octets = f"list_transform(regexp_extract_all({hex_text}, '..'), lambda p: ('0x' || p)::BIGINT)"
    step = f"xor(c >> 8, ({table}::BIGINT[])[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce({octets}, lambda c, b: {step}, 4294967295::BIGINT), 4294967295)"


def shard_sql(shards: int = 24, seed: int = 11) -> str:
    """shard() over the table documents as DuckDB SQL, with the source."""
    h = f"('0x' || substr(md5('{seed}:' || {{}}), 1, 12))::BIGINT"
    text, unit = "ht, text_crc32, size", "u.ht = {0}.ht AND u.text_crc32 = {0}.text_crc32 AND u.size = {0}.size"
    return f"""WITH RECURSIVE d AS (SELECT doc_id, source, coalesce(text, '') AS t, hex(encode(coalesce(text, ''))) AS x FROM documents),
s AS (SELECT doc_id, source, (length(x) // 2 + 8)::BIGINT AS size, ({crc32_sql("x")})::BIGINT AS text_crc32,
  {h.format("md5(t)")} AS ht, {h.format("coalesce(doc_id::VARCHAR, '')")} AS hi FROM d),
z AS (SELECT count(*) AS total, count(*) // {shards} AS quota, (1 << greatest(4, ceil(log2(greatest(1, count(*))) / 2)::INT)) AS cells, greatest(16, cells // 4) AS ids FROM s),
sh AS (SELECT range AS k FROM range({shards})),
g AS (SELECT {text}, count(*) AS n, arg_min(hi, o) AS hi, any_value(source) FILTER (o = 1) AS source FROM
  (SELECT *, row_number() OVER (PARTITION BY {text} ORDER BY hi, source NULLS LAST) AS o FROM s) GROUP BY {text} HAVING count(*) > 1),
b AS (SELECT {text}, n, row_number() OVER (ORDER BY n DESC, {text}) AS i FROM g, z WHERE n <= quota AND n * {SMALL} > quota),
f(i, loads, shard, start) AS (SELECT 0::BIGINT, list_transform(range({shards}), lambda j: 0::BIGINT), NULL::BIGINT, NULL::BIGINT
  UNION ALL SELECT b.i, CASE WHEN list_min(loads) + n <= quota THEN list_transform(loads, lambda v, j: CASE WHEN j = list_position(loads, list_min(loads)) THEN v + n ELSE v END) ELSE loads END,
    CASE WHEN list_min(loads) + n <= quota THEN list_position(loads, list_min(loads))::BIGINT - 1 END, list_min(loads) FROM f JOIN b ON b.i = f.i + 1, z),
l AS (SELECT arg_max(loads, i) AS loads FROM f),
c AS (SELECT k, loads[k + 1] AS load, quota - loads[k + 1] AS room, sum(quota - loads[k + 1]) OVER (ORDER BY k) - (quota - loads[k + 1]) AS before, sum(quota - loads[k + 1]) OVER () AS rooms FROM sh, l, z),
w AS (SELECT g.*, (sum(n) OVER (PARTITION BY source ORDER BY ht % {TEXT_CELLS} * ids + hi % ids, ht, hi, text_crc32, size ROWS UNBOUNDED PRECEDING) - n + n / 2.0::DOUBLE)::DOUBLE / (sum(n) OVER (PARTITION BY source))::DOUBLE AS place FROM g, z WHERE n * {SMALL} <= quota),
w1 AS (SELECT *, sum(n) OVER (ORDER BY place, hi, source NULLS LAST, {text} ROWS UNBOUNDED PRECEDING) - n AS start, sum(n) OVER () AS m FROM w),
w2 AS (SELECT w1.*, (SELECT count(*) - 1 FROM c WHERE w1.m * before // greatest(1, rooms) <= w1.start) AS shard FROM w1),
w3 AS (SELECT w2.*, c.load FROM w2 JOIN c ON c.k = w2.shard WHERE start + n - m * before // greatest(1, rooms) <= room),
u AS (SELECT {text}, n, shard, sum(n) OVER (PARTITION BY shard ORDER BY ht % cells, {text} ROWS UNBOUNDED PRECEDING) - n + load AS start FROM w3, z
  UNION ALL SELECT b.ht, b.text_crc32, b.size, b.n, f.shard, f.start FROM b JOIN f ON f.i = b.i WHERE f.shard IS NOT NULL),
e AS (SELECT k, used, sum(free) OVER (ORDER BY k) - free AS bound FROM (SELECT k, coalesce((SELECT sum(n) FROM u WHERE u.shard = k), 0) AS used,
  ((k + 1) * total + {shards - 1}) // {shards} - (k * total + {shards - 1}) // {shards} - coalesce((SELECT sum(n) FROM u WHERE u.shard = k), 0) AS free FROM sh, z)),
k1 AS (SELECT s.*, u.shard, u.start, g.n IS NULL AS kept FROM s LEFT JOIN u ON {unit.format("s")} LEFT JOIN g ON g.ht = s.ht AND g.text_crc32 = s.text_crc32 AND g.size = s.size),
r AS (SELECT k1.*, (row_number() OVER (PARTITION BY source ORDER BY ht % {TEXT_CELLS} * ids + hi % ids, ht, hi, doc_id NULLS FIRST, text_crc32, size) - 0.5::DOUBLE)
  / count(*) OVER (PARTITION BY source) AS place FROM k1, z WHERE shard IS NULL),
p AS (SELECT doc_id, source, size, text_crc32, kept, row_number() OVER (ORDER BY place, hi, source NULLS LAST, doc_id NULLS FIRST, text_crc32, size) - 1 AS pos FROM r),
q AS (SELECT p.*, (SELECT count(*) - 1 FROM e WHERE bound <= p.pos) AS shard FROM p)
SELECT doc_id, source, size, text_crc32, '{LAW}' AS law, shard::INT AS shard, (pos - bound + used)::BIGINT AS slot, NULL::INT AS grown_shard, kept FROM q JOIN e ON e.k = q.shard
UNION ALL SELECT doc_id, source, size, text_crc32, '{LAW}', shard::INT, (start + row_number() OVER (PARTITION BY {text} ORDER BY hi % ids, hi, source NULLS LAST, doc_id NULLS FIRST) - 1)::BIGINT, NULL, true FROM k1, z WHERE shard IS NOT NULL"""
