"""Column hygiene and Arrow plumbing shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import written  # noqa: F401  the operators take it from here

#: A word: a maximal run of characters that are neither space nor \x09-\x0D.
WORD = r"[^\x20\x09-\x0D]+"


def arrow_schema(schema: str | T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T.StructType.fromDDL(schema) if isinstance(schema, str) else schema)


def map_texts(df: DataFrame, schema: str, work: Callable[[list], list[list]]) -> DataFrame:
    """work(columns of a batch as Python lists) -> columns of the result, batch by batch, order kept.

    df's columns come in order; the result's columns are schema's.
    """
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                cols = work([c.to_pylist() for c in part.columns])
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, out, strict=True)], schema=out)

    return plain_names(df).mapInArrow(run, schema)


def plain_names(df: DataFrame) -> DataFrame:
    """Columns by place: mapInArrow finds its columns by name, which fails for clashing or dotted ones."""
    return df.toDF(*(f"c{k}" for k in range(len(df.columns))))


def slices(batch: pa.RecordBatch, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about `most` bytes, so that Python objects of few rows exist at a time."""
    rows, size = batch.num_rows, batch.nbytes
    step = max(1, int(rows * most / max(size, 1)))
    for at in range(0, rows, step):
        yield batch.slice(at, step)


def appended(df: DataFrame, inputs: list[str], schema: str, work: Callable[[list], list[list]], replace: bool = True) -> DataFrame:
    """df with schema's columns appended by work over the columns `inputs`; columns of clashing names are replaced."""
    new = T.StructType.fromDDL(schema)
    taken = {f.name.lower() for f in new}
    keep = [f for f in df.schema if f.name.lower() not in taken]
    pos = [[f.name for f in df.schema].index(c) for c in inputs]
    full = T.StructType([*keep, *new])
    out, n_in = arrow_schema(full), [f.name for f in df.schema]
    kept = [n_in.index(f.name) for f in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                cols = work([part.column(i).to_pylist() for i in pos])
                made = [pa.array(c, out.field(len(kept) + k).type) for k, c in enumerate(cols)]
                yield pa.RecordBatch.from_arrays([part.column(i).cast(out.field(k).type) for k, i in enumerate(kept)] + made, schema=out)

    return plain_names(df).mapInArrow(run, full)


def one_text_each(docs: DataFrame, rated: DataFrame, key: str, id_col: str, text_col: str, sample: int) -> DataFrame:
    """rated (one row for each `key`) with t, a text of that id: at most `sample` rows, the first by hash of the id.

    An id that several rows of docs hold gives one row, the text of the smallest hash; an id without a row gives none.
    """
    rated = rated.orderBy(F.xxhash64(key), key).limit(sample)  # bounded by the sample, hence broadcast
    rows = docs.select(F.col(id_col).cast("long").alias("d_id"), F.col(text_col).alias("t")).join(F.broadcast(rated), F.col("d_id") == F.col(key))
    return rows.groupBy(*rated.columns).agg(F.min_by("t", F.xxhash64("t")).alias("t"))


_tables: dict[tuple, object] = {}


def table(kind: str, tag: str, make: Callable[[], object]):
    """A worker process's table for a model. One at a time: workers live on from stage to stage, tables don't."""
    if (kind, tag) not in _tables:
        _tables.clear()
        _tables[kind, tag] = make()
    return _tables[kind, tag]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def word_count(text) -> F.Column:
    """Number of words of a text column; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
