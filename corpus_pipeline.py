"""From documents to encoded training rows: five stages, each a written table that the next one reads.

1. quality: ordinal regression on the ratings of the documents at hand; those whose probability of the highest grade
   is below one half go. 2. toxicity: lexicon and context score, learnt from the labels whose crc32(doc_id) mod 5 isn't
0; those at one half or more go. 3. near duplicates: SimHash links of 7 bits and MinHash bands give pairs that are
checked exactly; of each component linked by a Jaccard similarity of 0.8 over 5-word shingles one document stays.
4. mixing: whole copies and Pareto samples bring the sources to their target weights; a document may come twice.
5. encoding: SentencePiece ids of the whole text, decoded again.
"""

from __future__ import annotations

from chronokey.llm import mixing, pieces, quality, simhash, toxicity
from chronokey.llm.queries import not_held_out, tokenizer
from chronokey.llm.shared import read, written
from chronokey.scratch import free
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = quality.select(docs, read(spark, sf_dir, "labels"), "quality")
    return rows.where("keep").select(docs.columns)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), not_held_out())
    return toxicity.score(docs, model).where("toxicity < 0.5").select(docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs, simhash.near_copies(docs))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixture(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = pieces.encode(docs, tokenizer("piece_bpe_32k.model"))
    same = F.col("decoded") == F.translate(F.coalesce("text", F.lit("")), pieces.SPACE, " ")
    return rows.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("decodes"))


STAGES = [("quality", quality_stage), ("toxicity", toxicity_stage), ("near_duplicates", near_duplicate_stage), ("mixing", mixing_stage), ("encoding", encoding_stage)]

#: No SQL has SimHash links, MinHash bands, trained scores or piece ids; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, written(stage(spark, docs, sf_dir), f"stage-{name}")
        free(before)  # a stage's table is there until the next one is
    return docs
