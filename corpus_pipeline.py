"""The corpus pipeline: quality rules, MinHash near-dedup, substring dedup, source mixing, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; all but the last return the columns of
documents, and columns besides these are not read, whatever their names. Rows without an id pass the deduplicating
stages, which cannot name them, and are mixed and packed; rows that share an id are told apart by their text, and by
their language where it matters. A null or empty text fails the quality rules; very long texts are read whole; of equal
rows the near-dedup keeps one. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veinstone.llm.common import SPACE, broadcast_if_small, released_since, staged, staged_now
from veinstone.llm.mixing import copies
from veinstone.llm.near_dedup import near_dedup
from veinstone.llm.packing import pack
from veinstone.llm.quality_rules import digest_of, quality_rules
from veinstone.llm.substring_dedup import substring_dedup

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
WITH_WORD = r"[^\x20\x09-\x0D]"


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that the quality rules keep; a row that they reject is gone, whatever other rows have its id."""
    docs = docs.select(COLUMNS)
    d = docs.withColumn("_digest", digest_of(F.col("text"), F.col("lang")))
    no = staged(quality_rules(docs).where("NOT kept").select(F.col("id").alias("_id"), F.col("digest").alias("_no")).distinct(), "rejected")
    return d.join(broadcast_if_small(no), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_digest") == F.col("_no")), "left_anti").select(COLUMNS)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id, and one row of it."""
    docs = docs.select(COLUMNS)
    result = staged(near_dedup(docs), "near")
    key = (F.col("id").alias("_id"), F.col("digest").alias("_no"))
    same = (F.col("doc_id") == F.col("_id")) & (F.col("_digest") == F.col("_no"))
    d = docs.withColumn("_digest", F.xxhash64(F.col("text").cast("binary")))
    drop = broadcast_if_small(staged(result.where("NOT kept").select(*key).distinct(), "duplicates"))
    left = d.join(drop, same, "left_anti")
    again = staged(result.where("kept AND id IS NOT NULL").groupBy(*key).count().where("count > 1").select("_id", "_no"), "repeated-rows")
    if again.isEmpty():
        return left.select(COLUMNS)
    once = broadcast_if_small(again)
    return left.join(once, same, "left_anti").unionByName(left.join(once, same, "left_semi").dropDuplicates(["doc_id", "_digest"])).select(COLUMNS)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier document holds; those that were nothing else are gone."""
    out = substring_dedup(docs.select(COLUMNS), keep=("lang", "source"))
    out = out.where((F.col("removed_words") == 0) | F.col("text").rlike(WITH_WORD))
    return out.select(F.col("id").alias("doc_id"), "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document each time that the mix takes it; one of which it takes only a part is cut behind that, its words between single spaces."""
    docs = docs.select(COLUMNS)
    times = copies(docs).select(F.col("id").alias("_id"), F.col("digest").alias("_digest"), F.col("source").alias("_source"), "size", "words")
    times = broadcast_if_small(staged(times, "times"))
    d = docs.withColumn("_text", F.xxhash64("text"))
    d = d.where("doc_id IS NOT NULL").unionByName(d.where("doc_id IS NULL").dropDuplicates(["_text", "source"]))  # of equal rows without an id, one has the times of all
    out = d.join(times, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_digest")) & F.col("source").eqNullSafe(F.col("_source")))
    words = F.filter(F.split("text", SPACE), lambda w: w != "")
    cut = F.array_join(F.slice(words, F.lit(1), F.col("words").cast("int")), " ")
    return out.withColumn("text", F.when(F.col("words") < F.col("size"), cut).otherwise(F.col("text"))).withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return pack(docs.select(COLUMNS))


STAGES = [("quality rules", rules), ("near dedup", near), ("substring dedup", substrings), ("mixing", mix), ("packing", packing)]
#: SQL cannot express packing with a tokenizer; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(COLUMNS)
    before = staged_now()
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(docs, f"stage-{k}")
            released_since(before, docs)
    return docs
