"""Mixing sources to target weights by a low-discrepancy schedule.

Slot i of the schedule is the point frac((i + 1) / golden ratio) mapped through the cumulative targets of the
sources; slots are ranked per source, and rank r takes block r of that source's shuffled words, blocks having equal
numbers of words and starting over after the last. How many slots a source gets, and so what is taken of it, is what
the points draw: within a few blocks of its target (the discrepancy of the points), and never more than ``most`` times
its words, where the last block is cut.

Results for odd input: a null, empty or blank text has size 0 and is never taken; null is a source of its own, the
last; equal rows are separate documents (their shares are equal or follow each other in the shuffle); without
documents or words nothing is taken; extra columns are not read. Rows are shuffled by id and text, so that many rows of
one id, or without one, are spread like others; a null id counts as the text "null". A source whose
target is less than a block may get no slot, or one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, broadcast_if_small, indexed, staged

WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
BLOCK_WORDS = 64
#: 1 / golden ratio, and the fraction of STEP times it, so that points far out lose no precision.
GOLDEN, STEP, GOLDEN_STEP = 0.6180339887498949, 1 << 20, 0.607787409740351
CELLS, CHUNK = 4096, 65_536
#: Documents of one source that one task puts in order.
BUCKET_ROWS = 8192


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    words = F.size(F.filter(F.split(F.col(text_col), SPACE), lambda w: w != ""))
    shuffled = F.md5(F.concat(F.lit("mix-"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit("-"), F.md5(F.coalesce(F.col(text_col), F.lit("")))))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("digest"), F.col(source_col).alias("source"), F.when(F.col(text_col).isNull(), 0).otherwise(words).cast("long").alias("size"), shuffled.alias("h"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """One row per source: index in code point order (null last), source_size, weight and target.

    All targets together are ``share`` times all sizes, by weight; none is above ``most`` times its source's size,
    and what that leaves goes to the others by weight. The level is found by sums alone.
    """
    s = indexed(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), [F.col("source").asc_nulls_last()], "sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("index") % len(weights) + 1).cast("int"))
    s = s.withColumn("weight", weight).withColumn("cap", (F.col("source_size") * most).cast("double"))
    total = (s.agg(F.sum("source_size")).first()[0] or 0) * share
    level = 0.0
    while True:
        full = F.col("cap") <= F.col("weight") * level
        used, open_weight = s.agg(F.sum(F.when(full, F.col("cap"))), F.sum(F.when(~full, F.col("weight")))).first()
        after = (total - (used or 0.0)) / open_weight if open_weight else float("inf")
        if after <= level or open_weight is None:
            break
        level = after
    return s.withColumn("target", F.least("cap", F.col("weight") * level)).drop("cap")


def placed(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """Documents with the place ``start`` of their first word in the shuffled words of their source; places are summed in two levels, so that no task sees a whole source."""
    n = sizes.count()
    buckets = -(-n // BUCKET_ROWS) or 1
    d = sizes.join(broadcast_if_small(sources).withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of", "weight")
    d = d.withColumn("bucket", F.floor(F.conv(F.substring("h", 1, 7), 16, 10).cast("long") * buckets / (1 << 28)))
    sums = d.groupBy(F.col("index").alias("s"), F.col("bucket").alias("b")).agg(F.sum("size").alias("words"))
    sums = staged(sums.withColumn("before", F.sum("words").over(Window.partitionBy("s").orderBy("b")) - F.col("words")).drop("words"), "places")
    inside = F.sum("size").over(Window.partitionBy("index", "bucket").orderBy("h", "size", "id").rowsBetween(Window.unboundedPreceding, 0))
    d = d.withColumn("inside", inside - F.col("size"))
    return d.join(broadcast_if_small(sums), (F.col("index") == F.col("s")) & (F.col("bucket") == F.col("b"))).withColumn("start", F.col("before") + F.col("inside")).drop("s", "b", "before", "inside", "bucket", "h")


def points(n: int, spark) -> DataFrame:
    """(slot, u): the first ``n`` points."""
    i = F.col("id")
    u = F.floor(i / STEP) * GOLDEN_STEP + (i % STEP + 1) * GOLDEN
    return spark.range(n).select(i.alias("slot"), (u - F.floor(u)).alias("u"))


def schedule(sources: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """(slot, index, rank): which source each slot draws, and its rank among the slots of that source."""
    spark = sources.sparkSession
    s = sources.select("index", "target").withColumn("part", F.col("index") - F.col("index") % CHUNK)
    parts = s.groupBy("part").agg(F.sum("target").alias("t")).withColumn("base", F.sum("t").over(Window.orderBy("part")) - F.col("t")).select("part", "base")
    s = s.join(parts, "part").withColumn("high", F.col("base") + F.sum("target").over(Window.partitionBy("part").orderBy("index")))
    total = s.agg(F.sum("target")).first()[0] or 0.0
    if not total:
        return spark.createDataFrame([], "slot long, index long, rank long")
    s = s.select("index", ((F.col("high") - F.col("target")) / total).alias("low"), F.when(F.col("high") >= total, 1.0).otherwise(F.col("high") / total).alias("high"))
    cells = s.where("low < high").select("index", "low", "high", F.explode(F.sequence(F.floor(F.col("low") * CELLS), F.least(F.floor(F.col("high") * CELLS), F.lit(CELLS - 1)))).alias("cell"))
    slots = points(round(total / block) or 1, spark).withColumn("cell", F.floor(F.col("u") * CELLS))
    drawn = slots.join(broadcast_if_small(staged(cells, "cells")), "cell").where("low <= u AND u < high").select("slot", "index", F.floor(F.col("slot") / CHUNK).alias("chunk"))
    drawn = staged(drawn, "slots")
    count = drawn.groupBy("index", "chunk").agg(F.count("*").alias("c")).withColumn("before", F.sum("c").over(Window.partitionBy("index").orderBy("chunk")) - F.col("c"))
    ranked = drawn.withColumn("in", F.row_number().over(Window.partitionBy("index", "chunk").orderBy("slot"))).join(count, ["index", "chunk"])
    return ranked.select("slot", "index", (F.col("before") + F.col("in") - 1).alias("rank"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = BLOCK_WORDS, most: int = MOST, **rates) -> tuple[DataFrame, DataFrame]:
    """(documents, segments): documents with size, source_size, target and start; segments with the words [first, first + words) of a document that a slot takes in its ``turn`` of the source."""
    sizes = staged(sized(docs, id_col, text_col, source_col), "sizes")
    sources = staged(targets(sizes, most=most, **rates), "targets")
    slots = staged(schedule(sources, block), "schedule")
    due = slots.groupBy("index").agg(F.count("*").alias("slots"))
    due = sources.join(due, "index", "left").select("index", F.least(F.coalesce("slots", F.lit(0)) * block, F.col("source_size") * most).alias("due"))
    d = staged(placed(sizes, sources).join(broadcast_if_small(staged(due, "due")), "index"), "placed")
    whole = F.sequence(F.lit(0).cast("long"), F.floor((F.col("due") - 1 - F.col("start")) / F.col("source_size")))
    turn = d.where("size > 0 AND start < due").withColumn("turn", F.explode(whole)).withColumn("from", F.col("turn") * F.col("source_size") + F.col("start"))
    turn = turn.withColumn("to", F.least(F.col("from") + F.col("size"), F.col("due")))
    part = turn.withColumn("rank", F.explode(F.sequence(F.floor(F.col("from") / block), F.floor((F.col("to") - 1) / block))))
    low, high = F.greatest("from", F.col("rank") * block), F.least("to", (F.col("rank") + 1) * block)
    part = part.select("id", "digest", "source", "index", "size", "source_size", "target", "start", "rank", "turn", (low - F.col("from")).alias("first"), (high - low).alias("words"))
    return d, part.join(slots, ["index", "rank"])


KEY = ["id", "digest", "source", "size", "source_size", "target", "start"]


def taken(docs: DataFrame, **options) -> DataFrame:
    """One row for every document: size, source, source_size, target, and the words that the mix takes of it."""
    d, segments = mixed(docs, **options)
    some = segments.groupBy(KEY).agg(F.sum("words").alias("taken"))
    return some.union(d.where("size = 0 OR start >= due").select(*KEY, F.lit(0).cast("long"))).drop("start", "digest")


def copies(docs: DataFrame, **options) -> DataFrame:
    """(id, digest, source, size, words): a row for each time that the mix takes a document, with how many of its words, from its first on; digest is the xxhash64 of its text."""
    _, segments = mixed(docs, **options)
    return segments.groupBy(*KEY, "turn").agg(F.sum("words").alias("words")).select("id", "digest", "source", "size", "words")


def op5_low_discrepancy_mix(spark, sf_dir: str) -> DataFrame:
    out = taken(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix-' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '-' || md5(coalesce(text, ''))) AS h FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS k FROM d GROUP BY source
), w AS (SELECT source, source_size, 2.0::DOUBLE * source_size AS cap, CASE k WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::DOUBLE AS weight FROM s),
p AS (
  SELECT *, cap / weight AS ratio, 1.5::DOUBLE * sum(source_size) OVER () AS total,
         coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
         sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open FROM w
), l AS (SELECT min((total - used) / open) AS level FROM (SELECT *, row_number() OVER (ORDER BY ratio, source NULLS LAST) AS i FROM p WHERE ratio > (total - used) / open QUALIFY i = 1)),
t AS (SELECT source, source_size, CASE WHEN level IS NULL OR cap <= level * weight THEN cap ELSE level * weight END AS target FROM w, l), c AS (
  SELECT source, sum(target) OVER (ORDER BY source NULLS LAST ROWS UNBOUNDED PRECEDING) AS high, target, sum(target) OVER () AS total FROM t
), b AS (SELECT source, (high - target) / total AS low, CASE WHEN high >= total THEN 1.0::DOUBLE ELSE high / total END AS high FROM c WHERE total > 0),
i AS (SELECT unnest(range((SELECT CAST(greatest(round(sum(target) / {block}), 1) AS BIGINT) FROM t))) AS i),
u AS (SELECT floor(i / {step}) * {golden_step}::DOUBLE + (i % {step} + 1) * {golden}::DOUBLE AS x FROM i),
n AS (SELECT source, count(*) AS slots FROM b JOIN (SELECT x - floor(x) AS u FROM u) p ON low <= u AND u < high GROUP BY source),
q AS (SELECT t.source, source_size, target, CAST(least(coalesce(slots, 0) * {block}, 2 * source_size) AS BIGINT) AS q FROM t LEFT JOIN n ON t.source IS NOT DISTINCT FROM n.source),
o AS (
  SELECT d.*, source_size, target, q, sum(size) OVER (PARTITION BY d.source ORDER BY h, size, doc_id ROWS UNBOUNDED PRECEDING) - size AS start
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source
)
SELECT doc_id, size, source_size, target,
       CAST(greatest(0, least(size, q - start)) + greatest(0, least(size, q - source_size - start)) AS BIGINT) AS taken FROM o
""".format(block=BLOCK_WORDS, step=STEP, golden=GOLDEN, golden_step=GOLDEN_STEP)
