"""Quality by importance resampling: hashed n-gram models of target and raw text, and a Gumbel top-k sample.

Word unigrams and bigrams are hashed into buckets; the raw model counts them over all documents, the target model over
those of good quality. A document's log weight is the sum over its n-grams of log(target / raw); with Gumbel noise
from the hash of its id added, the k highest keys are a sample without replacement in proportion to the weights.

Results for odd input: a text without words has no n-grams, no weight, and is not kept; a null id has noise of its
own; rows equal in id and text have equal keys and are kept or left together; of several labels for a document the
highest counts; without good documents both models are equal, so that the noise alone decides; with no documents
there are no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, staged
from .shingles import Words, mixed, sliced, windows

BUCKET_BITS, SEED = 16, 4


def buckets(h: np.ndarray, bits: int) -> np.ndarray:
    """Buckets of all unigrams and bigrams of a text's word hashes."""
    if not len(h):
        return np.empty(0, np.int64)
    grams = np.concatenate([windows(h, 1), windows(h, 2)]) if len(h) > 1 else windows(h, 1)
    return (grams >> np.uint64(64 - bits)).astype(np.int64)


def _counter(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
        for batch in sliced(batches):
            words = Words(batch.column("text"))
            grams = [buckets(words.of(k), bits) for k in range(len(words))]
            good = [g for g, is_good in zip(grams, batch.column("good").to_pylist(), strict=True) if is_good]
            raw += np.bincount(np.concatenate(grams), minlength=1 << bits)
            if good:
                target += np.bincount(np.concatenate(good), minlength=1 << bits)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(target[some])], names=["bucket", "raw", "target"])

    return run


def _weigher(ratio: np.ndarray, bits: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = np.uint64(seed)
        for batch in sliced(batches):
            words = Words(batch.column("text"))
            grams = [buckets(words.of(k), bits) for k in range(len(words))]
            ids = np.array([0 if x is None else x + 1 for x in batch.column("id").to_pylist()], np.int64).view(np.uint64)
            u = (mixed(mixed(ids * np.uint64(0x9E3779B97F4A7C15) + salt)) >> np.uint64(11)).astype(float) + 0.5
            noise = -np.log(-np.log(u / 2.0**53))
            weight = np.array([ratio[g].sum() if len(g) else np.nan for g in grams])
            n = np.array([len(g) for g in grams], np.int64)
            none = n == 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n), pa.array(weight, pa.float64(), mask=none), pa.array(weight + noise, pa.float64(), mask=none)],
                names=["id", "n_grams", "log_weight", "key"],
            )

    return run


def kth_highest(keys: DataFrame, k: int, bins: int = 1024, few: int = 5_000) -> tuple[float, int | None] | None:
    """(key, id) of the k-th highest row of (key, id) by key and then lower id; by counts in ever narrower bins, so that only a few rows reach the driver. None if there are not k."""
    keys = keys.where("key IS NOT NULL")
    low, high, n = keys.agg(F.min("key"), F.max("key"), F.count("*")).first()
    if k < 1 or n < k:
        return None
    here = keys
    while n > few and high > low:
        step = (high - low) / bins
        at = F.least(F.floor((F.col("key") - low) / step), F.lit(bins - 1))
        counts = {r["at"]: (r["n"], r["low"], r["high"]) for r in here.groupBy(at.alias("at")).agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")).collect()}
        for b in sorted(counts, reverse=True):
            if k <= counts[b][0]:
                break
            k -= counts[b][0]
        n, low, high = counts[b]
        here = keys.where((F.col("key") >= low) & (F.col("key") <= high))
    if high == low and n > few:  # equal keys: all of them are taken
        return low, None
    row = here.groupBy("key", "id").count().orderBy(F.desc("key"), "id").collect()
    for r in row:
        k -= r["count"]
        if k <= 0:
            return r["key"], r["id"]
    return low, None


def resample(docs: DataFrame, good: DataFrame, share: float, id_col: str = "doc_id", text_col: str = "text", bits: int = BUCKET_BITS, seed: int = SEED) -> DataFrame:
    """(id, n_grams, log_weight, key, kept) for every row; ``good`` has the ids of the target documents, ``share`` of all rows is sampled."""
    ids = staged(good.select(F.col(id_col).alias("id")).where("id IS NOT NULL").distinct().withColumn("good", F.lit(True)), "good")
    text = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    counts = text.join(broadcast_if_small(ids), "id", "left").select("text", "good").mapInArrow(_counter(bits), "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw"), F.sum("target"))
    raw, target = np.zeros(1 << bits), np.zeros(1 << bits)
    for b, r, t in counts.collect():  # at most 2 ** bits rows, whatever the input
        raw[b], target[b] = r, t
    model = lambda c: np.log((c + 1.0) / (c.sum() + len(c)))
    ratio = model(target) - model(raw) if target.any() else np.zeros(1 << bits)
    scores = staged(text.mapInArrow(_weigher(ratio, bits, seed), "id long, n_grams long, log_weight double, key double"), "weights")
    last = kth_highest(scores.select("key", "id"), round(share * scores.count()))
    if last is None:
        kept = F.col("key").isNotNull()
    elif last[1] is None:
        kept = F.coalesce(F.col("key") >= last[0], F.lit(False))
    else:
        kept = F.coalesce((F.col("key") > last[0]) | (F.col("key") == last[0]) & (F.coalesce("id", F.lit(-(1 << 63))) <= last[1]), F.lit(False))
    return scores.withColumn("kept", kept)


def op4_importance_resampling(spark, sf_dir: str) -> DataFrame:
    """Samples as large a share of all documents as is good among the labelled ones."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    share = labels.agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0] or 0.0
    return resample(docs, labels.where("quality = 1"), share).withColumnRenamed("id", "doc_id")
