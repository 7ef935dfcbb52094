"""MinHash near-dedup: one-permutation hashing with optimal densification, banded buckets, star-shaped edges.

A set is known by its document's id and a digest, so that different texts under one id are documents of their own.

Results for odd input: a null, empty or blank text has an empty set, is linked with nothing and is its own
component; equal rows are one set, so they share a component; of different texts with one id each is linked for
itself; rows without an id take part in no link, have no component and are kept; extra columns of the input are not
read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, components, released, renamed, staged
from .shingles import MIX_A, Words, gram_sets, mixed, sliced

WORDS, BINS, BAND_ROWS, PERCENT = 5, 128, 4, 75
#: A document's set: its id, which orders them, and a digest of the set.
NODE = pa.struct([("id", pa.int64()), ("set", pa.int64())])
NODE_SQL = "struct<id:bigint,set:bigint>"


def digests_of(sets: list[np.ndarray]) -> np.ndarray:
    return np.array([np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64) for s in sets], np.int64).reshape(-1, 2)


def nodes_of(ids: pa.Array, digests: np.ndarray) -> pa.Array:
    return pa.StructArray.from_arrays([ids, pa.array(digests[:, 0])], fields=list(NODE))


def probe_ranks(bins: int = BINS, seed: int = 6) -> np.ndarray:
    """rank[j, b]: the step at which the probe sequence of bin j, a random order of all bins, comes to bin b."""
    rng = np.random.default_rng(seed)
    return np.argsort(np.stack([rng.permutation(bins) for _ in range(bins)]), axis=1)


def signature(unique: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """One minimum per bin from a single pass over sorted unique hashes; an empty bin borrows the first filled bin of its own probe sequence (optimal densification)."""
    bins = len(ranks)
    where = (unique >> np.uint64(64 - (bins.bit_length() - 1))).astype(np.int64)
    first = np.flatnonzero(np.diff(where, prepend=-1))
    out = np.empty(bins, np.uint64)
    filled = where[first]
    out[filled] = unique[first]
    if len(filled) < bins:
        empty = np.setdiff1d(np.arange(bins), filled, assume_unique=True)
        out[empty] = out[filled[ranks[empty][:, filled].argmin(1)]]
    return out


def band_hashes(sig: np.ndarray, rows: int = BAND_ROWS) -> np.ndarray:
    acc = np.arange(1, len(sig) // rows + 1, dtype=np.uint64) * MIX_A
    for column in sig.reshape(-1, rows).T:
        acc = mixed(acc * MIX_A + column)
    return acc


def sets_of(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in sliced(batches):
        yield batch, gram_sets(Words(batch.column("text")), k)


def _sketch(k: int, bins: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = probe_ranks(bins)
        for batch, sets in sets_of(batches, k):
            digests = digests_of(sets)
            bands = [band_hashes(signature(s, ranks), rows).view(np.int64) if len(s) else np.empty(0, np.int64) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [nodes_of(batch.column("id"), digests), batch.column("digest"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests[:, 1]), pa.array(bands, pa.list_(pa.int64()))],
                names=["node", "digest", "n", "set_b", "bands"],
            )

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in sets_of(batches, k):
            yield pa.RecordBatch.from_arrays([nodes_of(batch.column("id"), digests_of(sets)), pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "hashes"])

    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        sets = [np.frombuffer(x, np.int64) for x in batch.column("hashes").to_pylist()]
        sizes = np.array([len(s) for s in sets], np.int64)
        nodes = batch.column("node").take(pa.array(np.repeat(np.arange(len(sets)), sizes)))
        yield pa.RecordBatch.from_arrays([nodes, pa.array(np.repeat(sizes, sizes)), pa.array(np.concatenate(sets) if sets else np.empty(0, np.int64))], names=["node", "n", "token"])


def _exact_pairs(left: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, na, b, nb): all pairs of ``left`` (node, c, apart), one of them apart, that may reach the similarity: an exact join by prefixes.

    Shingles are put in one order, rare ones first. Sets that reach the similarity share a shingle so early in both
    that enough of either follow it; what only one set holds comes first and counts, so that the variants of a text,
    which differ by shingles of their own, meet only if they may be near.
    """
    tokens = sets.join(broadcast_if_small(renamed(left, node="node")), "node", "left_semi").mapInArrow(_tokens, f"node {NODE_SQL}, n long, token long")
    shared = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    listed = tokens.join(shared, "token").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("s"))  # no longer than its set
    first = listed.withColumn("own", F.col("n") - F.size("s")).select("node", "n", "own", F.posexplode("s").alias("k", "x"))
    first = first.select("node", "n", F.col("x.token").alias("token"), (F.col("n") - F.col("own") - F.col("k")).alias("ahead")).where(F.col("ahead") * 100 >= F.col("n") * percent)
    first = staged(first.join(broadcast_if_small(left), "node"), "prefixes")
    a = first.where("apart").select("token", F.col("node").alias("a"), F.col("n").alias("na"), F.col("ahead").alias("xa"), F.col("c").alias("ca"))
    b = first.select("token", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("ahead").alias("xb"), F.col("c").alias("cb"))
    enough = F.least("xa", "xb") * (100 + percent) >= (F.col("na") + F.col("nb")) * percent
    pairs = a.join(b, (a["token"] == b["token"]) & (F.col("ca") != F.col("cb")) & enough)
    return pairs.select(F.least("a", "b").alias("a"), F.when(F.col("a") < F.col("b"), F.col("na")).otherwise(F.col("nb")).alias("na"), F.greatest("a", "b").alias("b"), F.when(F.col("a") < F.col("b"), F.col("nb")).otherwise(F.col("na")).alias("nb"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, bins: int = BINS, band_rows: int = BAND_ROWS, percent: int = PERCENT) -> DataFrame:
    """(id, digest, n_shingles, component, kept) for every row: components of the links with |A & B| >= percent% of |A | B|, named by their smallest id; digest is the xxhash64 of the text.

    Equal sets are first folded to one representative. Its signature is cut into bands; a bucket of one band gives
    star edges from its hub only, each confirmed on the full sets. Where a bucket is left with several components, its
    members outside the largest are held against all members of such buckets by an exact join; so a link is lost
    only if a pair meets in no band at all ((1 - 0.75^4)^32, about 5 in a million, at the threshold). Of a component
    the set with the smallest id is kept, and of different texts with that very id and set that with the least digest.
    """
    text = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    sketch = text.withColumn("digest", F.xxhash64("text")).mapInArrow(_sketch(words, bins, band_rows), f"node {NODE_SQL}, digest long, n long, set_b long, bands array<long>")
    sketch = staged(sketch, "sketch")
    usable = sketch.where("n > 0 AND node.id IS NOT NULL")
    same = usable.groupBy(F.col("node.set").alias("set_a"), "set_b").agg(F.min("node").alias("rep"))
    usable = usable.withColumn("set_a", F.col("node.set")).join(same, ["set_a", "set_b"])
    member = staged(usable.select("node", "digest", "n", "rep", F.when(F.col("node") == F.col("rep"), F.col("bands")).alias("bands")), "member")
    banded = member.where("bands IS NOT NULL").select("node", "n", F.explode("bands").alias("bucket")).distinct()
    shared = banded.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("bucket", "low")
    group = staged(banded.join(shared, "bucket"), "buckets")
    ids = staged(group.select("node.id").distinct(), "candidates")
    sets = staged(text.join(broadcast_if_small(ids), "id", "left_semi").mapInArrow(_sets(words), f"node {NODE_SQL}, hashes binary").dropDuplicates(["node"]), "sets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        near = pairs.where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent).select("a", "b").distinct()
        with_b = near.join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("y")), "b")
        return with_b.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("x")), "a").select("a", "b", "x", "y").mapInArrow(_confirm(percent), f"a {NODE_SQL}, b {NODE_SQL}")

    hubs = group.where("node = low").select("bucket", F.col("node").alias("a"), F.col("n").alias("na"))
    rest = group.where("node <> low").select("bucket", "node", "n")
    links = staged(confirmed(rest.join(hubs, "bucket").select("a", "na", F.col("node").alias("b"), F.col("n").alias("nb"))), "links")
    of = components(links)
    part = rest.join(broadcast_if_small(renamed(of, node="id", component="component")), "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("c"))
    size = part.groupBy("bucket", "c").agg(F.count("*").alias("rows"))
    main = size.groupBy("bucket").agg(F.count("*").alias("parts"), F.max_by("c", F.struct("rows", "c")).alias("main")).where("parts > 1")
    left = part.join(main, "bucket").groupBy("node", "c").agg(F.bool_or(F.col("c") != F.col("main")).alias("apart"))
    left = staged(left, "left")
    if not left.isEmpty():
        more = staged(confirmed(_exact_pairs(left, sets, percent)), "links")
        if not more.isEmpty():
            of = components(of.select(F.col("id").alias("a"), F.col("component").alias("b")).union(more))
        released(more)
    released(group, ids, sets, links, left)

    found = member.select("node", "digest", "n", "rep").join(broadcast_if_small(renamed(of, rep="id", component="component")), "rep", "left")
    found = found.select("node", "digest", "n", F.coalesce("component", "rep").alias("c"))
    least = member.where("node = rep").groupBy(F.col("node").alias("m")).agg(F.min("digest").alias("d"), F.max("digest").alias("e")).where("d <> e").select("m", "d")
    found = found.join(broadcast_if_small(staged(least, "several-texts")), (F.col("node") == F.col("m")) & (F.col("digest") != F.col("d")), "left")
    found = found.select("node.id", "digest", F.col("n").alias("n_shingles"), F.col("c.id").alias("component"), ((F.col("node") == F.col("c")) & F.col("m").isNull()).alias("kept"))
    alone = sketch.where("n = 0 OR node.id IS NULL").select("node.id", "digest", F.col("n").alias("n_shingles"), F.col("node.id").alias("component"), F.lit(True).alias("kept"))
    return found.union(alone)


def op6_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    own = F.coalesce(F.col("id") == F.col("component"), F.lit(True))
    return near_dedup(docs).select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), own.alias("kept"))


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i:i+4], ' '))) END AS s FROM words
), one AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM one a JOIN one b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach(id, c) AS (SELECT doc_id, doc_id FROM sets UNION SELECT l.b, r.c FROM reach r JOIN links l ON l.a = r.id),
low AS (SELECT id, min(c) AS c FROM reach GROUP BY id)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, c AS component_id, doc_id = c AS kept FROM sets JOIN low ON id = doc_id
"""
