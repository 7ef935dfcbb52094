"""Document fingerprints by consistent weighted sampling (native DataFrame operations only).

The terms of a text are its words, weighted by how often they occur. For every term and sample there are gamma
variates r, c ~ Gamma(2, 1) and a uniform b, all from hashes; a term of weight S gets t = floor(ln S / r + b) and the
value ln c - r (t - b) - r, and the sample is the (term, t) with the least value. Two texts agree in a sample with
probability sum(min(S, S')) / sum(max(S, S')), the generalised Jaccard similarity of their weights.

The next document is found without a global sort in one task: ranges of ids, cut at quantiles, go to windows of their
own, an id that very many rows have is cut by the hash of the text, and the first document of each range is sent to the
range before it as well. A likeness is the share of ``SAMPLES`` samples that agree: its standard error is
sqrt(s (1 - s) / SAMPLES), 0.08 at most.

Results for odd input: a null or empty text has no terms, and its samples are all 0, so it is like itself (1) and
like no other text (0); ties of id are ordered by a hash of the text, null ids come last; equal rows follow each
other; one row alone is its own next document; no rows give none; extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE

BLOCKS, WIDTH = 5, 8
SAMPLES = BLOCKS * WIDTH
#: Ranges of ids to a shuffle partition, so that sizes even out.
RANGES = 4
LOWEST = -(1 << 63)


def sample(term: Column, log_weight: Column, j: Column) -> Column:
    """Value (high 31 bits) and hash of (term, t) (low 32 bits) of sample ``j`` for one term; the least over all terms is the sample."""
    x, y = F.xxhash64(term, j), F.xxhash64(j, term)
    unit = lambda h, shift: (F.shiftrightunsigned(h, shift).bitwiseAND((1 << 25) - 1) + 0.5) / float(1 << 25)
    r = -F.log(unit(x, 39) * unit(x, 14))
    c = -F.log(unit(y, 39) * unit(y, 14))
    b = (F.shiftleft(x.bitwiseAND(16383), 14).bitwiseOR(y.bitwiseAND(16383)) + 0.5) / float(1 << 28)
    t = F.floor(log_weight / r + b)
    value = F.log(c) - r * (t - b) - r
    high = F.greatest(F.lit(0), ((value + 160.0) * float(1 << 23)).cast("long"))
    return F.shiftleft(high, 32).bitwiseOR(F.xxhash64(term, t).bitwiseAND(0xFFFFFFFF))


def terms(text: Column) -> Column:
    """Sorted hashes of all words."""
    return F.sort_array(F.transform(F.filter(F.split(text, SPACE), lambda w: w != ""), lambda w: F.xxhash64(w)))


def weighted(units: DataFrame) -> DataFrame:
    """``units`` with its column ``h`` (sorted word hashes) exploded to term and log_weight; one row of nulls where it is empty."""
    first = F.array_compact(F.transform("h", lambda x, i: F.when((i == 0) | (x != F.get("h", i - 1)), i)))
    units = units.withColumn("at", first)
    each = F.transform("at", lambda p, k: F.struct(F.get("h", p).alias("term"), F.log((F.coalesce(F.get("at", k + 1), F.size("h")) - p).cast("double")).alias("log_weight")))
    return units.withColumn("one", F.explode_outer(each)).drop("h", "at").select("*", "one.term", "one.log_weight").drop("one")


def sampled(units: DataFrame, key: list[str]) -> DataFrame:
    """The samples of every key: one row for each block of them, with an array of 64-bit values."""
    rows = weighted(units).withColumn("block", F.explode(F.array(*[F.lit(b) for b in range(BLOCKS)])))
    least = [F.min(sample(F.col("term"), F.col("log_weight"), F.col("block") * WIDTH + i)).alias(f"m{i}") for i in range(WIDTH)]
    return rows.groupBy(*key, "block").agg(*least).select(*key, "block", F.array(*[F.coalesce(F.col(f"m{i}"), F.lit(0)).bitwiseAND(0xFFFFFFFF) for i in range(WIDTH)]).alias("m"))


def numbers(values: list[int]) -> Column:
    """A list as one constant, however long it is."""
    return F.split(F.lit(",".join(map(str, values)) or "0"), ",").cast("array<bigint>")


def lower_bound(cuts: Column, n: int, value: Column) -> Column:
    """How many of ``n`` sorted cuts are below a value, by halving: the expression does not grow with them."""
    ends = lambda lo, hi: F.struct(lo.alias("lo"), hi.alias("hi"))
    middle = lambda a: F.shiftright(a["lo"] + a["hi"], 1)
    step = lambda a, _: F.when(a["lo"] >= a["hi"], a).when(value <= F.get(cuts, middle(a)), ends(a["lo"], middle(a))).otherwise(ends(middle(a) + 1, a["hi"]))
    return F.aggregate(F.sequence(F.lit(0), F.lit(n.bit_length())), ends(F.lit(0), F.lit(n)), step, lambda a: a["lo"])


def followed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents in ranges of descending ids: (range, place, ghost, id, text, next); ghosts are the first documents of the ranges that follow."""
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("k", F.coalesce("id", F.lit(LOWEST)))
    d = d.withColumn("tie", F.bitwise_not(F.xxhash64("text")))  # ids descend and hashes ascend, so that both are compared alike
    n = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = (d.agg(F.percentile_approx("k", [i / n for i in range(1, n)], 100 * n)).first()[0] if n > 1 else []) or []
    often = Counter(cuts)
    cuts = sorted(often)
    # An id that is several cuts is that of very many rows: as many ranges of hashes hold it.
    first = list(accumulate((1 + (often[c] if often[c] > 1 else 0) for c in cuts), initial=0))
    slices = [often[c] if often[c] > 1 else 0 for c in cuts] + [0]
    unit = F.col("tie") / float(1 << 64) + 0.5
    at = lower_bound(numbers(cuts), len(cuts), F.col("k"))
    many = F.get(numbers(slices), F.col("at"))
    inside = (many > 0) & (F.col("k") == F.get(numbers(cuts), F.col("at")))
    place = F.get(numbers(first), F.col("at")) + F.when(inside, 1 + F.least(F.floor(unit * many), many - 1)).otherwise(0)
    d = d.withColumn("at", at).withColumn("range", place.cast("int")).drop("at")
    heads = {r["range"]: r["h"] for r in d.groupBy("range").agg(F.max(F.struct("k", "tie")).alias("h")).collect()}  # two numbers for each range
    used = sorted(heads)
    before = {r: used[(i + 1) % len(used)] for i, r in enumerate(used)}  # ids descend: the range before has higher ids
    look = lambda value: F.get(numbers([value(r) if r in heads else LOWEST for r in range(first[-1] + 1)]), F.col("range"))
    real, ghost = F.struct(F.col("range").cast("long").alias("range"), F.lit(0).alias("ghost")), F.struct(look(before.get).alias("range"), F.lit(1).alias("ghost"))
    is_head = (F.col("k") == look(lambda r: heads[r]["k"])) & (F.col("tie") == look(lambda r: heads[r]["tie"]))
    d = d.withColumn("to", F.explode(F.when(is_head, F.array(real, ghost)).otherwise(F.array(real))))
    order = Window.partitionBy("range").orderBy("ghost", F.desc("k"), F.desc("tie"))
    d = d.select("to.range", "to.ghost", "id", "k", "text", "tie")
    return d.select("range", F.row_number().over(order).alias("place"), "ghost", "id", "text", F.lead("text").over(order).alias("next"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for every row of ``docs``.

    The edited text has its last half replaced by the start of the next document's text.
    """
    d = followed(docs, id_col, text_col).withColumn("n_chars", F.length("text").cast("long"))
    edited = F.concat(F.expr("substring(text, 1, CAST(n_chars - n_chars div 2 AS INT))"), F.expr("substring(next, 1, CAST(n_chars div 2 AS INT))"))
    d = d.withColumn("edited", F.when(F.col("ghost") == 0, edited)).drop("next")
    d = d.withColumn("sha", F.unhex(F.sha2(F.col("edited").cast("binary"), 256)))
    units = F.array(F.struct(F.lit(0).alias("unit"), F.col("text").alias("t")), F.struct(F.lit(1).alias("unit"), F.col("edited").alias("t")))
    d = d.withColumn("u", F.explode(F.when(F.col("ghost") == 0, units).otherwise(F.slice(units, 1, 1))))
    key = ["range", "place", "ghost", "id", "n_chars", "sha", "unit"]
    m = sampled(d.withColumn("unit", F.col("u.unit")).withColumn("h", terms(F.col("u.t"))).select(*key, "h"), key)
    order = Window.partitionBy("range").orderBy("place", "unit", "block")
    ahead = [F.lead("m", i).over(order).alias(f"m_{i}") for i in range(1, 3 * BLOCKS)]
    m = m.select(*key, "block", F.col("m").alias("m_0"), *ahead).where("ghost = 0 AND unit = 0 AND block = 0")
    own, edited, after = (F.concat(*[F.col(f"m_{i}") for i in range(k * BLOCKS, (k + 1) * BLOCKS)]) for k in range(3))
    m = m.select("id", "n_chars", "sha", own.alias("own"), edited.alias("edited"), after.alias("after"))
    text = lambda c: F.array_join(F.transform(c, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")
    like = lambda a, b: reduce(lambda s, i: s + (F.get(a, F.lit(i)) == F.get(b, F.lit(i))).cast("int"), range(SAMPLES), F.lit(0)) / float(SAMPLES)
    return m.select("id", "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"), text("own").alias("fingerprint"), text("edited").alias("edited_fingerprint"), like("own", "edited").alias("near_edited"), like("own", "after").alias("near_next"))


def op3_weighted_sampling_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet")).withColumnRenamed("id", "doc_id")
