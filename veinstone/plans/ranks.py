"""Order statistics over whole tables, without one task that holds a whole group: positions, ranks, n-tiles, percentiles.

Rows are dealt out by ranges of (group, value, ties), so a group of any size, and a value that many rows share, lie in
as many partitions as they need. Positions are counted inside partitions; a table with one row for each group in each
partition says how many rows of the group stand before it. Medians and percentiles are read off the positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import broadcast_if_small, staged


def _same(left: list[str], right: list[str]) -> Column:
    out = F.lit(True)
    for a, b in zip(left, right, strict=True):
        out = out & F.col(a).eqNullSafe(F.col(b))
    return out


def ranged(df: DataFrame, group: list[str], order: Column, ties: tuple[str, ...]) -> DataFrame:
    """``df`` with ``_part``, the range a row is dealt to; ties beyond ``ties`` are dealt by a hash of the row."""
    hashed = [c for c, kind in df.dtypes if "map<" not in kind]
    return df.repartitionByRange(*[F.col(c) for c in group], order, *[F.col(c) for c in ties], F.xxhash64(*hashed)).withColumn("_part", F.spark_partition_id())


def positions(df: DataFrame, value: str, *, within: tuple[str, ...] = (), after: tuple[str, ...] = (), ties: tuple[str, ...] = (), descending: bool = False) -> DataFrame:
    """``df`` with ``row_number`` and ``rank`` (equal values share one) from 1 in every group of ``within``, by the columns ``after``, then ``value`` (nulls last), then ``ties``; ``group_rows`` is the group's size.

    ``df`` is read twice (once for a sample that sets the ranges); what is computed at length should be staged before.
    """
    order = F.desc_nulls_last(value) if descending else F.asc_nulls_last(value)
    group = [*within, *after]
    inside = Window.partitionBy("_part", *group)
    rows = ranged(df, group, order, ties).withColumns({"_row": F.row_number().over(inside.orderBy(order, *ties)), "_rank": F.rank().over(inside.orderBy(order))})
    rows = staged(rows, "positions")
    ends = rows.groupBy("_part", *group).agg(F.count("*").alias("_n"), F.min_by(F.struct(value), "_row").alias("_first"), F.max_by(F.struct(value, "_rank"), "_row").alias("_last"))
    whole = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))  # a row for each group in each partition
    ends = ends.withColumn("_before", F.sum("_n").over(whole.orderBy(*after, "_part")) - F.col("_n")).withColumn("group_rows", F.sum("_n").over(whole))
    # A value that ends one partition may go on in the next: its rank is where it begins.
    each = F.array(F.struct(F.col(f"_first.{value}").alias("v"), (F.col("_before") + 1).alias("at")), F.struct(F.col(f"_last.{value}").alias("v"), (F.col("_before") + F.col("_last._rank")).alias("at")))
    own = Window.partitionBy(*group, "_e.v")
    ends = ends.withColumn("_e", F.explode(each)).withColumn("_begin", F.min("_e.at").over(own)).where(F.col("_e.v").eqNullSafe(F.col(f"_first.{value}")))
    key = ["_part", *group]
    ends = ends.groupBy(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(key)]).agg(F.first("_before").alias("_before"), F.first("group_rows").alias("group_rows"), F.first("_first").alias("_first"), F.min("_begin").alias("_begin"))
    out = rows.join(broadcast_if_small(staged(ends, "ends")), _same(key, [f"_k{i}" for i in range(len(key))]))
    begun = F.struct(value).eqNullSafe(F.col("_first"))
    out = out.withColumn("row_number", F.col("_before") + F.col("_row")).withColumn("rank", F.when(begun, F.col("_begin")).otherwise(F.col("_before") + F.col("_rank")))
    return out.select(*df.columns, "row_number", "rank", "group_rows")


def ntile(row_number: Column, rows: Column, n: int) -> Column:
    """Which of ``n`` nearly equal parts a row is in; the first parts are the larger ones."""
    size, more = F.floor(rows / n), rows % n
    large = more * (size + 1)
    return F.when(row_number <= large, F.floor((row_number - 1) / (size + 1))).otherwise(more + F.floor((row_number - 1 - large) / F.greatest(size, F.lit(1)))) + 1


def percentiles(ranked: DataFrame, value: str, within: tuple[str, ...], shares: dict[str, float]) -> DataFrame:
    """One row per group of ``positions``, with a column for each of ``shares``: its percentile, between two values in proportion. ``value`` has no nulls there."""
    at = {name: (F.col("group_rows") - 1) * F.lit(p) for name, p in shares.items()}
    low, high = ({name: f(x).cast("long") + 1 for name, x in at.items()} for f in (F.floor, F.ceil))
    row, v = F.col("row_number"), F.col(value).cast("double")
    there = F.lit(False)
    for name in shares:
        there = there | (row == low[name]) | (row == high[name])
    out = ranked.where(there).groupBy(*within).agg(*[F.struct(F.max(F.when(row == low[n], v)).alias("a"), F.max(F.when(row == high[n], v)).alias("b"), F.max(x - F.floor(x)).alias("f")).alias(n) for n, x in at.items()])
    return out.select(*within, *[(F.col(f"{n}.a") + (F.col(f"{n}.b") - F.col(f"{n}.a")) * F.col(f"{n}.f")).alias(n) for n in shares])


def medians(df: DataFrame, value: str, within: tuple[str, ...], name: str = "median") -> DataFrame:
    """(within..., median) of the values that are not null."""
    return percentiles(positions(df.where(F.col(value).isNotNull()), value, within=within), value, within, {name: 0.5})


def at_levels(df: DataFrame, levels: list[tuple[str, ...]]) -> DataFrame:
    """Every row once for each of ``levels``, groupings from the narrowest to the widest: ``lvl`` counts down to 1, and a key that a level does not have is null."""
    keys = list(dict.fromkeys(k for level in levels for k in level))
    rows = [F.struct(F.lit(len(levels) - i).alias("lvl"), *[F.when(F.lit(k in level), F.col(k)).alias(k) for k in keys]) for i, level in enumerate(levels)]
    rest = [c for c in df.columns if c not in keys]
    return df.select(*rest, F.explode(F.array(*rows)).alias("_l")).select("_l.*", *rest)


def level_medians(df: DataFrame, levels: list[tuple[str, ...]], values: dict[str, str], *aggregates: Column, least: int = 1) -> DataFrame:
    """(lvl, keys, n, medians, aggregates) of every group of ``levels`` with at least ``least`` rows; ``values`` names the columns by their medians' names."""
    rows = at_levels(df, levels)
    key = ["lvl", *dict.fromkeys(k for level in levels for k in level)]
    groups = rows.groupBy(*key).agg(F.count("*").alias("n"), *aggregates).where(F.col("n") >= least)
    long = rows.select(*key, F.explode(F.array(*[F.struct(F.lit(name).alias("of"), F.col(c).cast("double").alias("value")) for name, c in values.items()])).alias("_v")).select(*key, "_v.*")
    found = medians(long, "value", (*key, "of")).groupBy(*[F.col(k).alias(f"_{k}") for k in key]).agg(*[F.max(F.when(F.col("of") == name, F.col("median"))).alias(name) for name in values])
    return groups.join(found, _same(key, [f"_{k}" for k in key]), "left").drop(*[f"_{k}" for k in key])


def running_totals(df: DataFrame, amount: str, value: str, *, ties: tuple[str, ...] = (), descending: bool = False) -> DataFrame:
    """``df`` with ``total``, the sum of ``amount`` up to and with each row in the order of ``value`` (nulls last), then ``ties``."""
    order = F.desc_nulls_last(value) if descending else F.asc_nulls_last(value)
    inside = Window.partitionBy("_part").orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, 0)
    rows = staged(ranged(df, [], order, ties).withColumn("_sum", F.sum(F.coalesce(amount, F.lit(0))).over(inside)), "sums")
    parts = rows.groupBy("_part").agg(F.sum(F.coalesce(amount, F.lit(0))).alias("_n"))
    parts = parts.withColumn("_before", F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_part")) - F.col("_n")).select(F.col("_part").alias("_p"), "_before")  # a row for each partition
    return rows.join(broadcast_if_small(staged(parts, "parts")), F.col("_part") == F.col("_p")).withColumn("total", F.col("_before") + F.col("_sum")).select(*df.columns, "total")
