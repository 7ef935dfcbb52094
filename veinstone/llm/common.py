"""What the operators of this subpackage share: words, connected components, and the staging of the engine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import BROADCAST_ROWS, broadcast_if_small, released, released_since, renamed, shared_dir, staged, staged_now

__all__ = ["BROADCAST_ROWS", "SPACE", "WORD", "broadcast_if_small", "components", "indexed", "released", "released_since", "renamed", "shared_dir", "staged", "staged_now"]

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def components(edges: DataFrame, name: str = "components", rows: int = BROADCAST_ROWS) -> DataFrame:
    """Connected components of ``edges`` (a, b): one row (id, component) for each id but the smallest of each component.

    The smallest id names the component. In every round each id finds its least neighbour m, its other smaller
    neighbours are tied to m, and every edge is moved on to the least neighbour of its lower end; so paths halve. The
    rounds end when every edge leads to an id without smaller neighbours.

    A hub's edges are not gathered in one task: minima are aggregated before the shuffle, one row for each id, and
    written; then they are broadcast or joined as a plain shuffle, of which adaptive execution splits a skewed key.
    """
    now = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    while True:
        low = staged(now.groupBy("u").agg(F.min("v").alias("m")), name)
        tie = lambda a, is_open: F.struct(F.col(a).alias("a"), F.col("m").alias("b"), F.lit(is_open).alias("open"))
        tied = now.join(broadcast_if_small(low, rows), "u").select(F.explode(F.array(tie("u", False), tie("v", True))).alias("e")).select("e.*").where("a <> b")
        moved = tied.join(broadcast_if_small(renamed(low, b="u", lower="m"), rows), "b", "left")
        after = staged(moved.groupBy(F.col("a").alias("u"), F.coalesce("lower", "b").alias("v")).agg(F.bool_or(F.col("open") | F.col("lower").isNotNull()).alias("open")), name)
        released(now, low)
        now = after
        if now.where("open").isEmpty():
            return renamed(now, id="u", component="v")


def indexed(df: DataFrame, order: list, name: str) -> DataFrame:
    """``df`` sorted by ``order`` with a gapless ``index`` from 0; only one row count per partition reaches the driver."""
    out = staged(df.orderBy(*order).withColumn("_m", F.monotonically_increasing_id()), name)
    counts = out.groupBy(F.shiftright("_m", 33).alias("p")).count().orderBy("p").collect()
    at, offsets = 0, []
    for row in counts:
        offsets.append((row["p"], at))
        at += row["count"]
    if not offsets:
        return out.withColumn("index", F.col("_m")).drop("_m")
    first = df.sparkSession.createDataFrame(offsets, "_p long, _at long")
    return out.withColumn("_p", F.shiftright("_m", 33)).join(F.broadcast(first), "_p").withColumn("index", F.col("_at") + F.col("_m").bitwiseAND((1 << 33) - 1)).drop("_m", "_p", "_at")
