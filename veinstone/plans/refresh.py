"""Evidence that is rebuilt only where the replies it rests on have changed.

A digest of each place's cached replies, and of the version of the rules that read them, is kept from build to build.
What differs, is new or is gone is read again and replaced; all other rows stay as they are. The result is that of a
full rebuild, and the work that of the changes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import broadcast_if_small, staged


def digests(cache: DataFrame, key: str = "place_id", version: str = "1") -> DataFrame:
    """(key, digest): one row for each key of the cache, by all its columns and rows; the order of the rows does not matter."""
    rest = sorted(c for c in cache.columns if c != key)
    row = F.md5(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in rest]))
    return cache.groupBy(key).agg(F.md5(F.concat_ws(",", F.lit(version), F.array_sort(F.collect_list(row)))).alias("digest"))  # as many as the replies about one place


def refreshed(rows: DataFrame, cache: DataFrame, last: DataFrame, parse: Callable[[DataFrame], DataFrame], key: str = "place_id", version: str = "1") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, digests, changed): ``rows`` as ``parse`` would make them of the whole ``cache``, by parsing only what differs from the digests of the ``last`` build (key, digest).

    ``changed`` (key, change) says which keys were ``added``, ``changed`` or ``deleted``. ``parse`` takes rows of the
    cache and returns rows with the key; rows of one key must come from the cache's rows of that key alone.
    """
    now = staged(digests(cache, key, version), "digests")
    before = last.select(F.col(key), F.col("digest").alias("_was"))
    both = now.join(before, key, "full_outer").where(~F.col("digest").eqNullSafe(F.col("_was")))
    changed = staged(both.select(key, F.when(F.col("_was").isNull(), "added").when(F.col("digest").isNull(), "deleted").otherwise("changed").alias("change")), "changed")
    which = changed.select(key)
    which.staged_rows = changed.staged_rows
    which = broadcast_if_small(which)
    new = parse(cache.join(which, key, "left_semi"))
    return rows.join(which, key, "left_anti").unionByName(new, allowMissingColumns=True), now, changed
