"""Write modes: idempotent months, upserts, overrides, lineage counts, exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_month(df: DataFrame, path: str, month_col: str = "run_month") -> None:
    """Replace just the months that ``df`` has; other months and their schemas stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(month_col).parquet(path)


def with_history(new: DataFrame, old: DataFrame, month: str, month_col: str = "run_month") -> DataFrame:
    """The new month and all others of ``old``, joined by name; columns that one side lacks are null."""
    return new.unionByName(old.where(F.col(month_col) != month), allowMissingColumns=True)


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` with the rows of ``new`` in place of those with the same keys."""
    return old.join(new.select(keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def apply_overrides(links: DataFrame, overrides: DataFrame) -> DataFrame:
    """Analysts' decisions: ``set`` links with high confidence, ``reject`` leaves the place ambiguous."""
    o = overrides.select("place_id", F.col("ja_kodas").alias("_ja"), F.lower(F.trim("action")).alias("_action"), F.col("reason").alias("_reason"))
    is_set, is_reject = F.col("_action") == "set", F.col("_action") == "reject"
    out = links.join(o, "place_id", "left")
    changes = {
        "status": F.when(is_set, "linked").when(is_reject, "ambiguous").otherwise(F.col("status")),
        "ja_kodas": F.when(is_set, F.col("_ja")).when(is_reject, None).otherwise(F.col("ja_kodas")),
        "method": F.when(is_set | is_reject, "override").otherwise(F.col("method")),
        "confidence": F.when(is_set, "HIGH").when(is_reject, None).otherwise(F.col("confidence")),
        "reason": F.when(is_set | is_reject, F.concat(F.lit("analyst: "), F.col("_reason"))).otherwise(F.col("reason")),
    }
    return out.withColumns(changes).drop("_ja", "_action", "_reason")


def row_counts(fetches: DataFrame, staged: list[DataFrame]) -> DataFrame:
    """Lineage with the number of rows that each fetch staged."""
    counts = None
    for df in staged:
        one = df.groupBy("fetch_id").agg(F.count("*").alias("row_count"))
        counts = one if counts is None else counts.unionByName(one)
    counts = counts.groupBy("fetch_id").agg(F.sum("row_count").alias("row_count"))
    return fetches.drop("row_count").join(counts, "fetch_id", "left")


def latest_fetch(fetches: DataFrame, source: str) -> DataFrame:
    return fetches.where(F.col("source") == source).orderBy(F.desc("fetched_at"), F.desc("fetch_id")).limit(1)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; arrays become JSON, which CSV can hold."""
    flat = [F.to_json(c).alias(c) if t.startswith(("array", "struct", "map")) else F.col(c) for c, t in df.dtypes]
    df.select(flat).coalesce(1).write.mode("overwrite").csv(path, header=True, escape='"')


def write_export(tables: dict[str, DataFrame], folder: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/{name}.parquet")


MOST_LINES = 1000


def markdown(df: DataFrame) -> str:
    """A small result as a pipe table; reals with one decimal, nulls empty. A table of more than ``MOST_LINES`` rows is refused: a report is not an export."""
    cell = lambda v: "" if v is None else f"{v:,.1f}" if isinstance(v, float) else str(v)
    rows = df.limit(MOST_LINES + 1).collect()
    if len(rows) > MOST_LINES:
        raise ValueError(f"more than {MOST_LINES} rows")
    lines = [df.columns, ["---"] * len(df.columns), *([cell(v) for v in r] for r in rows)]
    return "\n".join("| " + " | ".join(r) + " |" for r in lines)


def replaced(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` without the groups that ``new`` has by ``keys`` (as month and stage and place), and ``new``; columns are matched by name, and either side may lack some."""
    return upsert(old, new, keys)


def appended(old: DataFrame, new: DataFrame) -> DataFrame:
    """``new`` behind ``old`` by column names; a column that ``old`` does not have is an error, one that ``new`` lacks is null."""
    if more := [c for c in new.columns if c not in old.columns]:
        raise ValueError(f"unknown columns: {', '.join(more)}")
    return old.unionByName(new, allowMissingColumns=True)


def recorded_fetch(fetches: DataFrame, artefacts: DataFrame, source: str, url: str, month: str) -> DataFrame:
    """Lineage with one row for each artefact (path, content, row_count), in place of earlier rows of the same source and path; the id is that of the content and the path."""
    new = artefacts.select(
        F.substring(F.sha2(F.concat_ws("\x1f", F.lit(source), "path", F.sha2("content", 256)), 256), 1, 16).alias("fetch_id"), F.lit(source).alias("source"), F.lit(url).alias("url"), F.current_timestamp().alias("fetched_at"),
        "path", F.sha2("content", 256).alias("sha256"), F.octet_length("content").cast("long").alias("bytes"), "row_count", F.lit(month).alias("run_month"),
    )
    return upsert(fetches, new, ["source", "path"])


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object per row; nulls are kept, so that every row has every field."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def export_month(tables: dict[str, tuple[DataFrame, str]], folder: str, month: str, leads: DataFrame) -> None:
    """Every table (name: DataFrame, scope) as zstd parquet: ``month``: rows of the month; ``leads``: rows of the month's leads; ``all``: everything. Local paths are not exported."""
    entities = leads.where(F.col("run_month") == month).select("ja_kodas").distinct()
    for name, (df, scope) in tables.items():
        part = {"month": lambda d: d.where(F.col("run_month") == month), "leads": lambda d: d.join(entities, "ja_kodas", "left_semi"), "all": lambda d: d}[scope](df)
        part.drop("path").write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/{name}.parquet")
