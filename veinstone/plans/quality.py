"""Data-quality checks as specifications, and one gate for check and export: an unknown value fails."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    name: str
    severity: str
    table: str
    value: str  # an aggregate expression over the table
    op: str
    threshold: float
    unit: str = "rows"


def run_checks(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """One row per check; all checks of a table come from one aggregate pass over it."""
    out = None
    for table in dict.fromkeys(c.table for c in checks):
        own = [c for c in checks if c.table == table]
        values = tables[table].agg(*[F.expr(c.value).cast("double").alias(c.name) for c in own])
        rows = F.explode(F.array(*[F.struct(F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"), F.col(c.name).alias("value"), F.lit(c.op).alias("op"), F.lit(float(c.threshold)).alias("threshold"), F.lit(c.unit).alias("unit")) for c in own]))
        one = values.select(rows.alias("r")).select("r.*")
        out = one if out is None else out.unionByName(one)
    passed = F.when(F.col("op") == ">=", F.col("value") >= F.col("threshold")).when(F.col("op") == "<=", F.col("value") <= F.col("threshold")).otherwise(F.col("value") == F.col("threshold"))
    return out.withColumn("passed", F.coalesce(passed, F.lit(False)))


def gate(results: DataFrame) -> list[str]:
    """Names of failed checks of severity error; an export goes on only if there are none."""
    return [r["check_name"] for r in results.where("severity = 'error' AND NOT passed").orderBy("check_name").collect()]
