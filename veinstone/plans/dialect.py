"""One declarative plan, two engines: SQL templates that run on Spark and, for comparison, on DuckDB.

``$name`` is a table of the data folder; ``[[duck||spark]]`` holds what the two dialects write differently.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_TABLE = re.compile(r"\$([a-z]+)")
_CHOICE = re.compile(r"\[\[(.*?)\|\|(.*?)\]\]", re.S)


def duck(template: str) -> str:
    return _TABLE.sub(r"\1", _CHOICE.sub(lambda m: m[1], template)).strip()


def spark_sql(template: str, sf_dir: str) -> str:
    chosen = _CHOICE.sub(lambda m: m[2], template)
    return _TABLE.sub(lambda m: f"parquet.`{sf_dir}/{m[1]}.parquet`", chosen).strip()


def query(template: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: spark.sql(spark_sql(template, sf_dir))
