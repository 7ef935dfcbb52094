"""A paged JSON service's answers as a Spark data source: a page is a partition, and filters and columns are its own.

A page is a JSON file with its rows under ``_data``; references are nested objects and become columns like
``owner__code``. The columns of the schema alone are taken out of a row, and a row that a pushed filter refuses is not
made into one. Pages lie in a folder that the driver and all executors mount.

    register(spark)
    spark.read.format("paged_json").schema("id long, owner__code string").load(folder).where("id > 5")
"""

from __future__ import annotations

import datetime as dt
import json
import os
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual, StringStartsWith

#: What a value of a page is read as; another type of column is an error.
READ_AS = {
    T.StringType(): lambda v: v if isinstance(v, str) else json.dumps(v, ensure_ascii=False), T.LongType(): int, T.IntegerType(): int, T.DoubleType(): float, T.BooleanType(): bool,
    T.DateType(): dt.date.fromisoformat, T.TimestampType(): dt.datetime.fromisoformat,
}
TESTS = {
    EqualTo: lambda x, v: x == v, GreaterThan: lambda x, v: x > v, GreaterThanOrEqual: lambda x, v: x >= v, LessThan: lambda x, v: x < v, LessThanOrEqual: lambda x, v: x <= v,
    In: lambda x, v: x in v, StringStartsWith: lambda x, v: x.startswith(v),
}


def flat(row: dict, prefix: str = "") -> dict:
    """A row with its nested objects' fields as columns."""
    out = {}
    for name, value in row.items():
        if isinstance(value, dict):
            out |= flat(value, f"{prefix}{name}__")
        else:
            out[prefix + name] = value
    return out


class Page(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


class PagedReader(DataSourceReader):
    def __init__(self, folder: str, schema: T.StructType) -> None:
        unknown = [f.name for f in schema if f.dataType not in READ_AS]
        if unknown:
            raise ValueError(f"no such type in a page: {', '.join(unknown)}")
        self.folder, self.columns = folder, [(f.name, READ_AS[f.dataType]) for f in schema]
        self.tests: list[tuple] = []

    def pushFilters(self, filters: list) -> Iterator:
        for f in filters:
            if isinstance(f, IsNotNull) and len(f.attribute) == 1:
                self.tests.append((f.attribute[0], None, None))
            elif type(f) in TESTS and len(f.attribute) == 1:
                self.tests.append((f.attribute[0], TESTS[type(f)], f.value))
            else:
                yield f

    def partitions(self) -> list[Page]:
        return [Page(os.path.join(at, name)) for at, _, names in sorted(os.walk(self.folder)) for name in sorted(names) if not name.startswith((".", "_")) and not name.endswith(".crc")]

    def read(self, partition: Page) -> Iterator[tuple]:
        with open(partition.path, encoding="utf-8") as file:
            page = json.load(file)
        names = [name for name, _ in self.columns]
        for row in page.get("_data") or []:
            row = flat(row)
            values = [None if row.get(name) is None else read(row[name]) for name, read in self.columns]
            by_name = dict(zip(names, values, strict=True))
            if all(by_name[name] is not None and (test is None or test(by_name[name], value)) for name, test, value in self.tests):
                yield tuple(values)


class PagedJson(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        raise ValueError("name the columns by .schema(): they are the fields that are asked for")

    def reader(self, schema: T.StructType) -> PagedReader:
        return PagedReader(self.options["path"].removeprefix("file://"), schema)


def register(spark: SparkSession) -> None:
    """Make the format ``paged_json`` known to a session, and let sources in Python take filters."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PagedJson)


def write_pages(df, folder: str, rows: int = 20_000) -> None:
    """``df`` as pages of about ``rows`` rows, as the service would answer; a page is made by one task from rows it holds."""
    from pyspark.sql import functions as F

    n = max(1, -(-df.count() // rows))
    page = F.pmod(F.xxhash64(*[c for c, kind in df.dtypes if "map<" not in kind]), F.lit(n))
    pages = df.withColumn("_n", page).groupBy("_n").agg(F.collect_list(F.struct(*df.columns)).alias("_data"))
    one = F.to_json(F.struct("_data", F.struct(F.when(F.col("_n") + 1 < n, (F.col("_n") + 1).cast("string")).alias("next")).alias("_page")))
    pages.select("_n", one.alias("value")).repartition(n, "_n").write.partitionBy("_n").text(folder)
