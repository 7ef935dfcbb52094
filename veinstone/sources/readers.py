"""Typed readers of the raw formats, with drift checks and lineage; every reader takes any path that Spark can read."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REGISTER_COLUMNS = "ja_kodas ja_pavadinimas adresas ja_reg_data form_kodas form_pavadinimas stat_kodas stat_pavadinimas stat_data_nuo".split()


class SchemaDrift(ValueError):
    """A required column is missing."""


def required(df: DataFrame, columns: list[str]) -> DataFrame:
    if missing := [c for c in columns if c not in df.columns]:
        raise SchemaDrift(f"missing columns: {', '.join(missing)}")
    return df


def tried(column: str, kind: str) -> Column:
    """A cast that gives null for bad values."""
    return F.expr(f"try_cast(`{column}` AS {kind})")


def read_register(spark: SparkSession, path: str, fetch_id: str) -> DataFrame:
    """Pipe-separated register, all text; rows whose key is no number are dropped."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in REGISTER_COLUMNS])
    raw = spark.read.csv(path, schema=schema, sep="|", quote='"', escape='"', header=True, mode="PERMISSIVE", enforceSchema=True)
    return raw.where(tried("ja_kodas", "bigint").isNotNull()).select(
        tried("ja_kodas", "bigint").alias("ja_kodas"), F.trim("ja_pavadinimas").alias("legal_name"), F.col("adresas").alias("registered_address"), tried("ja_reg_data", "date").alias("registered_on"),
        tried("form_kodas", "int").alias("legal_form_code"), F.col("form_pavadinimas").alias("legal_form"), tried("stat_kodas", "int").alias("status_code"), F.col("stat_pavadinimas").alias("status"),
        tried("stat_data_nuo", "date").alias("status_since"), F.lit(fetch_id).alias("fetch_id"),
    )


def read_payroll(spark: SparkSession, paths: list[str], fetch_id: str) -> DataFrame:
    """Yearly files whose columns drift: the name in a header cell's last parentheses is the column's; unknown columns are dropped, missing ones null."""
    out = None
    for path in paths:
        head = spark.read.text(path).first()[0].lstrip("﻿")
        names = [m[1] if (m := re.search(r"\(([^()]+)\)\s*\"?$", cell.strip())) else cell.strip() for cell in head.split(";")]
        one = spark.read.csv(path, schema=T.StructType([T.StructField(n, T.StringType()) for n in names]), sep=";", header=True, enforceSchema=True)
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    required(out, ["jarCode", "month", "numInsured"])
    for c in ("code", "name", "municipality", "ecoActCode", "ecoActCodeStr", "ecoActName", "avgWage", "numInsured2", "tax"):
        out = out if c in out.columns else out.withColumn(c, F.lit(None).cast("string"))
    ym = tried("month", "int")
    dotted = F.coalesce("ecoActCodeStr", F.regexp_replace("ecoActCode", r"^(\d\d)(\d\d)(\d\d)$", "$1.$2.$3"))
    return out.where(tried("jarCode", "bigint").isNotNull()).select(
        tried("jarCode", "bigint").alias("ja_kodas"), F.col("code").alias("sodra_code"), F.trim("name").alias("name"), "municipality", dotted.alias("evrk"), F.col("ecoActName").alias("evrk_name"),
        F.make_date((ym / 100).cast("int"), ym % 100, F.lit(1)).alias("month"), tried("avgWage", "double").alias("avg_wage"), tried("numInsured", "int").alias("num_insured"),
        tried("numInsured2", "int").alias("num_insured_other"), tried("tax", "double").alias("contributions"), F.lit(fetch_id).alias("fetch_id"),
    )


def read_taxes(spark: SparkSession, path: str, fetch_id: str) -> DataFrame:
    raw = spark.read.json(path, schema="mm_kodas__ja_kodas string, tipas string, metai string, menuo string, suma string, atnaujinta string")
    return raw.select(
        tried("mm_kodas__ja_kodas", "bigint").alias("ja_kodas"), F.col("tipas").alias("legal_form"), tried("metai", "int").alias("year"), tried("menuo", "int").alias("through_month"),
        tried("suma", "double").alias("taxes_paid"), tried("atnaujinta", "date").alias("updated_on"), F.lit(fetch_id).alias("fetch_id"),
    ).where("ja_kodas IS NOT NULL")


def read_revenue(spark: SparkSession, path: str, fetch_id: str) -> DataFrame:
    """Revenue statements without exact duplicates."""
    raw = spark.read.json(path, schema="juridinis_asmuo__ja_kodas string, reiksme string, laikotarpis_nuo string, laikotarpis_iki string, reg_date string, template_id string")
    return raw.select(
        tried("juridinis_asmuo__ja_kodas", "bigint").alias("ja_kodas"), tried("laikotarpis_nuo", "date").alias("period_from"), tried("laikotarpis_iki", "date").alias("period_to"),
        F.year(tried("laikotarpis_iki", "date")).alias("fiscal_year"), tried("reiksme", "double").alias("revenue"), tried("reg_date", "date").alias("filed_on"), F.lit(fetch_id).alias("fetch_id"),
    ).distinct()


def read_csv_union(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Files with differing columns, all text, quoted free text over several lines; joined by name."""
    out = None
    for path in paths:
        one = spark.read.csv(path, header=True, quote='"', escape='"', multiLine=True)
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def flattened(df: DataFrame, prefix: str = "") -> list[Column]:
    """Columns of nested structs as ``a__b``; names that begin with _ are dropped, but for _id."""

    def walk(schema: T.StructType, path: str, name: str) -> list[Column]:
        out = []
        for f in schema.fields:
            if f.name.startswith("_") and f.name != "_id":
                continue
            here = f"{path}.`{f.name}`" if path else f"`{f.name}`"
            full = f"{name}__{f.name}" if name else f.name
            out += walk(f.dataType, here, full) if isinstance(f.dataType, T.StructType) else [F.col(here).alias(full)]
        return out

    return walk(df.schema, "", prefix)


def read_snapshots(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """All months of a table that lies in one folder per month."""
    return spark.read.option("mergeSchema", "true").parquet(f"{folder}/*/{table}.parquet")


def first_seen(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of every key by ``order``, without a sort: the least struct."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("r")).select(key, "r.*")


LISTING = """id string, displayName struct<text:string>, addressComponents array<struct<longText:string, types:array<string>>>, location struct<latitude:double, longitude:double>, types array<string>, primaryType string,
businessStatus string, rating double, userRatingCount int, regularOpeningHours struct<periods:array<struct<open:struct<day:int,hour:int,minute:int>, close:struct<day:int,hour:int,minute:int>>>>,
priceRange struct<startPrice:struct<units:string,nanos:bigint>, endPrice:struct<units:string,nanos:bigint>>, websiteUri string, nationalPhoneNumber string, googleMapsUri string"""


def parse_listings(raw: DataFrame, column: str = "payload") -> DataFrame:
    """Nested listing payloads (JSON text) to flat columns."""
    from ..functions.textkeys import category_of_type, weekly_open_hours

    p = raw.withColumn("p", F.from_json(column, LISTING)).select("p.*")
    part = lambda kind: F.try_element_at(F.filter("addressComponents", lambda c: F.array_contains(c["types"], kind)), F.lit(1))["longText"]
    price = lambda c: F.expr(f"try_cast(priceRange.{c}.units AS double)") + F.coalesce(F.col(f"priceRange.{c}.nanos"), F.lit(0)) / 1e9
    return p.select(
        F.col("id").alias("place_id"), F.col("displayName.text").alias("name"), F.col("primaryType").alias("primary_type"), category_of_type(F.col("primaryType")).alias("category"), "types",
        part("route").alias("street"), part("street_number").alias("street_number"), part("locality").alias("locality"), part("postal_code").alias("postal_code"), F.col("location.latitude").alias("lat"),
        F.col("location.longitude").alias("lng"), F.col("businessStatus").alias("business_status"), "rating", F.col("userRatingCount").alias("user_rating_count"),
        weekly_open_hours(F.col("regularOpeningHours.periods")).alias("weekly_open_hours"), price("startPrice").alias("price_from"), price("endPrice").alias("price_to"),
        F.col("websiteUri").alias("website"), F.col("nationalPhoneNumber").alias("phone"), F.col("googleMapsUri").alias("maps_uri"),
    )


def search_results(raw: DataFrame, column: str = "payload") -> DataFrame:
    """One row (title, desc) per organic result of search payloads; anything that is no object is passed over."""
    schema = "results array<struct<content:struct<results:struct<organic:array<struct<title:string,desc:string>>>>>>"
    p = raw.withColumn("p", F.from_json(column, schema)).withColumn("r", F.explode_outer("p.results")).withColumn("o", F.explode("r.content.results.organic"))
    return p.drop("p", "r").select("*", "o.title", "o.desc").drop("o")


def zipped_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value): the lines of the first member of every zip archive that ``path`` names, without a byte order mark; an archive is read in one task, in chunks."""
    import io
    import zipfile

    import pyarrow as pa

    def lines(batches):
        for batch in batches:
            for content in batch.column("content").to_pylist():
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    names = archive.namelist()
                    if not names:
                        continue
                    with io.TextIOWrapper(archive.open(names[0]), "utf-8-sig") as text:
                        while some := text.readlines(1 << 20):
                            yield pa.RecordBatch.from_arrays([pa.array([x.rstrip("\r\n") for x in some], pa.string())], names=["value"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(lines, "value string")


# Fields of the taxpayer register and what they are called here.
TAXPAYER_FIELDS = {
    "ja_kodas": ("ja_kodas", "bigint"), "pavadinimas": ("name", "string"), "isreg_data": ("deregistered_on", "date"), "tipo_kodas": ("taxpayer_type", "int"), "pvm_kodas": ("vat_code", "string"),
    "pvm_iregistruota": ("vat_registered_on", "date"), "pvm_isregistruota": ("vat_deregistered_on", "date"), "padalinio_nr": ("branch_no", "int"), "padalinio_pvd": ("branch_name", "string"),
    "padalinio_savivaldybe": ("branch_municipality", "int"), "ekonomine_veikla__kodas": ("activity_code", "string"), "veiklos_pradzia": ("activity_from", "date"), "veiklos_pabaiga": ("activity_to", "date"),
    "pagrindine": ("is_main_activity", "int"), "vv_savivaldybe": ("seat_municipality", "int"),
}
# The cells of a row of the premises register, in their order.
PREMISES_CELLS = ("row_no", "ja_kodas", "operator_name", "trade_name", "main_activity", "other_activities", "assortment", "address", "issuer", "issued_on", "certificate_no", "risk_group")


def read_taxpayers(spark: SparkSession, path: str, fetch_id: str) -> DataFrame:
    """The taxpayer register: all fields are read as text and cast; rows without a key are dropped."""
    raw = spark.read.json(path, schema=T.StructType([T.StructField(c, T.StringType()) for c in TAXPAYER_FIELDS]))
    cols = [tried(c, kind).alias(name) for c, (name, kind) in TAXPAYER_FIELDS.items()]
    return raw.select(*cols, F.lit(fetch_id).alias("fetch_id")).where("ja_kodas IS NOT NULL").withColumn("is_main_activity", F.col("is_main_activity") == 1)


def read_premises(spark: SparkSession, path: str, fetch_id: str) -> DataFrame:
    """Food premises without exact duplicates."""
    raw = spark.read.json(path, schema=T.StructType([T.StructField(c, T.StringType()) for c in PREMISES_CELLS]))
    text = ["operator_name", "trade_name", "main_activity", "other_activities", "address"]
    return raw.select(tried("ja_kodas", "bigint").alias("ja_kodas"), *text, tried("issued_on", "date").alias("issued_on"), "certificate_no", F.lit(fetch_id).alias("fetch_id")).distinct()


def read_website_codes(spark: SparkSession, path: str, month: str) -> DataFrame:
    """Codes found on websites; a row without a site has that of its host."""
    names = ("place_id", "site", "host", "page_url", "code_type", "code", "context", "fetched_at")
    raw = spark.read.json(path, schema=T.StructType([T.StructField(c, T.StringType()) for c in names]))
    site = F.coalesce("site", F.concat(F.lit("https://"), "host"))
    return raw.select(F.lit(month).alias("run_month"), "place_id", site.alias("site"), "page_url", "code_type", "code", "context", tried("fetched_at", "timestamp").alias("fetched_at"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A sweep's manifest, one JSON object per cell."""
    return spark.read.json(path, schema="lat double, lng double, radius_m double, depth int, request_hash string, n_results int, status string")


def read_overrides(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Analysts' decisions from files whose columns may differ; an empty date is no date."""
    raw = read_csv_union(spark, paths)
    return raw.select("place_id", tried("ja_kodas", "bigint").alias("ja_kodas"), F.lower(F.trim("action")).alias("action"), "reason", "analyst", tried("decided_on", "date").alias("decided_on"))


def without_seen(df: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys a table that was read before does not have."""
    return df.join(done.select(keys).distinct(), keys, "left_anti")


def table_if_there(spark: SparkSession, name: str) -> DataFrame | None:
    """A table or view of the session, or None: sources that were never fetched are no error."""
    return spark.table(name) if spark.catalog.tableExists(name) else None


def table_rows(pages: DataFrame, columns: tuple[str, ...], nth: int = 2, html_col: str = "html") -> DataFrame:
    """The rows of the ``nth`` table of every page, behind its first one, as named columns; rows with another number of cells are passed over."""
    body = F.try_element_at(F.regexp_extract_all(html_col, F.lit(r"(?is)<table\b[^>]*>(.*?)</table>"), F.lit(1)), F.lit(nth))
    rows = F.slice(F.regexp_extract_all(body, F.lit(r"(?is)<tr\b[^>]*>(.*?)(?=<tr\b|</tr>|\z)"), F.lit(1)), 2, 1 << 30)
    cells = F.transform(F.regexp_extract_all("row", F.lit(r"(?is)<td\b[^>]*>(.*?)(?=<td\b|</td>|\z)"), F.lit(1)), plain_text)
    out = pages.withColumn("row", F.explode(rows)).withColumn("cells", cells).where(F.size("cells") == len(columns))
    return out.select(*[c for c in pages.columns if c != html_col], *[F.get("cells", F.lit(i)).alias(c) for i, c in enumerate(columns)])


def plain_text(markup: Column) -> Column:
    """Markup without tags, with the commonest character references decoded and white space trimmed."""
    text = F.regexp_replace(markup, "<[^>]*>", "")
    for name, char in (("&nbsp;", " "), ("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(char))
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def trademark_rows(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(application_no, text, classes, status) from search pages of the trademark register: rows with a link to details and nine cells or more."""
    rows = F.regexp_extract_all(html_col, F.lit(r"(?is)<tr\b[^>]*>(.*?)(?=<tr\b|</tr>|\z)"), F.lit(1))
    cells = F.transform(F.regexp_extract_all("row", F.lit(r"(?is)<td\b[^>]*>(.*?)(?=<td\b|</td>|\z)"), F.lit(1)), plain_text)
    out = pages.withColumn("row", F.explode(rows)).withColumn("cells", cells).where(F.col("row").contains("/trademark/details/") & (F.size("cells") >= 9))
    classes = F.filter(F.transform(F.split(F.get("cells", F.lit(6)), ","), lambda c: F.trim(c)), lambda c: c != "")
    at = lambda i: F.get("cells", F.lit(i))
    return out.select(*[c for c in pages.columns if c != html_col], at(3).alias("application_no"), at(1).alias("text"), F.array_distinct(classes).alias("classes"), at(8).alias("status"))


def trademark_owners(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(mark, owner_name, owner_address) from detail pages: the line behind (540), and the first block behind (730), (731) or (732) that has a name."""
    broken = F.regexp_replace(html_col, r"(?is)<(script|style)\b.*?</\1>|<[^>]*>", "\n")
    lines = F.filter(F.transform(F.split(broken, "\n"), plain_text), lambda x: x != "")
    d = pages.withColumn("lines", lines)
    behind = lambda i, k: F.get("lines", i + k)
    blocks = F.transform("lines", lambda x, i: F.when(x.rlike(r"^\(73[0-2]\)$") & behind(i, 1).startswith("Pavadinimas") & behind(i, 2).isNotNull(), F.struct(behind(i, 2).alias("name"), F.when(behind(i, 3).startswith("Adresas"), behind(i, 4)).alias("address"))))
    marks = F.transform("lines", lambda x, i: F.when(x == "(540)", behind(i, 1)))
    d = d.withColumn("owner", F.try_element_at(F.array_compact(blocks), F.lit(1))).where("owner IS NOT NULL")
    return d.select(*[c for c in pages.columns if c != html_col], F.coalesce(F.try_element_at(F.array_compact(marks), F.lit(1)), F.lit("")).alias("mark"), F.col("owner.name").alias("owner_name"), F.coalesce("owner.address", F.lit("")).alias("owner_address"))


def blocked(content: Column, content_type: Column, expected: Column, markers: tuple[str, ...] = ("Request Rejected", "Access Denied", "captcha")) -> Column:
    """Whether a response that should be data (json, csv or zip) is a page that refuses it; nothing is refused where nothing is expected."""
    head = F.decode(F.substring(content, 1, 4096), "ISO-8859-1")
    marked = F.exists(F.array(*map(F.lit, markers)), lambda m: F.contains(F.lower(head), F.lower(m)))
    is_page = F.contains(F.coalesce(content_type, F.lit("")), F.lit("text/html")) | F.ltrim(F.lower(head)).rlike("^(<!doctype html|<html)")
    return F.coalesce(expected.isNotNull() & (marked | expected.isin("json", "csv", "zip") & is_page), F.lit(False))
