"""What to ask paid services for, under a budget: canonical keys of requests, what is cached, and the cut where a budget ends.

A key is the start of a digest of the request as JSON with sorted fields, so that two requests that say the same have
one key, whatever the order of their fields. It is built from the request's columns, in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..staging import broadcast_if_small, staged
from .ranks import running_totals

#: Hexadecimal digits of a key.
KEY_DIGITS = 24
#: What JSON writes in another way within a string (fixed values), before anything beyond ASCII.
ESCAPES = [("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f")]


def _quoted(text: Column) -> Column:
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    code = lambda ch: F.lower(F.hex(F.encode(ch, "UTF-16BE")))
    far = lambda ch: F.regexp_replace(code(ch), "(.{4})", r"\\u$1")
    ascii_only = F.array_join(F.transform(F.split(text, ""), lambda ch: F.when(ch.rlike(r"[^\x20-\x7E]"), far(ch)).otherwise(ch)), "")
    return F.concat(F.lit('"'), F.when(text.rlike(r"[^\x20-\x7E]"), ascii_only).otherwise(text), F.lit('"'))


def canonical(value: Column, kind: T.DataType) -> Column:
    """A column as JSON text: fields of structs and maps sorted by name at every depth, ", " and ": " between, nothing beyond ASCII, null for null.

    Numbers are written as SQL writes them; a real of less than a thousandth or of ten million and more would be in
    powers of ten.
    """
    if isinstance(kind, T.StructType):
        fields = sorted(kind.fields, key=lambda f: f.name)
        parts = [F.concat(_quoted(F.lit(f.name)), F.lit(": "), canonical(value.getField(f.name), f.dataType)) for f in fields]
        out = F.when(value.isNotNull(), F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}")))
    elif isinstance(kind, T.ArrayType):
        out = F.concat(F.lit("["), F.array_join(F.transform(value, lambda x: canonical(x, kind.elementType)), ", "), F.lit("]"))
    elif isinstance(kind, T.MapType):
        if not isinstance(kind.keyType, T.StringType):
            raise ValueError("only texts are names of fields")
        entries = F.transform(F.array_sort(F.map_keys(value)), lambda k: F.concat(_quoted(k), F.lit(": "), canonical(F.element_at(value, k), kind.valueType)))
        out = F.concat(F.lit("{"), F.array_join(entries, ", "), F.lit("}"))
    elif isinstance(kind, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        out = _quoted(value.cast("string"))
    else:
        out = value.cast("string")
    return F.coalesce(out, F.lit("null"))


def request_key(df: DataFrame, columns: list[str], digits: int = KEY_DIGITS) -> Column:
    """The key of the request that ``columns`` of ``df`` are the fields of."""
    kind = T.StructType([df.schema[c] for c in columns])
    return F.substring(F.sha2(canonical(F.struct(*columns), kind).cast("binary"), 256), 1, digits)


def work_list(requests: DataFrame, cached: DataFrame, budget: float, spent: float = 0.0, priority: str = "priority", cost: str | None = None) -> DataFrame:
    """(key, priority, cost, total, status) for every key of ``requests`` (key, priority, cost): ``cached`` if ``cached`` (key) has it, ``to_fetch`` while the costs so far keep within what is left of the budget, else ``budget_exhausted``.

    The highest priority goes first, nulls last, equal ones by key. Of requests with one key the highest priority and
    cost count. The sum of costs runs over ranges of the order, of which no task holds more than its share.
    """
    c = F.col(cost) if cost else F.lit(1)
    r = requests.where("key IS NOT NULL").groupBy("key").agg(F.max(priority).alias("priority"), F.max(c).cast("double").alias("cost"))
    have = broadcast_if_small(staged(cached.where("key IS NOT NULL").select("key").distinct().withColumn("_have", F.lit(True)), "cached"))
    r = staged(r.join(have, "key", "left"), "requests")
    open_ones = running_totals(r.where("_have IS NULL").drop("_have"), "cost", "priority", ties=("key",), descending=True)
    status = F.when(F.col("total") <= budget - spent, "to_fetch").otherwise("budget_exhausted")
    done = r.where("_have").select("key", "priority", "cost", F.lit(None).cast("double").alias("total"), F.lit("cached").alias("status"))
    return open_ones.select("key", "priority", "cost", "total", status.alias("status")).unionByName(done)


# ---- which places are worth a search --------------------------------------------------------------------------------


def search_targets(places: DataFrame, links: DataFrame, month: str, *, least_reviews: int, fallback: int, validation: int) -> DataFrame:
    """(place_id, purpose, name, street, street_number): the busiest places that the primary rules leave open, and a sample of primary links, ordered by a hash of place and month, so that it is the same again."""
    p = places.where((F.col("run_month") == month) & F.col("in_scope")).join(links.where(F.col("run_month") == month).select("place_id", "status", "stage"), "place_id")
    row = lambda d, purpose: d.select("place_id", F.lit(purpose).alias("purpose"), "name", "street", "street_number")
    unresolved = p.where("(status <> 'linked' OR stage = 'fallback') AND NOT self_service").where(F.coalesce("user_rating_count", F.lit(0)) >= least_reviews)
    busiest = unresolved.orderBy(F.desc_nulls_last("user_rating_count"), "place_id").limit(fallback)
    sample = p.where("status = 'linked' AND stage = 'primary'").orderBy(F.md5(F.concat("place_id", F.lit(month))), "place_id").limit(validation)
    return row(busiest, "fallback").unionByName(row(sample, "validation"))


def unsearched(targets: DataFrame, searched: DataFrame) -> DataFrame:
    """The targets whose place was not searched before; ``searched`` holds a row for each search, with or without a find."""
    return targets.join(searched.select("place_id").distinct(), "place_id", "left_anti")
