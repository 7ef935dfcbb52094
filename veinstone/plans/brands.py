"""Evidence about brands: search texts, codes and employers in search results, owners of trademarks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import textkeys as K
from .cascade import company_names_in, resolve_names

#: Owners of marks that are looked at for one place.
MOST_OWNERS = 3


def brand_of(name: Column) -> Column:
    """The first two words of the first part of a display name."""
    first = F.element_at(F.split(name, K.SEPARATORS), 1)
    words = F.filter(F.split(F.trim(first), r"\s+"), lambda w: w != "")
    return F.coalesce(F.nullif(F.array_join(F.slice(words, 1, 2), " "), F.lit("")), name)


def search_text(name: Column, street: Column, number: Column, again: bool = False) -> Column:
    """What to search for a company's code; ``again``: in other words, where a first search found nothing."""
    filled = F.array_compact(F.array(*[F.nullif(x, F.lit("")) for x in (name, street, number)]))
    return F.array_join(F.array_append(filled, F.lit("Vilnius UAB rekvizitai" if again else "Vilnius įmonės kodas")), " ")


def job_ad_text(brand: Column) -> Column:
    return F.concat(F.lit('"'), brand, F.lit('" Vilnius darbo skelbimas'))


def mentions(text: Column, key: Column) -> Column:
    """Whether a text has every word of a name key; no text mentions an empty key."""
    return (key != "") & F.forall(F.split(key, " "), lambda w: F.array_contains(F.split(K.fold(text), " "), w))


def search_codes(results: DataFrame) -> DataFrame:
    """(place_id, code, hits, hits_named) from organic results (place_id, name, title, desc): in how many results a code stands, and in how many of these with the place's name. A place whose results hold no code has one row without."""
    r = results.withColumn("text", F.concat_ws(" . ", "title", "desc")).withColumn("named", mentions(F.col("text"), K.name_key(F.col("name"))))
    codes = F.array_distinct(F.transform(F.filter(K.company_codes(F.col("text")), lambda c: c["code_type"] == "company"), lambda c: c["code"]))
    found = r.select("place_id", "named", F.explode(codes).alias("code")).groupBy("place_id", "code").agg(F.count("*").cast("int").alias("hits"), F.count_if("named").cast("int").alias("hits_named"))
    none = r.select("place_id").distinct().join(found.select("place_id").distinct(), "place_id", "left_anti")
    return found.unionByName(none.select("place_id", F.lit(None).cast("string").alias("code"), F.lit(0).alias("hits"), F.lit(0).alias("hits_named")))


def employers(results: DataFrame, entities: DataFrame) -> DataFrame:
    """(place_id, source, brand, company_name, ja_kodas) from job advertisements (place_id, brand, title, desc) that mention the brand: companies that resolve to an entity."""
    r = results.withColumn("text", F.concat_ws(" . ", "title", "desc")).where(mentions(F.col("text"), K.name_key(F.col("brand"))))
    named = r.select("place_id", "brand", F.explode(company_names_in("text")).alias("company_name")).distinct()
    resolved = resolve_names(named.select(F.col("company_name").alias("name")), entities).withColumnRenamed("name", "company_name")
    return named.join(resolved, "company_name").select("place_id", F.lit("job_ads").alias("source"), "brand", "company_name", "ja_kodas")


def trademark_evidence(targets: DataFrame, marks: DataFrame, owners: DataFrame, entities: DataFrame, classes: dict[str, tuple[str, ...]]) -> DataFrame:
    """(place_id, source, brand, company_name, ja_kodas) for places (place_id, name, category): owners of registered marks of the category's classes whose words all stand in the place's name.

    Marks (application_no, text, classes, status) meet places by their longest word, so a frequent word joins only
    where it is all that a mark has; ``ja_kodas`` is null for an owner that is no known entity.
    """
    words = lambda key: F.filter(F.split(key, " "), lambda w: w != "")
    p = targets.withColumn("own", words(K.name_key(F.col("name")))).where(F.size("own") > 0)
    wanted = F.lit(None).cast("array<string>")
    for category, numbers in classes.items():
        wanted = F.when(F.col("category") == category, F.array(*map(F.lit, numbers))).otherwise(wanted)
    p = p.select("place_id", "own", wanted.alias("wanted"), F.explode(F.array_distinct("own")).alias("word"))
    m = marks.where(F.col("status").startswith("Registruotas")).withColumn("mark_words", F.array_distinct(words(K.name_key(F.col("text"))))).where(F.size("mark_words") > 0)
    longest = F.element_at(F.array_sort(F.transform("mark_words", lambda w: F.struct((-F.length(w)).alias("n"), w.alias("w")))), 1)["w"]
    met = p.join(m.withColumn("word", longest), "word").where(F.arrays_overlap("classes", "wanted") & (F.size(F.array_except("mark_words", "own")) == 0))
    met = met.join(owners, "application_no").withColumn("_n", F.row_number().over(Window.partitionBy("place_id").orderBy("application_no"))).where(F.col("_n") <= MOST_OWNERS)
    resolved = resolve_names(met.select(F.col("owner_name").alias("name")), entities).withColumnRenamed("name", "owner_name")
    return met.join(resolved, "owner_name", "left").select("place_id", F.lit("trademark").alias("source"), F.col("mark").alias("brand"), F.col("owner_name").alias("company_name"), "ja_kodas")


def busy_targets(places: DataFrame, links: DataFrame, share: float, limit: int, unresolved: bool) -> DataFrame:
    """The busiest places of a month from their category's quantile ``share`` on; ``unresolved``: only those without a primary link."""
    p = places.where("in_scope")
    floor = p.groupBy("category").agg(F.percentile("user_rating_count", F.lit(share)).alias("floor"))
    d = p.where("NOT self_service").join(F.broadcast(floor), "category").where(F.col("user_rating_count") >= F.col("floor")).join(links.select("place_id", "status", "stage"), "place_id")
    if unresolved:
        d = d.where("status <> 'linked' OR stage = 'fallback'")
    return d.select("place_id", "category", "name", "street", "street_number", "user_rating_count").orderBy(F.desc("user_rating_count"), "place_id").limit(limit)


def site_places(codes: DataFrame, places: DataFrame) -> DataFrame:
    """Codes found on a site (site, page_url, code_type, code, context) for every place whose website is on it; of the same code on several pages the last page counts."""
    last = codes.groupBy("site", "code_type", "code").agg(F.max_by(F.struct("page_url", "context"), "page_url").alias("p")).select("site", "code_type", "code", "p.*")
    own = places.where(~K.skip_url(F.col("website"))).select("place_id", F.concat(F.lower(F.regexp_extract("website", r"^([A-Za-z]+)://", 1)), F.lit("://"), K.host_of(F.col("website"))).alias("site"))
    return last.join(own, "site")
