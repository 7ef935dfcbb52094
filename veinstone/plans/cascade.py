"""The linking engine on whole tables: keys, candidate joins, and a rule cascade decided per place by counts.

Places and entities meet only through equal keys, so that no step compares all with all. The entities' keys form one
long table; the rules' candidates are counted per place and rule, and one ordered choice decides. Similarity of names
is evidence only.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from ..config import CATEGORIES
from ..functions import textkeys as K
from ..staging import spread, staged
from .likeness import name_likeness, token_set_ratio

__all__ = ["candidate_table", "candidates", "company_names", "company_names_in", "decide", "entity_keys", "name_likeness", "resolve_names", "token_set_ratio", "word_counts"]

#: A single word in the names of more entities is not distinctive; more entities or places at an address make it a hotspot.
COMMON_WORD, MOST_ENTITIES, MOST_PLACES = 8, 5, 1


def entity_keys(entities: DataFrame, branches: DataFrame | None = None) -> DataFrame:
    """(kind, key, ja_kodas) of active entities (ja_kodas, legal_name, registered_address, evrk_codes, nexus, is_active) and of the names of their current branches in the city (ja_kodas, branch_name, in_vilnius, is_current)."""
    e = entities.where("is_active")
    in_city = K.in_city(F.col("registered_address"))
    pairs = F.array(
        F.struct(F.lit("exact").alias("kind"), F.when(F.col("nexus"), K.exact_key(F.col("legal_name"))).alias("key")),
        F.struct(F.lit("core").alias("kind"), F.when(F.col("nexus"), K.name_key(F.col("legal_name"))).alias("key")),
        F.struct(F.lit("address").alias("kind"), F.when(in_city, K.registry_key(F.col("registered_address"))).alias("key")),
    )
    keys = e.select("ja_kodas", F.explode(pairs).alias("p"))
    if branches is not None:
        b = branches.where("is_current AND in_vilnius").join(e.select("ja_kodas"), "ja_kodas", "left_semi")
        named = F.array(F.struct(F.lit("exact").alias("kind"), K.exact_key(F.col("branch_name")).alias("key")), F.struct(F.lit("core").alias("kind"), K.name_key(F.col("branch_name")).alias("key")))
        keys = keys.union(b.select("ja_kodas", F.explode(named).alias("p")))
    return keys.select("p.kind", "p.key", "ja_kodas").where("key <> ''").distinct()


def word_counts(entities: DataFrame) -> DataFrame:
    """(word, df): how many active entities have a word in their core name."""
    words = entities.where("is_active").select(F.explode(F.array_distinct(F.split(K.name_key(F.col("legal_name")), " "))).alias("word"))
    return words.where("word <> ''").groupBy("word").agg(F.count("*").alias("df"))


def place_keys(places: DataFrame) -> DataFrame:
    """(place_id, category, address, via, kind, key) for places (place_id, name, category, street, street_number)."""
    p = places.select("place_id", "category", K.street_key(F.col("street"), F.col("street_number")).alias("address"), K.exact_key(F.col("name")).alias("exact"), K.name_variants(F.col("name")).alias("variants"))
    core = F.transform("variants", lambda k, i: F.struct(F.when(i == 0, "core_name").otherwise("name_part").alias("via"), F.lit("core").alias("kind"), k.alias("key")))
    own = F.array(F.struct(F.lit("exact_name").alias("via"), F.lit("exact").alias("kind"), F.col("exact").alias("key")), F.struct(F.lit("address").alias("via"), F.lit("address").alias("kind"), F.col("address").alias("key")))
    return p.select("place_id", "category", "address", F.explode(F.concat(own, core)).alias("k")).select("place_id", "category", "address", "k.via", "k.kind", "k.key").where("key <> ''")


def candidates(places: DataFrame, entities: DataFrame, branches: DataFrame | None = None) -> DataFrame:
    """(place_id, via, ja_kodas, matched_key, address_agrees, code_fits): every entity that a place meets by a key."""
    keys = place_keys(places)
    about = entities.where("is_active").select("ja_kodas", "evrk_codes", F.when(K.in_city(F.col("registered_address")), K.registry_key(F.col("registered_address"))).alias("own_address"))
    found = keys.join(entity_keys(entities, branches), ["kind", "key"]).join(about, "ja_kodas")
    fits = F.exists(F.coalesce("evrk_codes", F.array().cast("array<string>")), lambda c: K.code_fits(F.col("category"), c))
    found = found.select("place_id", "via", "ja_kodas", "key", F.coalesce(F.col("address") == F.col("own_address"), F.lit(False)).alias("address_agrees"), F.coalesce(fits, F.lit(False)).alias("code_fits"))
    return found.groupBy("place_id", "via", "ja_kodas").agg(F.min("key").alias("matched_key"), F.bool_or("address_agrees").alias("address_agrees"), F.bool_or("code_fits").alias("code_fits"))


def candidate_table(month: str, places: DataFrame, entities: DataFrame, branches: DataFrame | None = None) -> DataFrame:
    """What the primary rules considered, one row per place, entity and rule, with the likeness of the names, which is evidence only, and all of it once more as JSON."""
    c = candidates(places, entities, branches).join(places.select("place_id", "name"), "place_id").join(entities.select("ja_kodas", "legal_name", F.col("nexus").alias("vilnius_nexus")), "ja_kodas")
    likeness = name_likeness(K.name_key(F.col("name")), K.name_key(F.col("legal_name")))
    out = c.select(F.lit(month).alias("run_month"), F.lit("primary").alias("stage"), "place_id", "ja_kodas", F.col("via").alias("source"), "matched_key", "address_agrees", F.col("code_fits").alias("evrk_consistent"), "vilnius_nexus", likeness.alias("name_similarity"))
    return out.withColumn("evidence", F.to_json(F.struct("ja_kodas", "source", "matched_key", "address_agrees", "evrk_consistent", "vilnius_nexus", "name_similarity")))


def key_counts(entities: DataFrame, branches: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """How many entities have each key, and the least of them: of all (kind, key, n, id), of those whose activity fits a category (kind, key, category, fit, fit_id), and of those at an address (kind, key, address, at, at_id).

    They are counted before places meet them, so a key that very many entities and places share is one row each time.
    """
    about = entities.where("is_active").select("ja_kodas", "evrk_codes", F.when(K.in_city(F.col("registered_address")), K.registry_key(F.col("registered_address"))).alias("address"))
    keyed = staged(entity_keys(entities, branches).join(about, "ja_kodas"), "entity-keys")
    ids = F.count("*"), F.min("ja_kodas")
    alone = lambda by, n, i: keyed.where(F.col(by[-1]).isNotNull()).groupBy(*by).agg(ids[0].alias(n), ids[1].alias(i))
    codes = F.coalesce("evrk_codes", F.array().cast("array<string>"))
    fits = F.filter(F.array(*[F.lit(c) for c in CATEGORIES]), lambda c: F.exists(codes, lambda code: K.code_fits(c, code)))
    by_activity = keyed.select("kind", "key", "ja_kodas", F.explode(fits).alias("category")).groupBy("kind", "key", "category").agg(ids[0].alias("fit"), ids[1].alias("fit_id"))
    return alone(("kind", "key"), "n", "id"), by_activity, alone(("kind", "key", "address"), "at", "at_id")


def decide(places: DataFrame, entities: DataFrame, branches: DataFrame | None = None) -> DataFrame:
    """(place_id, status, ja_kodas, method, confidence, reason) for every place; the first rule that has candidates decides, for names."""
    # Keys are long work per row, and a register may be one split of a file: all tasks make them.
    columns = ["ja_kodas", "legal_name", "registered_address", "evrk_codes", "nexus", "is_active"]
    entities = staged(spread(entities.where("is_active").select(*columns)), "entities")
    keys = staged(place_keys(spread(places.select("place_id", "name", "category", "street", "street_number"))), "place-keys")
    every, by_activity, by_address = key_counts(entities, branches)
    met = keys.join(every, ["kind", "key"], "left").join(by_activity, ["kind", "key", "category"], "left").join(by_address, ["kind", "key", "address"], "left")
    part = F.when(F.col("via") == "name_part", F.col("at"))
    own = lambda via: F.max(F.when(F.col("via") == via, F.col("key")))
    aggs = [own("core_name").alias("core"), own("address").alias("own_address"), F.max(part).alias("p_at_most"), F.max(F.when(part.isNotNull(), F.col("at_id"))).alias("p_addr_last")]
    for via, short in (("exact_name", "x"), ("core_name", "c"), ("name_part", "p"), ("address", "a")):
        here = F.col("via") == via
        for name, count, key in (("n", "n", "id"), ("addr", "at", "at_id"), ("fit", "fit", "fit_id")):
            aggs += [F.sum(F.when(here, F.col(count))).alias(f"{short}_{name}"), F.min(F.when(here, F.col(key))).alias(f"{short}_{name}_id")]
    d = places.select("place_id").join(met.groupBy("place_id").agg(*aggs), "place_id", "left")
    at_address = keys.where("via = 'address'").groupBy(F.col("key").alias("own_address")).agg(F.count("*").alias("at_address"))
    d = d.join(at_address, "own_address", "left").withColumn("word", F.when(~F.contains("core", F.lit(" ")), F.col("core"))).join(word_counts(entities), "word", "left")
    d = d.withColumn("distinctive", F.col("core").isNotNull() & (F.col("word").isNull() | (F.coalesce("df", F.lit(0)) <= COMMON_WORD)))
    d = d.fillna(0, ["at_address", *[f"{s}_{k}" for s in "xcpa" for k in ("n", "addr", "fit")]])
    g = F.col
    hotspot = (g("a_n") > MOST_ENTITIES) | (g("at_address") > MOST_PLACES)
    linked = lambda ja, method, confidence, reason: F.struct(F.lit("linked").alias("status"), g(ja).alias("ja_kodas"), F.lit(method).alias("method"), F.lit(confidence).alias("confidence"), F.lit(reason).alias("reason"))
    none = lambda status, reason: F.struct(F.lit(status).alias("status"), F.lit(None).cast("long").alias("ja_kodas"), F.lit(None).cast("string").alias("method"), F.lit(None).cast("string").alias("confidence"), F.lit(reason).alias("reason"))
    choice = (
        F.when((g("x_n") == 1) & ((g("x_addr") == 1) | (g("x_fit") == 1)), linked("x_n_id", "exact_name", "HIGH", "unique name, corroborated"))
        .when(g("x_n") == 1, none("ambiguous", "exact name, activity and address do not fit"))
        .when((g("x_n") > 1) & (g("x_addr") == 1), linked("x_addr_id", "exact_name+address", "HIGH", "the address singles one out"))
        .when((g("x_n") > 1) & (g("x_addr") == 0) & (g("x_fit") == 1), linked("x_fit_id", "exact_name+activity", "HIGH", "the activity singles one out"))
        .when(g("x_n") > 1, none("ambiguous", "several entities share the name"))
        .when((g("c_n") > 0) & (g("c_addr") == 1), linked("c_addr_id", "core_name+address", "HIGH", "core name and address"))
        .when((g("c_n") > 0) & (g("c_addr") > 1), none("ambiguous", "several entities of the name at the address"))
        .when((g("c_n") > 0) & ~g("distinctive"), none("ambiguous", "generic name, no address agreement"))
        .when((g("c_n") > 0) & (g("c_fit") == 1), linked("c_fit_id", "core_name+activity", "MEDIUM", "core name and activity"))
        .when(g("c_n") > 0, none("ambiguous", "several entities share the name"))
        .when((g("p_at_most") == 1) & (g("p_addr_id") == g("p_addr_last")), linked("p_addr_id", "name_part+address", "MEDIUM", "name part and address"))
        .when((g("a_fit") == 1) & ~hotspot, linked("a_fit_id", "address_only", "MEDIUM", "only fitting entity at the address"))
        .when((g("a_fit") > 0) & hotspot, none("ambiguous", "multi-tenant address"))
        .when(g("a_fit") > 1, none("ambiguous", "several fitting entities at the address"))
        .when(g("p_n") > 0, none("ambiguous", "name part without address"))
        .when(g("core").isNull(), none("unmatched", "no distinctive name"))
        .otherwise(none("unmatched", "no candidate entity"))
    )
    return d.select("place_id", choice.alias("d")).select("place_id", "d.*")


def resolve_names(names: DataFrame, entities: DataFrame) -> DataFrame:
    """(name, ja_kodas): the unique active entity of a name, or of its longest prefix that any entity has; an ambiguous prefix ends the search, and no name is cut down to one word."""
    words = F.split(K.exact_key(F.col("name")), " ")
    n = names.select("name").distinct().withColumn("w", F.filter(words, lambda w: w != ""))
    lengths = F.filter(F.sequence(F.lit(1), F.size("w")), lambda k: (k > 1) | (F.size("w") == 1))
    n = n.where(F.size("w") > 0).withColumn("k", F.explode(lengths)).withColumn("key", F.array_join(F.slice("w", F.lit(1), F.col("k")), " "))
    known = entities.where("is_active").groupBy(K.exact_key(F.col("legal_name")).alias("key")).agg(F.countDistinct("ja_kodas").alias("hits"), F.min("ja_kodas").alias("ja_kodas"))
    best = n.join(known, "key").groupBy("name").agg(F.max_by(F.struct("hits", "ja_kodas"), "k").alias("b"))
    return best.where("b.hits = 1").select("name", "b.ja_kodas")


# Legal forms in running text, words that end a name after one, and quotation marks.
FORMS = ("UAB", "MB", "IĮ", "VšĮ", "AB")
NAME_ENDS = frozenset(("siūlo", "siulo", "ieško", "iesko", "darbo", "darbą", "darba", "kviečia", "vilnius", "vilniuje", "kaunas", "pasiūlymai", "pasiulymai", "skelbimai", "prieš"))
QUOTES = "„“”\"'"
_FORM = re.compile(rf"\b(?:{'|'.join(FORMS)})\b")
_BREAK = re.compile(r"[,.;|()„“”\"\-–\n]")
#: Characters on either side of a legal form in which a name is looked for, and most words of a name without quotes.
REACH, NAME_WORDS = 64, 4


def _capital(text: str) -> str:
    """``text`` from its first capital letter or digit on."""
    at = next((i for i, ch in enumerate(text) if ch.isupper() or ch.isdigit()), len(text))
    return text[at:]


def _after_form(text: str) -> str:
    """The name at the start of what follows a legal form: in quotation marks, or up to four words that begin with a capital."""
    text = text.lstrip()
    if text[:1] and text[0] in QUOTES:
        closing = [i for i in range(1, len(text)) if text[i] in QUOTES]
        return text[1 : closing[0]] if closing else ""
    if not (text[:1].isupper() or text[:1].isdigit()):
        return ""
    words = _BREAK.split(text, maxsplit=1)[0].split()
    stop = next((i for i, w in enumerate(words) if w.strip(":").lower() in NAME_ENDS), len(words))
    return " ".join(words[: min(stop, NAME_WORDS)])


def _before_form(text: str) -> str:
    """The name at the end of what precedes a legal form, if only a comma stands between."""
    text = text.rstrip()
    if not text.endswith(","):
        return ""
    return _capital(re.split(r"[,.;|()„“\"\n]", text[:-1])[-1])


def company_names(text: str | None) -> list[str]:
    """Names of companies in a text, by what stands next to a legal form; each at least three characters long."""
    text = text or ""
    found = set()
    for form in _FORM.finditer(text):
        found.add(_after_form(text[form.end() : form.end() + REACH]).strip())
        found.add(_before_form(text[max(0, form.start() - REACH) : form.start()]).strip())
    return sorted(n for n in found if len(n) >= 3)


@F.pandas_udf(ArrayType(StringType()))
def company_names_in(texts: pd.Series) -> pd.Series:
    return texts.map(company_names)
