"""The engine's models on tables of the survey's schema: link validation, fallback links, entity activity, leads.

Every model is one function from DataFrames to a DataFrame; keys are place_id, ja_kodas and run_month. Years and
months are those of the data, not of the calendar: the current tax year is the last one that any row has.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import POLICY_WORDS, Thresholds
from ..functions import textkeys as K
from ..staging import broadcast_if_small, counted, dealt, spread, staged
from .likeness import likely, profile
from .ranks import level_medians, ntile, percentiles, positions

BRAND = ("trademark", "job_ads")


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


# ---- link validation ------------------------------------------------------------------------------------------------


def domain(url: Column) -> Column:
    """The host of a web address without www; null without one."""
    return F.nullif(F.regexp_replace(K.host_of(url), r"^www\.", ""), F.lit(""))


def chain_domains(places: DataFrame) -> DataFrame:
    """(domain): sites that stand for three addresses or more, so they are a brand's and not a venue's."""
    address = F.lower(F.concat(F.coalesce("street", F.lit("")), F.col("street_number")))
    sites = places.where("in_scope").select(domain(F.col("website")).alias("domain"), address.alias("address")).where("domain IS NOT NULL")
    return sites.groupBy("domain").agg(F.countDistinct("address").alias("n")).where("n >= 3").select("domain")


def families(method: Column) -> Column:
    """The independent kinds of evidence behind a fallback method: trademark and job ads are one, an earlier candidate is none."""
    sources = F.split(F.regexp_replace(method, "^fallback:", ""), r"\+")
    known = F.filter(sources, lambda s: (s != "primary_candidate") & (s != ""))
    return F.array_distinct(F.transform(known, lambda s: F.when(s.isin(*BRAND), "brand").otherwise(s)))


def validated_links(month: str, links: DataFrame, places: DataFrame, entities: DataFrame, candidates: DataFrame, agreement: DataFrame, audits: DataFrame) -> DataFrame:
    """One row per linked place of the month: plausibility, agreement of sources, audit, change since the last month, status, and whether the link may feed leads."""
    now = links.where((F.col("run_month") == month) & (F.col("status") == "linked"))
    here = places.where(F.col("run_month") == month)
    link = now.join(here.select("place_id", "category", "website"), "place_id").withColumn("domain", domain(F.col("website")))
    why = candidates.where(F.col("run_month") == month).groupBy("place_id", "ja_kodas").agg(
        F.bool_or("evrk_consistent").alias("fits"), F.bool_or("address_agrees").alias("agrees"), F.max("name_similarity").alias("name_similarity"), F.min("matched_key").alias("matched_key")
    )
    spread = link.groupBy("ja_kodas").agg(F.count("*").alias("n"), F.countDistinct("category").alias("kinds"), F.countDistinct("domain").alias("sites"))
    spread = spread.select("ja_kodas", ((F.col("n") > 3) & (F.col("kinds") > 1) & (F.col("sites") > 1)).alias("implausible_spread"))
    is_brand, verdict = F.col("source").isin(*BRAND), F.col("verdict")
    said = agreement.where(F.col("run_month") == month).groupBy("place_id").agg(
        F.count_if((verdict == "confirms") & ~is_brand).alias("confirming"), F.count_if((verdict == "conflicts") & ~is_brand).alias("conflicting"), F.count_if((verdict == "confirms") & is_brand).alias("brand"),
        F.array_join(F.sort_array(F.collect_list(F.concat_ws(":", "source", "verdict"))), ", ").alias("agreement_detail"),
    )
    earlier = links.where(F.col("run_month") < month)
    last = earlier.where(F.col("run_month") == earlier.agg(F.max("run_month")).scalar()).where("status = 'linked'").select("place_id", F.col("ja_kodas").alias("prev_ja_kodas"))
    audit = audits.groupBy("place_id", "ja_kodas").agg(F.max_by("verdict", "audited_on").alias("audit_verdict"))
    d = link.join(entities.select("ja_kodas", "is_active", "vilnius_nexus"), "ja_kodas").join(why, ["place_id", "ja_kodas"], "left").join(spread, "ja_kodas", "left").join(said, "place_id", "left")
    d = d.join(last, "place_id", "left").join(audit, ["place_id", "ja_kodas"], "left").join(chain_domains(here).withColumn("chain", F.lit(True)), "domain", "left")

    confirming, conflicting = F.coalesce("confirming", F.lit(0)), F.coalesce("conflicting", F.lit(0))
    kinds, fallback = families(F.col("method")), F.col("stage") == "fallback"
    only = lambda kind: _flag((F.size(kinds) == 1) & (kinds[0] == kind))
    status = (
        F.when((F.col("stage") == "override") | _flag(F.col("audit_verdict") == "correct"), "confirmed_by_audit")
        .when(F.col("audit_verdict") == "wrong", "rejected_by_audit")
        .when(confirming > 0, "confirmed")
        .when(conflicting > 0, "conflict")
        .when(~fallback, "unverified")
        .when(F.size(kinds) >= 2, "confirmed")
        .when(only("brand"), "brand_level_only")
        .when(only("website") & F.col("chain"), "brand_site_code")
        .otherwise("single_source")
    )
    d = d.withColumns({"validation_status": status, "activity_fits": _flag(F.col("fits")), "address_agrees": _flag(F.col("agrees"))})
    settled = F.col("validation_status").isin("confirmed", "confirmed_by_audit")
    strong = (F.col("confidence") == "HIGH") & (F.col("activity_fits") | F.col("address_agrees"))
    published = (F.col("validation_status") == "single_source") & F.col("activity_fits") & F.col("method").rlike("website|vmvt")
    usable = F.col("is_active") & ~F.col("validation_status").isin("conflict", "rejected_by_audit") & ~_flag(F.col("implausible_spread")) & (settled | strong | published)
    one_word = (F.size(F.split(F.coalesce("matched_key", F.lit("")), " ")) == 1) & F.col("method").startswith("core_name")
    return d.select(
        F.lit(month).alias("run_month"), "place_id", "ja_kodas", "category", "method", "confidence", "stage", F.col("is_active").alias("entity_active"), "activity_fits", "vilnius_nexus", "address_agrees", "name_similarity",
        one_word.alias("single_token_name"), _flag(F.col("implausible_spread")).alias("implausible_spread"), confirming.alias("sources_confirming"), conflicting.alias("sources_conflicting"),
        F.coalesce("brand", F.lit(0)).alias("brand_confirming"), "agreement_detail", _flag(F.col("chain")).alias("chain_site"), "audit_verdict", "prev_ja_kodas",
        _flag(F.col("prev_ja_kodas") != F.col("ja_kodas")).alias("relinked_since_last_run"), "validation_status", _flag(usable).alias("usable"),
    )


# ---- independent evidence and fallback links ------------------------------------------------------------------------


def evidence(month: str, vat: DataFrame, website: DataFrame | None = None, serp: DataFrame | None = None, brand: DataFrame | None = None) -> DataFrame:
    """(place_id, source, raw, ja_kodas): what the sources that there are say; ja_kodas is null for a VAT code of nobody.

    ``vat``: the taxpayer register (vat_code, ja_kodas); a code that several entities have names each of them. Codes of a place's policy pages count alone where there are any.
    """
    parts, rows = [], sum(counted(t) for t in (website, serp, brand) if t is not None)
    if website is not None:
        w = website.where((F.col("run_month") == month) & F.col("code").isNotNull())
        w = dealt(w, rows, "place_id").withColumn("policy", _flag(F.lower("page_url").rlike("|".join(POLICY_WORDS))))
        w = w.withColumn("any_policy", F.bool_or("policy").over(Window.partitionBy("place_id"))).where("policy OR NOT any_policy")
        known = vat.where("vat_code IS NOT NULL").select(F.ltrim("vat_code", F.lit("LT")).alias("code"), F.col("ja_kodas").alias("vat_ja")).distinct()
        w = dealt(w.select("place_id", "code_type", "code"), rows, "code").join(known, "code", "left")
        company = F.col("code_type") == "company"
        parts.append(w.select("place_id", F.lit("website").alias("source"), F.concat(F.when(company, "c:").otherwise("v:"), "code").alias("raw"), F.when(company, F.expr("try_cast(code AS bigint)")).otherwise(F.col("vat_ja")).alias("ja_kodas")))
    if serp is not None:
        s = serp.where((F.col("run_month") == month) & F.col("code").isNotNull() & (F.col("hits_named") > 0))
        parts.append(s.select("place_id", F.lit("serp").alias("source"), F.concat(F.lit("c:"), "code").alias("raw"), F.expr("try_cast(code AS bigint)").alias("ja_kodas")))
    if brand is not None:
        b = brand.where((F.col("run_month") == month) & F.col("ja_kodas").isNotNull())
        parts.append(b.select("place_id", "source", F.concat(F.lit("c:"), F.col("ja_kodas").cast("string")).alias("raw"), F.col("ja_kodas").cast("long").alias("ja_kodas")))
    if not parts:
        return vat.sparkSession.createDataFrame([], "place_id string, source string, raw string, ja_kodas long")
    out = dealt(reduce(DataFrame.unionByName, parts), rows, "place_id").distinct()
    out.staged_rows = rows
    return out


def premises_evidence(places: DataFrame, premises: DataFrame, likeness=None, category: str = "nightlife") -> DataFrame:
    """(place_id, source, raw, ja_kodas) from food premises: at the same address under a like name or alone there, or within four house numbers of another number of the street under a very like name.

    Only premises of the same street meet a place. Names are compared (0 to 100, ``likeness`` of two name keys) only
    where their profiles say that they can be as like as that.
    """
    number = lambda key: F.substring_index(key, "|", -1)
    house = lambda key: F.expr(f"try_cast(regexp_extract(substring_index({key}, '|', -1), '^([0-9]+)', 1) AS int)")
    # Keys are long work per row: they are made once, before anything filters or joins by them, and by all tasks.
    m = spread(premises.where("ja_kodas IS NOT NULL").select("ja_kodas", "trade_name", "address"))
    m = staged(m.select("ja_kodas", K.name_key(F.col("trade_name")).alias("trade_key"), K.registry_key(F.col("address")).alias("m_key")), "premises-keys").where("m_key IS NOT NULL")
    alone = m.groupBy("m_key").agg((F.count("*") == 1).alias("alone"))
    m = m.join(alone, "m_key").select("ja_kodas", "trade_key", profile(F.col("trade_key")).alias("trade"), "m_key", "alone", F.substring_index("m_key", "|", 1).alias("street_name"), house("m_key").alias("m_number"))
    p = spread(places.where(F.col("category") == category).select("place_id", "name", "street", "street_number"))
    p = staged(p.select("place_id", K.name_key(F.col("name")).alias("own_key"), K.street_key(F.col("street"), F.col("street_number")).alias("p_key")), "place-keys").where("p_key IS NOT NULL")
    p = p.select("place_id", "own_key", profile(F.col("own_key")).alias("own"), "p_key", F.substring_index("p_key", "|", 1).alias("street_name"), house("p_key").alias("p_number"))
    # A band of four numbers is at most two blocks of eight: premises go to their own block and its neighbours.
    m = m.withColumn("block", F.explode(F.array(*[F.floor(F.col("m_number") / 8) + i for i in (-1, 0, 1)])))
    met = p.withColumn("block", F.floor(F.col("p_number") / 8)).join(m, ["street_name", "block"]).where(F.abs(F.col("p_number") - F.col("m_number")) <= 4)
    same = F.col("p_key") == F.col("m_key")
    other_number = number("p_key") != number("m_key")  # an equal number of another kind of street is another building
    one = met.where(same & F.col("alone"))
    like = likely(met.where(same & ~F.col("alone") | other_number), "own", "trade", F.when(same, 80.0).otherwise(90.0), likeness)
    row = ("place_id", F.lit("vmvt").alias("source"), F.concat(F.lit("c:"), F.col("ja_kodas").cast("string")).alias("raw"), "ja_kodas")
    return one.select(*row).union(like.select(*row)).distinct()


def source_verdicts(linked: DataFrame, found: DataFrame, entities: DataFrame) -> DataFrame:
    """(place_id, source, verdict, evidence) for primary links: a source confirms the linked entity, or conflicts if it names only other active ones; else it says nothing."""
    rows = vars(found).get("staged_rows", 0)  # unknown: as the session deals
    key = F.coalesce(F.col("ja_kodas").cast("string"), F.concat(F.lit("?"), "place_id"))  # codes of nobody do not meet in one task
    active = dealt(entities.where("is_active").select(F.col("ja_kodas").cast("string").alias("key"), F.lit(True).alias("active")), rows, "key")
    f = dealt(found.withColumn("key", key), rows, "key").join(active, "key", "left").drop("key")
    f = dealt(f, rows, "place_id").join(linked.select("place_id", F.col("ja_kodas").alias("linked")), "place_id")
    of = f.groupBy("place_id", "source").agg(F.bool_or(_flag(F.col("active") & (F.col("ja_kodas") == F.col("linked")))).alias("agrees"), F.bool_or(_flag(F.col("active"))).alias("names"), F.array_join(F.sort_array(F.collect_set("raw")), ",").alias("evidence"))
    return of.where("names").select("place_id", "source", F.when(F.col("agrees"), "confirms").otherwise("conflicts").alias("verdict"), "evidence")


def fallback_links(open_places: DataFrame, found: DataFrame, entities: DataFrame, primary: DataFrame, likeness=None) -> DataFrame:
    """(place_id, status, ja_kodas, method, confidence, reason) for places (place_id, name, category, street, street_number) that the primary rules leave open.

    An active entity named by a source counts if its activity or its address fits, its name is like (60 or more), or it
    was a primary candidate, which is a source of its own. It wins alone, or with strictly more sources than any other.
    """
    active = spread(entities.where("is_active").select("ja_kodas", "legal_name", "evrk_codes", "registered_address"))
    active = staged(active.select("ja_kodas", K.name_key(F.col("legal_name")).alias("legal_key"), "evrk_codes", F.when(K.in_city(F.col("registered_address")), K.registry_key(F.col("registered_address"))).alias("own_address")), "entity-keys")
    support = found.join(active, "ja_kodas").groupBy("place_id", "ja_kodas", "legal_key", "evrk_codes", "own_address").agg(F.collect_set("source").alias("sources"))
    opened = spread(open_places.select("place_id", "name", "category", "street", "street_number"))
    opened = staged(opened.select("place_id", "category", K.street_key(F.col("street"), F.col("street_number")).alias("place_address"), K.name_key(F.col("name")).alias("own_key")), "open-places")
    c = support.join(opened, "place_id").join(primary.select("place_id", "ja_kodas").distinct().withColumn("was_primary", F.lit(True)), ["place_id", "ja_kodas"], "left")
    fits = F.exists(F.coalesce("evrk_codes", F.array().cast("array<string>")), lambda code: K.code_fits(F.col("category"), code))
    at_address = F.col("own_address") == F.col("place_address")
    c = staged(c.withColumn("fits", _flag(fits) | _flag(at_address) | _flag(F.col("was_primary"))), "corroboration")
    unlike = c.where("NOT fits").withColumns({"own": profile(F.col("own_key")), "legal": profile(F.col("legal_key"))})
    c = c.where("fits").unionByName(likely(unlike, "own", "legal", 60, likeness).drop("likeness", "own", "legal"))
    c = c.withColumn("sources", F.when(F.col("was_primary"), F.array_append("sources", "primary_candidate")).otherwise(F.col("sources"))).withColumn("n", F.size("sources"))
    c = c.withColumn("top", F.max("n").over(Window.partitionBy("place_id")))  # as many as the entities that evidence names for a place
    first = c.where("n = top").groupBy("place_id").agg(F.count("*").alias("ties"), F.min("ja_kodas").alias("ja_kodas"), F.min(F.array_join(F.sort_array("sources"), "+")).alias("of"))
    won = first.where("ties = 1")
    return won.select("place_id", F.lit("linked").alias("status"), "ja_kodas", F.concat(F.lit("fallback:"), "of").alias("method"), F.lit("MEDIUM").alias("confidence"), F.lit("independent code evidence").alias("reason"))


# ---- visible and declared activity ----------------------------------------------------------------------------------


def entity_activity(month: str, linked: DataFrame, entities: DataFrame, taxes: DataFrame, payroll: DataFrame, revenue: DataFrame) -> DataFrame:
    """One row per linked entity: what its places show, and what it declares. ``linked``: places with their validation."""
    reviews = F.coalesce("user_rating_count", F.lit(0))
    listed = lambda c: F.transform(F.array_sort(F.collect_list(F.struct((-reviews).alias("r"), F.col("place_id").alias("p"), F.col(c).alias("v")))), lambda x: x["v"])
    shown = linked.groupBy("ja_kodas").agg(
        F.count("*").alias("n_places"), F.sort_array(F.collect_set("category")).alias("categories"), F.min_by("category", F.struct(-reviews, "place_id")).alias("main_category"), F.sum(reviews).alias("reviews_total"),
        F.max(reviews).alias("reviews_max_place"), F.round(F.try_divide(F.sum(F.col("rating") * F.col("user_rating_count")), F.sum("user_rating_count")), 2).alias("rating_weighted"),
        F.sum("weekly_open_hours").alias("weekly_open_hours_total"), F.max("weekly_open_hours").alias("weekly_open_hours_max"), F.avg((F.col("price_from") + F.col("price_to")) / 2).alias("price_per_person_mid"),
        F.bool_or("self_service").alias("any_self_service"), listed("place_id").alias("place_ids"), listed("name").alias("place_names"), F.bool_and("usable").alias("all_links_usable"), F.bool_or("activity_fits").alias("activity_fits"),
        F.max("confidence").alias("weakest_confidence"), F.sort_array(F.collect_set("method")).alias("link_methods"), F.sort_array(F.collect_set("validation_status")).alias("validation_statuses"),
    )
    fetched = lambda table, name: F.max("fetch_id").alias(name) if "fetch_id" in table.columns else F.lit(None).cast("string").alias(name)
    here = shown.select("ja_kodas")
    taxes, payroll = staged(taxes, "taxes"), staged(payroll, "payroll")  # read for their last dates, then by entity
    now, last_month = taxes.agg(F.max("year")).scalar(), payroll.agg(F.max("month")).scalar()
    before, ago = F.col("year") < now, lambda n: F.col("year") == now - n
    paid = lambda cond, c="taxes_paid": F.max(F.when(cond, F.col(c)))
    tax = taxes.join(here, "ja_kodas", "left_semi").groupBy("ja_kodas").agg(
        paid(ago(1)).alias("taxes_prev_year"), paid(ago(2)).alias("taxes_prev_year_2"), F.bool_or(ago(1)).alias("taxes_has_tax_year_row"), paid(before, "year").alias("taxes_last_reported_year"),
        F.max_by("taxes_paid", F.when(before & F.col("taxes_paid").isNotNull(), F.struct("year", "taxes_paid"))).alias("taxes_last_reported"), paid(ago(0)).alias("taxes_ytd"), paid(ago(0), "through_month").alias("taxes_ytd_through_month"),
        F.max("updated_on").alias("taxes_updated_on"), F.lit(True).alias("has_vmi_record"), fetched(taxes, "vmi_fetch_id"),
    )
    last_year, lately = F.year("month") == now - 1, F.col("month") > F.add_months(last_month, -12)
    total = lambda cond, c: F.sum(F.when(cond, F.col(c)))
    pay = payroll.join(here, "ja_kodas", "left_semi").groupBy("ja_kodas").agg(
        (total(last_year, "num_insured") / 12.0).alias("insured_avg_prev_year"), total(last_year, "contributions").alias("contributions_prev_year"),
        F.count_if(last_year & F.col("contributions").isNull() & (F.col("num_insured") > 0)).alias("contribution_months_suppressed"), (total(lately, "num_insured") / 12.0).alias("insured_avg_t12m"),
        total(lately, "contributions").alias("contributions_t12m"), F.max_by("num_insured", F.when(F.col("num_insured").isNotNull(), F.col("month"))).alias("insured_latest"), F.max("month").alias("sodra_latest_month"),
        F.max_by("avg_wage", F.when(F.col("avg_wage").isNotNull(), F.col("month"))).alias("avg_wage_latest"), F.lit(True).alias("has_sodra_record"), fetched(payroll, "sodra_fetch_id"),
    )
    # Of several statements for a year the largest counts.
    sold = revenue.where("revenue IS NOT NULL").join(here, "ja_kodas", "left_semi").groupBy("ja_kodas").agg(F.max_by("revenue", F.struct("fiscal_year", "revenue")).alias("revenue_latest"), F.max("fiscal_year").alias("revenue_fy"), fetched(revenue, "revenue_fetch_id"))
    entities = entities.withColumnRenamed("fetch_id", "jar_fetch_id") if "fetch_id" in entities.columns else entities.withColumn("jar_fetch_id", F.lit(None).cast("string"))
    start = F.to_date(F.lit(f"{month}-01"))
    d = shown.join(entities, "ja_kodas").join(tax, "ja_kodas", "left").join(pay, "ja_kodas", "left").join(sold, "ja_kodas", "left")
    known = {c: F.coalesce(c, F.lit(0)) for c in ("insured_avg_prev_year", "contribution_months_suppressed", "insured_avg_t12m", "insured_latest")} | {c: _flag(F.col(c)) for c in ("taxes_has_tax_year_row", "has_vmi_record", "has_sodra_record")}
    months = (F.year(start) - F.year("registered_on")) * 12 + F.month(start) - F.month("registered_on")
    return d.withColumns(
        {
            **known, "run_month": F.lit(month), "tax_year": now - 1, "sodra_as_of": last_month, "revenue_is_stale": F.col("revenue_fy") < now - 1, "multi_site": F.col("other_municipality_branches") > 0,
            "chain": F.col("n_places") > 1, "new_entity": F.col("registered_on") > F.add_months(start, -12), "entity_age_months": months,
        }
    )


# ---- leads ----------------------------------------------------------------------------------------------------------

DIMENSIONS = ("taxes", "contributions", "headcount", "revenue")


def with_peers(d: DataFrame, t: Thresholds) -> DataFrame:
    """Rows with the medians of the narrowest group of comparable entities (category, fifth and form; category and fifth; category) that has enough members, as ``peer``; null without one."""
    levels = [("main_category", "activity_quintile", "form_class"), ("main_category", "activity_quintile"), ("main_category",)]
    ends = (F.min("reviews_per_year").alias("lo"), F.max("reviews_per_year").alias("hi"))
    groups = staged(level_medians(d.where("peer_eligible"), levels, {x: f"d_{x}" for x in DIMENSIONS}, *ends, least=t.min_peers), "peers")
    fields = F.struct(F.col("lvl").alias("level"), "n", *DIMENSIONS, "lo", "hi")
    for k, keys in enumerate(levels):
        m = groups.where(F.col("lvl") == len(levels) - k).select(*keys, fields.alias(f"_m{len(levels) - k}"))
        m.staged_rows = groups.staged_rows
        d = d.join(broadcast_if_small(m), list(keys), "left")
    return d.withColumn("peer", F.coalesce("_m3", "_m2", "_m1")).drop("_m3", "_m2", "_m1")


def gap(peers: Column, own: Column) -> Column:
    """How much less is declared than by peers, as the logarithm of a ratio; null where either is unknown or the ratio is not positive."""
    ratio = F.try_divide(peers + 1, own + 1)
    return F.when(ratio > 0, F.log(ratio))


#: What the score reads of ``entity_activity``: who needs no more of it selects these before, so that lists of places are neither made nor moved.
SCORED = "run_month ja_kodas n_places main_category reviews_total rating_weighted weekly_open_hours_max any_self_service all_links_usable activity_fits owner_operated vat_registered registered_on multi_site new_entity tax_year has_vmi_record taxes_prev_year taxes_has_tax_year_row taxes_last_reported_year taxes_last_reported has_sodra_record insured_avg_prev_year contributions_prev_year contribution_months_suppressed insured_avg_t12m revenue_latest".split()


def scored_leads(activity: DataFrame, thresholds: Thresholds | None = None) -> DataFrame:
    """Every entity of a month's activity (self-service excluded) with its peers, gaps, score, signals, hold reason, tier and rank."""
    t = thresholds or Thresholds()
    c = F.col
    d = activity.where(~_flag(c("any_self_service")))
    years = F.least(F.lit(7.0), F.greatest(F.lit(1.0), F.date_diff(F.to_date(F.concat("run_month", F.lit("-01"))), F.coalesce("registered_on", F.lit("1900-01-01").cast("date"))) / 365.25))
    extreme = (c("rating_weighted") <= t.low_rating) | (c("rating_weighted") >= t.high_rating)
    d = d.withColumns(
        {
            "reviews_per_year": c("reviews_total") / years, "rating_extreme": extreme, "form_class": F.when(c("owner_operated"), "owner_operated").otherwise("company"),
            "d_taxes": F.when(c("has_vmi_record"), F.coalesce("taxes_prev_year", "taxes_last_reported")), "d_headcount": c("insured_avg_prev_year").cast("double"), "d_revenue": c("revenue_latest"),
            "d_contributions": F.when(c("has_sodra_record") & (c("contribution_months_suppressed") == 0), F.coalesce("contributions_prev_year", F.lit(0.0))).when(~c("has_sodra_record") & c("has_vmi_record"), 0.0),
            "peer_eligible": ~_flag(c("multi_site")) & c("has_vmi_record") & _flag(c("activity_fits")) & (c("n_places") <= 3),
        }
    )
    d = d.withColumn("enough_reviews", c("reviews_total") >= t.min_reviews * F.when(_flag(c("rating_extreme")), t.extreme_factor).otherwise(1.0))
    d = positions(staged(d, "activity"), "reviews_per_year", within=("main_category",), ties=("ja_kodas",)).where("main_category IS NOT NULL")
    floors = staged(percentiles(d, "reviews_per_year", ("main_category",), {"_busy": t.busy, "_busy_extreme": t.busy_extreme}), "floors")
    d = d.withColumn("activity_quintile", ntile(c("row_number"), c("group_rows"), 5).cast("int")).drop("row_number", "rank", "group_rows")
    d = d.join(broadcast_if_small(floors), "main_category").withColumn("busy_floor", F.when(_flag(c("rating_extreme")), c("_busy_extreme")).otherwise(c("_busy"))).drop("_busy", "_busy_extreme")
    d = with_peers(d.withColumn("visibly_busy", c("reviews_per_year") >= c("busy_floor")), t)
    peer = lambda x: c(f"peer.{x}")
    d = d.withColumns(
        {
            "gap_taxes": gap(peer("taxes"), c("d_taxes")), "gap_revenue": gap(peer("revenue"), c("d_revenue")),
            "gap_payroll": F.when(c("d_contributions").isNotNull(), gap(peer("contributions"), c("d_contributions"))).otherwise(gap(peer("headcount"), c("d_headcount"))),
        }
    )
    per_1k = lambda declared, floor: c("reviews_per_year") / (F.greatest(F.coalesce(c(declared), F.lit(floor)), F.lit(floor)) / 1000)
    d = d.withColumns(
        {
            "taxes_year": F.when(c("taxes_has_tax_year_row"), c("tax_year")).otherwise(c("taxes_last_reported_year")), "peer_reviews_per_year_lo": F.round(peer("lo")), "peer_reviews_per_year_hi": F.round(peer("hi")),
            "reviews_per_1k_taxes": per_1k("d_taxes", t.near_zero_tax), "reviews_per_1k_revenue": per_1k("d_revenue", t.near_zero_revenue), "insured_per_100_reviews": F.try_divide(100.0 * c("d_headcount"), c("reviews_per_year")),
        }
    ).withColumn("taxes_from_earlier_year", c("taxes_year") < c("tax_year"))
    weights = {"gap_taxes": 0.5, "gap_payroll": 0.3, "gap_revenue": 0.2}
    score = F.try_divide(sum(F.coalesce(c(g) * w, F.lit(0.0)) for g, w in weights.items()), sum(F.when(c(g).isNotNull(), w).otherwise(0.0) for g, w in weights.items()))
    full_time = c("weekly_open_hours_max") / 40.0
    signals = {
        "sig_near_zero_declared": _flag((c("d_taxes") < t.near_zero_tax) | (c("d_revenue") < t.near_zero_revenue)),
        "sig_staffing_floor": _flag(~c("owner_operated") & (full_time > c("insured_avg_t12m") + 1)),
        "sig_vat_gap": ~_flag(c("vat_registered")) & _flag(peer("revenue") > t.vat_revenue),
    }
    known = c("peer").isNotNull()  # what nobody compares with says nothing
    d = d.withColumns({"score": score, **{name: F.when(known, s) for name, s in signals.items()}}).withColumn("n_signals", sum(c(s).cast("int") for s in signals))
    large_gap = c("gap_taxes") >= F.log(F.lit(t.gap_ratio))
    large_gap = _flag(large_gap) if t.strict else F.coalesce(large_gap, F.lit(True))  # without a known gap nothing is in line
    enough_signals = c("n_signals") >= F.when(_flag(c("rating_extreme")), 2).otherwise(1)
    hold = (
        F.when(~known, "too few comparable peers")
        .when(c("new_entity"), "entity younger than 12 months")
        .when(~c("has_vmi_record"), "no tax record (absence is not proof of zero)")
        .when(c("score").isNull(), "too few comparable peers")
        .when(~c("enough_reviews"), "too few reviews for the rating profile")
        .when(~c("visibly_busy"), F.concat(F.lit("not visibly busy vs category ("), F.round("busy_floor", 1).cast("string"), F.lit("+ reviews per year needed)")))
        .when(~large_gap, "taxes in line with peers")
        .when(~_flag(c("all_links_usable")), "link to legal entity not verified enough")
        .when(~enough_signals, "no corroborating signal")
    )
    tier = (
        F.when(_flag(c("new_entity")) | ~c("has_vmi_record") | c("score").isNull(), "D_insufficient_evidence")
        .when(~c("enough_reviews") | ~c("visibly_busy") | ~large_gap, "C_not_flagged")
        .when(_flag(c("all_links_usable")) & enough_signals, "A_priority")
        .otherwise("B_watchlist")
    )
    d = staged(d.withColumns({"hold_reason": hold, "tier_raw": tier}), "scored")
    top = d.where("tier_raw = 'A_priority'").orderBy(F.desc_nulls_last("score"), "ja_kodas").limit(t.capacity).select("ja_kodas", F.lit(True).alias("_top"))
    d = d.join(F.broadcast(top), "ja_kodas", "left").withColumn("_late", (c("tier_raw") == "A_priority") & c("_top").isNull())
    d = d.withColumn("tier", F.when(c("_late"), "B_watchlist").otherwise(c("tier_raw")))
    if t.strict:
        d = d.withColumn("hold_reason", F.when(c("_late"), "beyond the month's capacity").otherwise(c("hold_reason")))
    d = d.withColumn("_bucket", F.when(c("tier_raw") == "A_priority", 0).when(c("tier_raw") == "B_watchlist", 1).otherwise(2))
    d = positions(d, "score", after=("_bucket",), ties=("ja_kodas",), descending=True).withColumnRenamed("rank", "priority_rank")
    return d.drop("_top", "_late", "_bucket", "row_number", "group_rows", "tier_raw")
