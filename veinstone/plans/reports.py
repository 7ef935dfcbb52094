"""What analysts read: the report's tables, samples for audits, explanations, and views over all months."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.sinks import markdown
from .ranks import level_medians

# Documented address formats of the map and of the public register.
MAP_URL, REGISTER_URL = "https://www.google.com/maps/search/?api=1&query=place&query_place_id=", "https://www.registrucentras.lt/jar/p/dok.php?kod="


def maps_url(place_id: Column) -> Column:
    return F.concat(F.lit(MAP_URL), place_id)


def _share(part: Column, of: Column) -> Column:
    return F.round(F.try_divide(100.0 * part, of), 1)


def coverage_tables(month: str, sweep: DataFrame, places: DataFrame, links: DataFrame, validation: DataFrame, activity: DataFrame) -> dict[str, DataFrame]:
    """The report's eight tables by title; each is a few rows of one aggregation, or a short top list."""
    here = lambda df: df.where(F.col("run_month") == month)
    places, links, validation, activity = map(here, (places, links, validation, activity))
    n, count = F.count("*"), F.count_if
    both = places.where("in_scope").join(links.drop("run_month"), "place_id")
    linked, reviews = F.col("status") == "linked", F.col("user_rating_count")
    confirmed = F.col("validation_status").startswith("confirmed")
    checked = F.col("validation_status") != "unverified"
    return {
        "Sweep": here(sweep).groupBy("status").agg(n.alias("cells"), F.sum("n_results").alias("results")).orderBy(F.desc("cells"), "status"),
        "Places by category": places.groupBy(F.coalesce("category", F.lit("(none)")).alias("category")).agg(n.alias("places"), count("in_scope").alias("in_scope"), count("self_service").alias("self_service"), F.sum(F.when(F.col("in_scope"), reviews)).alias("reviews")).orderBy(F.desc("places"), "category"),
        "Out of scope": places.where("NOT in_scope").groupBy(F.col("out_of_scope_reason").alias("reason")).agg(n.alias("places")).orderBy(F.desc("places"), "reason"),
        "Links by category": both.groupBy("category").agg(
            n.alias("places"), count(linked).alias("linked"), _share(count(linked), n).alias("pct_linked"), count(F.col("confidence") == "HIGH").alias("high"), count(F.col("status") == "ambiguous").alias("ambiguous"),
            count(F.col("status") == "unmatched").alias("unmatched"), _share(F.sum(F.when(linked, reviews)), F.sum(reviews)).alias("pct_reviews_linked"),
        ).orderBy("category"),
        "Links by method": links.groupBy(F.coalesce("method", F.concat_ws(": ", "status", "reason")).alias("method_or_reason"), "confidence").agg(n.alias("places")).orderBy(F.desc("places"), "method_or_reason").limit(25),
        "Validation": validation.groupBy("method").agg(
            n.alias("links"), count(confirmed).alias("confirmed"), count(F.col("validation_status") == "conflict").alias("conflict"), count(~checked).alias("unverified"), _share(count(confirmed), count(checked)).alias("pct_confirmed_where_checked"), count("usable").alias("usable"),
        ).orderBy(F.desc("links"), "method"),
        "Declared data": activity.groupBy(F.col("main_category").alias("category")).agg(
            n.alias("entities"), count("has_vmi_record").alias("with_taxes"), count("has_sodra_record").alias("with_payroll"), count(F.col("revenue_fy").isNotNull()).alias("with_revenue"), count(F.col("revenue_fy") >= F.col("tax_year")).alias("with_revenue_last_year"),
            count("owner_operated").alias("owner_operated"), count("vat_registered").alias("vat_registered"), count("new_entity").alias("new"),
        ).orderBy("category"),
        "Busiest places without a link": both.where(~linked).select("name", "category", reviews.alias("reviews"), "status", "reason").orderBy(F.desc_nulls_last("reviews"), "name").limit(15),
    }


def coverage_report(month: str, **tables: DataFrame) -> str:
    parts = [f"# Coverage, {month}"]
    for title, df in coverage_tables(month, **tables).items():
        parts += [f"## {title}", markdown(df)]
    return "\n\n".join(parts) + "\n"


def method_family(method: Column) -> Column:
    return (
        F.when(method.rlike("trademark|job_ads"), "fallback_brand")
        .when(method.rlike("^fallback.*website"), "fallback_website")
        .when(method.rlike("^fallback.*vmvt"), "fallback_premises")
        .when(method.startswith("fallback"), "fallback_other")
        .when(method.startswith("exact"), "exact_name")
        .when(method.rlike("^(core|name_part)"), "core_name")
        .otherwise(method)
    )


def audit_sample(month: str, validation: DataFrame, places: DataFrame, entities: DataFrame, audited: DataFrame, each: int = 3, seed: str = "2") -> DataFrame:
    """Links to verify by hand: a random few of every category and kind of method, without overrides and places that were audited before."""
    v = validation.where((F.col("run_month") == month) & (F.col("stage") != "override")).join(audited.select("place_id").distinct(), "place_id", "left_anti")
    v = v.withColumn("method_family", method_family(F.col("method"))).withColumn("_h", F.xxhash64("place_id", F.lit(f"{month}-{seed}")))
    v = v.withColumn("_n", F.row_number().over(Window.partitionBy("category", "method_family").orderBy("_h", "place_id"))).where(F.col("_n") <= each)  # a group limit: every task keeps its first rows only
    p = places.where(F.col("run_month") == month).select("place_id", F.col("name").alias("place_name"), F.coalesce("maps_uri", maps_url(F.col("place_id"))).alias("maps_uri"), "website")
    out = v.join(p, "place_id").join(entities.select("ja_kodas", "legal_name", "registered_address"), "ja_kodas")
    blank = [F.lit("").alias(c) for c in ("verdict", "auditor", "audited_on", "note")]
    return out.select("place_id", "ja_kodas", *blank, "category", "method_family", "method", "validation_status", "usable", "place_name", "maps_uri", "website", "legal_name", "registered_address", F.concat(F.lit(REGISTER_URL), F.col("ja_kodas").cast("string")).alias("registry_page")).orderBy("category", "method_family", "place_id")


def reasons(leads: DataFrame) -> DataFrame:
    """``leads`` with a column of sentences that say, from its numbers alone, why a lead stands where it does."""
    c, num = F.col, lambda x, d=0: F.format_number(x.cast("double"), d)
    peer = lambda x: c(f"peer.{x}")
    seen = F.format_string("Visible: %s reviews at %s place(s), about %s a year; busy from %s a year on.", num(c("reviews_total")), num(c("n_places")), num(c("reviews_per_year")), num(c("busy_floor"), 1))
    share = F.when(peer("taxes") > 0, F.concat(F.lit(" ("), num(100 * F.coalesce("d_taxes", F.lit(0.0)) / peer("taxes")), F.lit("% of theirs)"))).otherwise("")
    peers = F.when(peer("taxes").isNotNull(), F.concat(F.format_string("Peers: %s entities of its category and size paid a median of EUR %s in taxes; this one EUR %s", num(peer("n")), num(peer("taxes")), F.coalesce(num(c("d_taxes")), F.lit("unknown"))), share, F.lit(".")))
    earlier = F.when(~c("taxes_has_tax_year_row") & c("taxes_last_reported_year").isNotNull(), F.format_string("Tax year: none is published for %d yet, so %d is used.", c("tax_year").cast("int"), c("taxes_last_reported_year").cast("int")))
    payroll = F.format_string("Payroll: %s insured on average; contributions %s.", num(c("d_headcount"), 1), F.coalesce(F.concat(F.lit("EUR "), num(c("d_contributions"))), F.lit("not published")))
    stale = F.when(c("revenue_is_stale"), ", an old statement").otherwise("")
    revenue = F.when(c("d_revenue").isNotNull(), F.concat(F.format_string("Revenue: EUR %s in %d", num(c("d_revenue")), c("revenue_fy").cast("int")), stale, F.lit(".")))
    said = F.array_compact(F.array(F.when(c("sig_near_zero_declared"), "next to nothing declared"), F.when(c("sig_staffing_floor"), "opening hours need more staff"), F.when(c("sig_vat_gap"), "no VAT registration among larger peers")))
    signals = F.concat(F.lit("Signals: "), F.when(F.size(said) > 0, F.array_join(said, "; ")).otherwise("none"), F.lit("."))
    held = F.when(c("hold_reason").isNotNull(), F.concat(F.lit("Held back: "), c("hold_reason"), F.lit(".")))
    return leads.withColumn("reasons", F.array_compact(F.array(seen, peers, earlier, payroll, revenue, signals, held)))


def lead_history(leads: DataFrame) -> DataFrame:
    """Leads of all months with what changed since an entity's month before, and why: other links, other declared figures, other visible activity."""
    own = Window.partitionBy("ja_kodas").orderBy("run_month")
    before = {f"prev_{x}": F.lag(x).over(own) for x in ("run_month", "tier", "score", "link_methods", "d_taxes", "reviews_total")}
    d = leads.withColumns(before)
    differs = lambda x: ~F.col(x).eqNullSafe(F.col(f"prev_{x}"))
    first = F.col("prev_run_month").isNull()
    flagged = F.col("tier").isin("A_priority", "B_watchlist")
    return d.select(
        "run_month", "ja_kodas", "main_category", "tier", "prev_tier", "score", "prev_score", F.round(F.col("score") - F.col("prev_score"), 3).alias("score_change"),
        F.min(F.when(F.col("tier") == "A_priority", F.col("run_month"))).over(Window.partitionBy("ja_kodas")).alias("first_priority_month"), F.count_if(flagged).over(own.rowsBetween(Window.unboundedPreceding, 0)).alias("months_flagged"),
        F.when(first, "new_in_universe").when(differs("tier"), "tier_changed").otherwise("unchanged_tier").alias("change_type"),
        F.when(first, None).when(differs("link_methods"), "other links").when(differs("d_taxes"), "other declared figures").when(differs("reviews_total"), "other visible activity").otherwise("no input changed").alias("change_reason"),
    )


# ---- views over the models ------------------------------------------------------------------------------------------


def place_registry(places: DataFrame, links: DataFrame, entities: DataFrame, leads: DataFrame) -> DataFrame:
    """One row for every listed place of every month, with its link, company, and the tier and score of the company's lead."""
    p = places.select(
        "run_month", "place_id", "name", "category", F.col("formatted_address").alias("address"), F.col("user_rating_count").alias("reviews"), "rating", "phone", "website",
        F.coalesce("maps_uri", maps_url(F.col("place_id"))).alias("google_maps"), "in_scope",
    )
    out = p.join(links.select("run_month", "place_id", F.col("status").alias("link_status"), F.col("method").alias("link_method"), "ja_kodas"), ["run_month", "place_id"], "left")
    return out.join(entities.select("ja_kodas", "legal_name"), "ja_kodas", "left").join(leads.select("run_month", "ja_kodas", "tier", "score"), ["run_month", "ja_kodas"], "left")


def category_summary(leads: DataFrame) -> DataFrame:
    """Scored entities, tiers, and medians of declared taxes and visible activity, of every month and category."""
    tier = F.col("tier")
    flagged, scored = F.count_if(tier.isin("A_priority", "B_watchlist")), F.count_if(tier != "D_insufficient_evidence")
    counts = (F.count_if(tier == "A_priority").alias("priority_a"), F.count_if(tier == "B_watchlist").alias("watchlist"), _share(flagged, scored).alias("pct_flagged"))
    out = level_medians(leads, [("run_month", "main_category")], {"median_taxes_paid": "d_taxes", "median_reviews_per_year": "reviews_per_year"}, *counts)
    return out.drop("lvl").withColumnRenamed("n", "scored_entities")


def lead_detail(ja_kodas: int, leads: DataFrame, places: DataFrame, links: DataFrame, candidates: DataFrame, agreement: DataFrame) -> dict[str, DataFrame]:
    """What an analyst opens of one lead, by title: its months with reasons, its places with their links, what the rules considered for these, and what sources say."""
    own = leads.where(F.col("ja_kodas") == ja_kodas)
    linked = links.where((F.col("ja_kodas") == ja_kodas) & (F.col("status") == "linked"))
    here = linked.select("run_month", "place_id")
    at = places.select("run_month", "place_id", "name", "category", "street", "street_number", "rating", "user_rating_count", "website")
    return {
        "Months": reasons(own).orderBy(F.desc("run_month")),
        "Places": linked.join(at, ["run_month", "place_id"]).withColumn("google_maps", maps_url(F.col("place_id"))).orderBy(F.desc("run_month"), F.desc_nulls_last("user_rating_count"), "place_id"),
        "Considered": candidates.join(here, ["run_month", "place_id"], "left_semi").orderBy(F.desc("run_month"), "place_id", F.desc_nulls_last("name_similarity"), "ja_kodas"),
        "Sources": agreement.join(here, ["run_month", "place_id"], "left_semi").orderBy(F.desc("run_month"), "place_id", "source"),
    }


def quality_view(checks: DataFrame, fetches: DataFrame, month: str) -> dict[str, DataFrame]:
    """The month's checks, failed ones and errors first, and the last fetch of every source with its rows."""
    c = checks.where(F.col("run_month") == month)
    last = fetches.groupBy("source").agg(F.max_by(F.struct("fetched_at", "fetch_id", "row_count"), F.struct("fetched_at", "fetch_id")).alias("f")).select("source", "f.*")
    return {"Checks": c.orderBy(F.coalesce("passed", F.lit(False)), "severity", "check_name"), "Sources": last.orderBy("source")}
