"""The models on whole test tables: relations of the survey's schema are laid over them, in both SQL dialects.

An order is a listed place, and a customer's orders are dealt over four legal entities; line items are what the
entities declare: taxes by year, payroll by month, revenue by fiscal year.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import dealt, staged
from . import cascade, models
from .dialect import duck, spark_sql
from .sweep import area_cells

MONTH, PREVIOUS = "2001-09", "2001-08"
_OWNER = "o_custkey * 4 + o_orderkey % 4"

#: Whole hundredths, whose sums are the same in any order.
_CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT)"

RELATIONS = {
    "places": f"""SELECT 'p' || CAST(o_orderkey AS [[VARCHAR||STRING]]) AS place_id, {_OWNER} AS ja_kodas, '{MONTH}' AS run_month, 'n' || CAST(o_orderkey AS [[VARCHAR||STRING]]) AS name, o_orderkey % 50 <> 7 AS in_scope,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'hair_beauty' WHEN '2-HIGH' THEN 'nightlife' ELSE 'auto' END AS category, CAST(floor(o_totalprice / 1000) AS INT) AS user_rating_count,
        1.0[[::DOUBLE||D]] + (o_orderkey % 17) / 4.0[[::DOUBLE||D]] AS rating, CAST(o_orderkey % 100 AS DOUBLE) AS weekly_open_hours, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey % 30 AS DOUBLE) END AS price_from,
        CAST(o_orderkey % 90 AS DOUBLE) AS price_to, o_orderkey % 211 = 3 AS self_service, 'street ' || CAST(o_orderkey % 9 AS [[VARCHAR||STRING]]) AS street, CAST(o_orderkey % 4 AS [[VARCHAR||STRING]]) AS street_number,
        CASE WHEN o_orderkey % 3 > 0 THEN 'https://www.site' || CAST(o_custkey % 97 AS [[VARCHAR||STRING]]) || '.lt/x' END AS website, o_orderstatus FROM $orders""",
    "entities": f"""SELECT ja_kodas, 'Entity ' || CAST(ja_kodas AS [[VARCHAR||STRING]]) AS legal_name, ja_kodas % 3 = 0 AS owner_operated, CAST(DATE '1994-01-01' + [[CAST(ja_kodas * 37 % 2800 AS INT)||CAST(ja_kodas * 37 % 2800 AS INT)]] AS DATE) AS registered_on,
        ja_kodas % 5 < 3 AS vat_registered, CAST(CASE WHEN ja_kodas % 7 = 0 THEN 2 ELSE 0 END AS INT) AS other_municipality_branches, ja_kodas % 23 <> 5 AS is_active, ja_kodas % 4 <> 1 AS vilnius_nexus FROM (SELECT DISTINCT {_OWNER} AS ja_kodas FROM $orders) x""",
    "taxes": f"""SELECT {_OWNER} AS ja_kodas, CAST(year(l_shipdate) AS INT) AS year, sum({_CENTS}) / 1024.0[[::DOUBLE||D]] AS taxes_paid, CAST(max(month(l_shipdate)) AS INT) AS through_month, CAST(max(l_shipdate) AS DATE) AS updated_on
        FROM $lineitem JOIN $orders ON l_orderkey = o_orderkey WHERE l_linestatus = 'F' OR l_quantity > 10 GROUP BY 1, 2""",
    "payroll": f"""SELECT {_OWNER} AS ja_kodas, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, CAST(sum(l_linenumber) AS INT) AS num_insured, CASE WHEN max(l_quantity) > 5 THEN sum({_CENTS} * l_linenumber) / 4096.0[[::DOUBLE||D]] END AS contributions,
        max(l_quantity) * 100 AS avg_wage FROM $lineitem JOIN $orders ON l_orderkey = o_orderkey WHERE l_returnflag <> 'R' GROUP BY 1, 2""",
    "revenue": f"""SELECT {_OWNER} AS ja_kodas, CAST(year(l_shipdate) AS INT) AS fiscal_year, sum({_CENTS}) / 128.0[[::DOUBLE||D]] AS revenue FROM $lineitem JOIN $orders ON l_orderkey = o_orderkey WHERE l_returnflag <> 'A' GROUP BY 1, 2""",
    "links": f"""SELECT '{MONTH}' AS run_month, 'p' || CAST(o_orderkey AS [[VARCHAR||STRING]]) AS place_id, {_OWNER} AS ja_kodas, CASE WHEN o_orderkey % 19 = 4 THEN 'ambiguous' ELSE 'linked' END AS status,
        CASE o_orderkey % 8 WHEN 0 THEN 'exact_name' WHEN 1 THEN 'core_name+address' WHEN 2 THEN 'override' WHEN 3 THEN 'fallback:website' WHEN 4 THEN 'fallback:job_ads+trademark' WHEN 5 THEN 'fallback:serp+website' WHEN 6 THEN 'fallback:primary_candidate+website' ELSE 'fallback:job_ads+primary_candidate+vmvt' END AS method,
        CASE WHEN o_orderkey % 8 < 3 THEN 'HIGH' ELSE 'MEDIUM' END AS confidence, CASE WHEN o_orderkey % 8 < 2 THEN 'primary' WHEN o_orderkey % 8 = 2 THEN 'override' ELSE 'fallback' END AS stage FROM $orders
        UNION ALL SELECT '{PREVIOUS}', 'p' || CAST(o_orderkey AS [[VARCHAR||STRING]]), {_OWNER} + CASE WHEN o_orderkey % 31 = 2 THEN 1 ELSE 0 END, CASE WHEN o_orderkey % 6 = 0 THEN 'unmatched' ELSE 'linked' END, 'exact_name', 'HIGH', 'primary' FROM $orders""",
    "candidates": f"""SELECT '{MONTH}' AS run_month, 'p' || CAST(l_orderkey AS [[VARCHAR||STRING]]) AS place_id, {_OWNER} + CASE WHEN l_linenumber = 3 THEN 1 ELSE 0 END AS ja_kodas, l_returnflag = 'A' AS evrk_consistent, l_quantity > 40 AS address_agrees,
        l_quantity * 2 AS name_similarity, CASE WHEN l_linenumber % 2 = 0 THEN 'one' ELSE 'two words' END AS matched_key FROM $lineitem JOIN $orders ON l_orderkey = o_orderkey""",
    "agreement": f"""SELECT DISTINCT '{MONTH}' AS run_month, 'p' || CAST(l_orderkey AS [[VARCHAR||STRING]]) AS place_id, CASE l_linenumber WHEN 1 THEN 'website' WHEN 2 THEN 'trademark' WHEN 3 THEN 'serp' ELSE 'vmvt' END AS source,
        CASE WHEN l_returnflag = 'R' THEN 'conflicts' ELSE 'confirms' END AS verdict FROM $lineitem WHERE l_quantity < 12""",
    "audits": f"""SELECT 'p' || CAST(o_orderkey AS [[VARCHAR||STRING]]) AS place_id, {_OWNER} AS ja_kodas, CASE WHEN o_totalprice > 400000 THEN 'correct' WHEN o_totalprice < 20000 THEN 'wrong' END AS verdict, CAST(o_orderdate AS DATE) AS audited_on FROM $orders WHERE o_totalprice > 400000 OR o_totalprice < 20000""",
    "website": f"""SELECT '{MONTH}' AS run_month, 'p' || CAST(l_orderkey AS [[VARCHAR||STRING]]) AS place_id, CASE WHEN l_linenumber % 2 = 0 THEN 'vat' ELSE 'company' END AS code_type, CAST({_OWNER} + CASE WHEN l_returnflag = 'R' THEN 4 ELSE 0 END AS [[VARCHAR||STRING]]) AS code,
        CASE WHEN l_quantity > 30 THEN 'https://x.lt/Privacy' ELSE 'https://x.lt/' END AS page_url FROM $lineitem JOIN $orders ON l_orderkey = o_orderkey""",
    "serp": f"""SELECT '{MONTH}' AS run_month, 'p' || CAST(l_orderkey AS [[VARCHAR||STRING]]) AS place_id, CAST({_OWNER} + CASE WHEN l_linestatus = 'F' THEN 4 ELSE 0 END AS [[VARCHAR||STRING]]) AS code, CAST(l_linenumber - 2 AS INT) AS hits_named FROM $lineitem JOIN $orders ON l_orderkey = o_orderkey""",
    "vat": f"SELECT DISTINCT 'LT' || CAST({_OWNER} AS [[VARCHAR||STRING]]) AS vat_code, {_OWNER} AS ja_kodas FROM $orders",
}


def relation(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.sql(spark_sql(RELATIONS[name], sf_dir))


def _rounded(df: DataFrame, digits: int = 2) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c).cast("int").alias(c) if t == "smallint" else F.array_join(c, "+").alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes])


def _linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = relation(spark, sf_dir, "places")
    return places.withColumns({"usable": F.col("o_orderstatus") != "P", "activity_fits": F.col("user_rating_count") % 3 != 0, "confidence": F.when(F.col("rating") > 3, "HIGH").otherwise("MEDIUM"), "method": F.lit("exact_name"), "validation_status": F.lit("confirmed")})


_LINES = "$lineitem JOIN $orders ON l_orderkey = o_orderkey"


def _declared(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Taxes, payroll and revenue: their line items meet the orders once for all three."""
    columns = "o_custkey, o_orderkey, l_shipdate, l_linestatus, l_returnflag, l_quantity, l_extendedprice, l_linenumber"
    lines = staged(spark.sql(spark_sql(f"SELECT {columns} FROM {_LINES}", sf_dir)), "lines")
    return _over(lines, sf_dir, "taxes", "payroll", "revenue")


def _over(lines: DataFrame, sf_dir: str, *names: str) -> list[DataFrame]:
    """Relations read from staged line items with their orders; none has more rows than these."""
    out = [lines.sparkSession.sql(spark_sql(RELATIONS[r].replace(_LINES, f"parquet.`{lines.staged_at}`"), sf_dir)) for r in names]
    for df in out:
        df.staged_rows = lines.staged_rows
    return out


def _named(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Codes on websites and in search results: line items, dealt by counted rows, meet the orders once for both."""
    items, orders = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("lineitem", "orders"))
    items = dealt(items.select("l_orderkey", "l_linestatus", "l_returnflag", "l_quantity", "l_linenumber"), items.count(), "l_orderkey")
    lines = items.join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return _over(staged(lines, "named"), sf_dir, "website", "serp")


def _activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.entity_activity(MONTH, _linked(spark, sf_dir), relation(spark, sf_dir, "entities"), *_declared(spark, sf_dir))


def _leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.scored_leads(_activity(spark, sf_dir).select(models.SCORED))


ACTIVITY = "ja_kodas n_places categories main_category reviews_total reviews_max_place weekly_open_hours_max any_self_service place_ids all_links_usable activity_fits weakest_confidence taxes_prev_year taxes_prev_year_2 taxes_has_tax_year_row taxes_last_reported_year taxes_last_reported taxes_ytd taxes_ytd_through_month has_vmi_record insured_avg_prev_year contributions_prev_year contribution_months_suppressed insured_avg_t12m insured_latest avg_wage_latest has_sodra_record revenue_latest revenue_fy revenue_is_stale multi_site chain new_entity entity_age_months tax_year".split()
LEAD = "ja_kodas activity_quintile peer_level peer_n peer_reviews_per_year_lo peer_reviews_per_year_hi taxes_year taxes_from_earlier_year reviews_per_1k_taxes reviews_per_1k_revenue insured_per_100_reviews gap_taxes gap_payroll gap_revenue score n_signals hold_reason tier priority_rank".split()


def model_entity_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_activity(spark, sf_dir).select(ACTIVITY))


def model_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    leads = _leads(spark, sf_dir).withColumns({"peer_level": F.col("peer.level"), "peer_n": F.col("peer.n"), "hold_reason": F.regexp_replace("hold_reason", r" \(.*", "")})
    return _rounded(leads.select(LEAD), 4)


def model_link_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = models.validated_links(MONTH, *[relation(spark, sf_dir, r) for r in ("links", "places", "entities", "candidates", "agreement", "audits")])
    return out.drop("name_similarity", "run_month")


def model_source_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    website, serp = _named(spark, sf_dir)
    found = models.evidence(MONTH, relation(spark, sf_dir, "vat"), website=website, serp=serp)
    return models.source_verdicts(relation(spark, sf_dir, "places").where("in_scope"), found, relation(spark, sf_dir, "entities"))


def adaptive_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells of an adaptive grid over all orders, laid out by their dates and prices."""
    points = spark.sql(spark_sql(_POINTS, sf_dir))
    return area_cells(points, (0.0, 0.0, 1.0, 1.0), capacity=200, deepest=6)


def name_prefix_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of parts with words behind them, resolved among suppliers' named entities by the longest known prefix."""
    names = spark.sql(spark_sql(_NAMES, sf_dir))
    known = spark.sql(spark_sql(_KNOWN, sf_dir))
    return cascade.resolve_names(names, known)


_POINTS = "SELECT o_orderkey AS id, (CAST([[date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE))||datediff(CAST(o_orderdate AS DATE), DATE '1995-01-01')]] AS DOUBLE) + 0.5[[::DOUBLE||D]]) / 2500 AS lat, (o_totalprice / 500000) * (o_totalprice / 500000) AS lng FROM $orders"
_NAMES = "SELECT DISTINCT p_name || ' ' || lower(p_type) || ' ' || CAST(p_size AS [[VARCHAR||STRING]]) AS name FROM $part UNION SELECT DISTINCT p_name || ' plus' FROM $part"
_KNOWN = "SELECT p_partkey AS ja_kodas, p_name || CASE WHEN p_partkey % 3 = 0 THEN ' ' || lower(p_type) ELSE '' END || CASE WHEN p_partkey % 6 = 0 THEN ' ' || CAST(p_size AS [[VARCHAR||STRING]]) ELSE '' END AS legal_name, p_partkey % 10 < 8 AS is_active FROM $part"

_with = lambda *names: ", ".join(f"{n} AS ({duck(RELATIONS[n])})" for n in names)

_ACTIVITY_SQL = f"""{_with("places", "entities", "taxes", "payroll", "revenue")},
lp AS (SELECT *, o_orderstatus <> 'P' AS usable, user_rating_count % 3 <> 0 AS activity_fits, CASE WHEN rating > 3 THEN 'HIGH' ELSE 'MEDIUM' END AS confidence FROM places),
cal AS (SELECT (SELECT max(year) FROM taxes) AS y, (SELECT max(month) FROM payroll) AS m),
vis AS (
  SELECT ja_kodas, count(*) AS n_places, string_agg(DISTINCT category, '+' ORDER BY category) AS categories, first(category ORDER BY user_rating_count DESC, place_id) AS main_category, CAST(sum(user_rating_count) AS BIGINT) AS reviews_total,
         max(user_rating_count) AS reviews_max_place, round(sum(rating * user_rating_count) / nullif(sum(user_rating_count), 0), 2) AS rating_weighted, max(weekly_open_hours) AS weekly_open_hours_max, bool_or(self_service) AS any_self_service,
         string_agg(place_id, '+' ORDER BY user_rating_count DESC, place_id) AS place_ids, bool_and(usable) AS all_links_usable, bool_or(activity_fits) AS activity_fits, max(confidence) AS weakest_confidence FROM lp GROUP BY ja_kodas),
tax AS (
  SELECT ja_kodas, max(CASE WHEN year = y - 1 THEN taxes_paid END) AS taxes_prev_year, max(CASE WHEN year = y - 2 THEN taxes_paid END) AS taxes_prev_year_2, bool_or(year = y - 1) AS had_row, max(CASE WHEN year < y THEN year END) AS taxes_last_reported_year,
         first(taxes_paid ORDER BY year DESC) FILTER (WHERE year < y) AS taxes_last_reported, max(CASE WHEN year = y THEN taxes_paid END) AS taxes_ytd, max(CASE WHEN year = y THEN through_month END) AS taxes_ytd_through_month FROM taxes, cal GROUP BY ja_kodas),
pay AS (
  SELECT ja_kodas, sum(CASE WHEN year(month) = y - 1 THEN num_insured END) / 12.0::DOUBLE AS insured_avg_prev_year, sum(CASE WHEN year(month) = y - 1 THEN contributions END) AS contributions_prev_year,
         sum(CASE WHEN year(month) = y - 1 AND contributions IS NULL AND num_insured > 0 THEN 1 ELSE 0 END) AS suppressed, sum(CASE WHEN month > m - INTERVAL 12 MONTH THEN num_insured END) / 12.0::DOUBLE AS insured_avg_t12m,
         first(num_insured ORDER BY month DESC) AS insured_latest, first(avg_wage ORDER BY month DESC) AS avg_wage_latest FROM payroll, cal GROUP BY ja_kodas),
rev AS (SELECT ja_kodas, first(revenue ORDER BY fiscal_year DESC) AS revenue_latest, max(fiscal_year) AS revenue_fy FROM revenue GROUP BY ja_kodas),
act AS (
  SELECT v.*, e.owner_operated, e.vat_registered, e.registered_on, taxes_prev_year, taxes_prev_year_2, coalesce(had_row, false) AS taxes_has_tax_year_row, taxes_last_reported_year, taxes_last_reported, taxes_ytd, taxes_ytd_through_month,
         t.ja_kodas IS NOT NULL AS has_vmi_record, coalesce(insured_avg_prev_year, 0) AS insured_avg_prev_year, contributions_prev_year, CAST(coalesce(suppressed, 0) AS BIGINT) AS contribution_months_suppressed, coalesce(insured_avg_t12m, 0) AS insured_avg_t12m,
         coalesce(insured_latest, 0) AS insured_latest, avg_wage_latest, p.ja_kodas IS NOT NULL AS has_sodra_record, revenue_latest, revenue_fy, revenue_fy < y - 1 AS revenue_is_stale, other_municipality_branches > 0 AS multi_site, n_places > 1 AS chain,
         registered_on > DATE '{MONTH}-01' - INTERVAL 12 MONTH AS new_entity, CAST(date_diff('month', registered_on, DATE '{MONTH}-01') AS INT) AS entity_age_months, y - 1 AS tax_year
  FROM vis v JOIN entities e USING (ja_kodas) LEFT JOIN tax t USING (ja_kodas) LEFT JOIN pay p USING (ja_kodas) LEFT JOIN rev r USING (ja_kodas), cal)"""

_REAL = {"weekly_open_hours_max", "taxes_prev_year", "taxes_prev_year_2", "taxes_last_reported", "taxes_ytd", "insured_avg_prev_year", "contributions_prev_year", "insured_avg_t12m", "avg_wage_latest", "revenue_latest"}

_LEADS_SQL = f"""WITH {_ACTIVITY_SQL},
a AS (
  SELECT *, reviews_total / greatest(1.0::DOUBLE, least(7.0::DOUBLE, date_diff('day', registered_on, DATE '{MONTH}-01') / 365.25::DOUBLE)) AS rpy, coalesce(rating_weighted <= 3.5 OR rating_weighted >= 4.8, false) AS extreme,
         CASE WHEN has_vmi_record THEN coalesce(taxes_prev_year, taxes_last_reported) END AS dt, CASE WHEN has_sodra_record THEN CASE WHEN contribution_months_suppressed = 0 THEN coalesce(contributions_prev_year, 0) END WHEN has_vmi_record THEN 0 END AS dc,
         NOT multi_site AND has_vmi_record AND activity_fits AND n_places <= 3 AS eligible FROM act WHERE NOT any_self_service),
f AS (SELECT main_category, quantile_cont(rpy, 0.6) AS f60, quantile_cont(rpy, 0.8) AS f80 FROM a GROUP BY main_category),
b AS (SELECT a.*, ntile(5) OVER (PARTITION BY main_category ORDER BY rpy, ja_kodas) AS q, rpy >= CASE WHEN extreme THEN f80 ELSE f60 END AS busy FROM a JOIN f USING (main_category)),
g AS (SELECT main_category AS mc, q AS mq, owner_operated AS mo, CASE WHEN grouping(owner_operated) = 0 THEN 3 WHEN grouping(q) = 0 THEN 2 ELSE 1 END AS lvl, count(*) AS n, min(rpy) AS lo, max(rpy) AS hi, median(dt) AS mt, median(dc) AS mk, median(insured_avg_prev_year) AS mh, median(revenue_latest) AS mr
      FROM b WHERE eligible GROUP BY GROUPING SETS ((main_category, q, owner_operated), (main_category, q), (main_category)) HAVING count(*) >= 8),
p AS (SELECT * FROM b LEFT JOIN g ON mc = main_category AND (lvl = 1 OR mq = q) AND (lvl < 3 OR mo = owner_operated) QUALIFY row_number() OVER (PARTITION BY ja_kodas ORDER BY lvl DESC NULLS LAST) = 1),
h AS (SELECT *, ln((mt + 1) / (dt + 1)) AS gt, CASE WHEN dc IS NOT NULL THEN ln((mk + 1) / (dc + 1)) ELSE ln((mh + 1) / (insured_avg_prev_year + 1)) END AS gp, ln((mr + 1) / (revenue_latest + 1)) AS gr FROM p),
s AS (
  SELECT *, CASE WHEN taxes_has_tax_year_row THEN tax_year ELSE taxes_last_reported_year END AS taxes_year, (coalesce(gt, 0) * 0.5::DOUBLE + coalesce(gp, 0) * 0.3::DOUBLE + coalesce(gr, 0) * 0.2::DOUBLE) / nullif((gt IS NOT NULL)::INT * 0.5::DOUBLE + (gp IS NOT NULL)::INT * 0.3::DOUBLE + (gr IS NOT NULL)::INT * 0.2::DOUBLE, 0) AS score,
         CASE WHEN lvl IS NOT NULL THEN coalesce(dt < 500 OR revenue_latest < 5000, false)::INT + coalesce(NOT owner_operated AND weekly_open_hours_max / 40.0::DOUBLE > insured_avg_t12m + 1, false)::INT + coalesce(NOT vat_registered AND mr > 45000, false)::INT END AS n_signals FROM h),
w AS (
  SELECT *, CASE WHEN lvl IS NULL THEN 'too few comparable peers' WHEN new_entity THEN 'entity younger than 12 months' WHEN NOT has_vmi_record THEN 'no tax record' WHEN score IS NULL THEN 'too few comparable peers' WHEN reviews_total < CASE WHEN extreme THEN 75 ELSE 30 END THEN 'too few reviews for the rating profile'
                 WHEN NOT busy THEN 'not visibly busy vs category' WHEN gt < ln(3.0::DOUBLE) THEN 'taxes in line with peers' WHEN NOT all_links_usable THEN 'link to legal entity not verified enough' WHEN n_signals < 1 + extreme::INT THEN 'no corroborating signal' END AS hold_reason FROM s),
t AS (SELECT *, CASE WHEN hold_reason IS NULL THEN 'A' WHEN hold_reason IN ('entity younger than 12 months', 'no tax record', 'too few comparable peers') THEN 'D' WHEN hold_reason LIKE 'link%' OR hold_reason LIKE 'no corr%' THEN 'B' ELSE 'C' END AS raw FROM w)
SELECT ja_kodas, CAST(q AS INT) AS activity_quintile, CAST(lvl AS INT) AS peer_level, n AS peer_n, round(lo) AS peer_reviews_per_year_lo, round(hi) AS peer_reviews_per_year_hi, taxes_year, taxes_year < tax_year AS taxes_from_earlier_year,
       round(rpy / (greatest(coalesce(dt, 500), 500) / 1000), 4) AS reviews_per_1k_taxes, round(rpy / (greatest(coalesce(revenue_latest, 5000), 5000) / 1000), 4) AS reviews_per_1k_revenue, round(100.0::DOUBLE * insured_avg_prev_year / nullif(rpy, 0), 4) AS insured_per_100_reviews, round(gt, 4) AS gap_taxes, round(gp, 4) AS gap_payroll, round(gr, 4) AS gap_revenue, round(score, 4) AS score, CAST(n_signals AS INT) AS n_signals, hold_reason,
       CASE WHEN raw = 'A' THEN CASE WHEN row_number() OVER (PARTITION BY raw ORDER BY score DESC NULLS LAST, ja_kodas) <= 20 THEN 'A_priority' ELSE 'B_watchlist' END WHEN raw = 'B' THEN 'B_watchlist' WHEN raw = 'C' THEN 'C_not_flagged' ELSE 'D_insufficient_evidence' END AS tier,
       rank() OVER (ORDER BY CASE raw WHEN 'A' THEN 0 WHEN 'B' THEN 1 ELSE 2 END, score DESC NULLS LAST) AS priority_rank FROM t"""

_LEADS_CTE = _LEADS_SQL.rpartition("\nSELECT ja_kodas")[0]

_HOST = "nullif(regexp_replace(lower(regexp_extract({0}, '^[A-Za-z]+://([^/?#]*)', 1)), '^www[.]', ''), '')"

_VALIDATION_SQL = f"""WITH {_with("places", "entities", "links", "candidates", "agreement", "audits")},
l AS (SELECT k.*, p.category, {_HOST.format("website")} AS dom FROM links k JOIN places p USING (place_id) WHERE k.run_month = '{MONTH}' AND status = 'linked'),
c AS (SELECT place_id, ja_kodas, bool_or(evrk_consistent) AS fits, bool_or(address_agrees) AS agrees, min(matched_key) AS mk FROM candidates GROUP BY ALL),
s AS (SELECT ja_kodas, count(*) > 3 AND count(DISTINCT category) > 1 AND count(DISTINCT dom) > 1 AS spread FROM l GROUP BY ja_kodas),
x AS (SELECT {_HOST.format("website")} AS dom FROM places WHERE in_scope AND website IS NOT NULL GROUP BY 1 HAVING count(DISTINCT street || street_number) >= 3),
v AS (SELECT place_id, count(*) FILTER (WHERE verdict = 'confirms' AND source <> 'trademark') AS yes, count(*) FILTER (WHERE verdict = 'conflicts' AND source <> 'trademark') AS no, count(*) FILTER (WHERE verdict = 'confirms' AND source = 'trademark') AS brand,
             string_agg(source || ':' || verdict, ', ' ORDER BY source || ':' || verdict) AS detail FROM agreement GROUP BY place_id),
d AS (
  SELECT l.*, e.is_active AS entity_active, e.vilnius_nexus, coalesce(fits, false) AS activity_fits, coalesce(agrees, false) AS address_agrees, coalesce(mk, '') NOT LIKE '% %' AND l.method LIKE 'core_name%' AS single_token_name, coalesce(spread, false) AS implausible_spread,
         coalesce(yes, 0) AS sources_confirming, coalesce(no, 0) AS sources_conflicting, coalesce(brand, 0) AS brand_confirming, detail AS agreement_detail, x.dom IS NOT NULL AS chain_site, a.verdict AS audit_verdict, b.ja_kodas AS prev_ja_kodas
  FROM l JOIN entities e USING (ja_kodas) LEFT JOIN c ON c.place_id = l.place_id AND c.ja_kodas = l.ja_kodas LEFT JOIN s ON s.ja_kodas = l.ja_kodas LEFT JOIN x ON x.dom = l.dom LEFT JOIN v ON v.place_id = l.place_id
  LEFT JOIN audits a ON a.place_id = l.place_id AND a.ja_kodas = l.ja_kodas LEFT JOIN links b ON b.place_id = l.place_id AND b.run_month = '{PREVIOUS}' AND b.status = 'linked'),
o AS (
  SELECT *, CASE WHEN stage = 'override' OR audit_verdict = 'correct' THEN 'confirmed_by_audit' WHEN audit_verdict = 'wrong' THEN 'rejected_by_audit' WHEN sources_confirming > 0 THEN 'confirmed' WHEN sources_conflicting > 0 THEN 'conflict' WHEN stage <> 'fallback' THEN 'unverified'
                 WHEN method IN ('fallback:serp+website', 'fallback:job_ads+primary_candidate+vmvt') THEN 'confirmed' WHEN method = 'fallback:job_ads+trademark' THEN 'brand_level_only' WHEN chain_site THEN 'brand_site_code' ELSE 'single_source' END AS validation_status FROM d)
SELECT place_id, ja_kodas, category, method, confidence, stage, entity_active, activity_fits, vilnius_nexus, address_agrees, single_token_name, implausible_spread, sources_confirming, sources_conflicting, brand_confirming, agreement_detail, chain_site, audit_verdict, prev_ja_kodas,
       coalesce(prev_ja_kodas <> ja_kodas, false) AS relinked_since_last_run, validation_status,
       entity_active AND validation_status NOT IN ('conflict', 'rejected_by_audit') AND NOT implausible_spread
         AND (validation_status LIKE 'confirmed%' OR confidence = 'HIGH' AND (activity_fits OR address_agrees) OR validation_status = 'single_source' AND activity_fits AND (method LIKE '%website%' OR method LIKE '%vmvt%')) AS usable FROM o"""

_VERDICT_SQL = f"""WITH {_with("places", "entities", "website", "serp")},
w AS (SELECT *, contains(lower(page_url), 'privacy') AS policy FROM website),
f AS (SELECT DISTINCT place_id, 'website' AS source, CASE code_type WHEN 'company' THEN 'c:' ELSE 'v:' END || code AS raw, CAST(code AS BIGINT) AS ja, code_type FROM (SELECT *, bool_or(policy) OVER (PARTITION BY place_id) AS with_policy FROM w) WHERE policy OR NOT with_policy
      UNION SELECT place_id, 'serp', 'c:' || code, CAST(code AS BIGINT), 'company' FROM serp WHERE hits_named > 0),
r AS (SELECT f.place_id, source, raw, p.ja_kodas AS own, f.ja, coalesce(e.is_active, false) AS active FROM f JOIN places p ON p.place_id = f.place_id AND in_scope LEFT JOIN entities e ON e.ja_kodas = f.ja)
SELECT place_id, source, CASE WHEN bool_or(active AND ja = own) THEN 'confirms' ELSE 'conflicts' END AS verdict, string_agg(DISTINCT raw, ',' ORDER BY raw) AS evidence FROM r GROUP BY place_id, source HAVING bool_or(active)"""

_CELLS_SQL = f"""WITH p AS ({duck(_POINTS)}), l AS (SELECT unnest(range(0, 7)) AS depth),
c AS (SELECT CAST(depth AS INT) AS depth, CAST(least(floor(lat * pow(2, depth)), pow(2, depth) - 1) AS BIGINT) AS y, CAST(least(floor(lng * pow(2, depth)), pow(2, depth) - 1) AS BIGINT) AS x, count(*) AS n_results FROM p, l WHERE lat BETWEEN 0 AND 1 AND lng BETWEEN 0 AND 1 GROUP BY ALL)
SELECT c.depth, c.y, c.x, c.n_results, CASE WHEN c.n_results < 200 THEN 'complete' WHEN c.depth < 6 THEN 'split' ELSE 'truncated' END AS status
FROM c LEFT JOIN c u ON u.depth = c.depth - 1 AND u.y = c.y // 2 AND u.x = c.x // 2 WHERE c.depth = 0 OR u.n_results >= 200"""

_RESOLVE_SQL = f"""WITH n AS ({duck(_NAMES)}), k AS (SELECT legal_name AS key, count(DISTINCT ja_kodas) AS hits, min(ja_kodas) AS ja_kodas FROM ({duck(_KNOWN)}) WHERE is_active GROUP BY 1),
w AS (SELECT name, string_split(name, ' ') AS w FROM n), p AS (SELECT name, unnest(range(2, len(w) + 1)) AS i, w FROM w), h AS (SELECT name, i, hits, ja_kodas FROM p JOIN k ON key = array_to_string(w[1:i], ' '))
SELECT name, ja_kodas FROM h QUALIFY row_number() OVER (PARTITION BY name ORDER BY i DESC) = 1 AND hits = 1"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (model_entity_activity, model_leads, model_link_validation, model_source_verdicts, adaptive_sweep, name_prefix_backoff)}
ORACLES = {
    "model_entity_activity": f"WITH {_ACTIVITY_SQL} SELECT {', '.join(f'round({c}, 2) AS {c}' if c in _REAL else c for c in ACTIVITY)} FROM act",
    "model_leads": _LEADS_SQL, "model_link_validation": _VALIDATION_SQL, "model_source_verdicts": _VERDICT_SQL, "adaptive_sweep": _CELLS_SQL, "name_prefix_backoff": _RESOLVE_SQL,
}
