"""The linking cascade, fallback votes, area sweeps, walks, work lists and refreshed evidence over whole test tables, with SQL of their own to compare.

Relations of the survey's schema are laid over the tables, in both SQL dialects, so that every branch of the rules
occurs at every size.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import paged
from ..staging import shared_dir, staged
from . import brands, cascade, likeness, model_queries, models, refresh, reporting, reports, sites, sweep, worklists
from .dialect import duck, spark_sql
from .geo import nearest

_T = "CAST({0} AS [[VARCHAR||STRING]])"
_K = _T.format("p_partkey")
_S = "p_partkey % 20"
_LIST = lambda x: f"[[[{x}]||array({x})]]"
_NONE = "[[CAST([] AS VARCHAR[])||CAST(array() AS array<string>)]]"

# ---- the cascade: a part is a case of its number modulo 20 ------------------------------------------------------------

CASES = {
    "entities": f"""SELECT p_partkey AS ja_kodas, CASE WHEN {_S} <> 8 THEN 'UAB Alfa' || {_K} WHEN p_partkey = 8 THEN 'UAB Bendras' ELSE 'UAB Bendras Alfa' || {_K} END AS legal_name, 'Vilnius, Upės g. ' || {_K} AS registered_address,
        CASE WHEN {_S} IN (1, 4, 5, 9, 12, 13, 14) THEN {_LIST("'45.20'")} ELSE {_NONE} END AS evrk_codes, {_S} <> 19 AS nexus, {_S} <> 18 AS is_active FROM $part
        UNION ALL SELECT p_partkey + 1000000000, CASE WHEN {_S} = 14 THEN 'MB Beta' ELSE 'MB Alfa' END || {_K}, 'Vilnius, ' || CASE WHEN {_S} IN (7, 14) THEN 'Upės' ELSE 'Kalnų' END || ' g. ' || {_K}, CASE WHEN {_S} IN (5, 14) THEN {_LIST("'45.20', '10.1'")} ELSE {_NONE} END, true, true FROM $part WHERE {_S} IN (3, 4, 5, 7, 14)""",
    "places": f"""SELECT 'p' || {_K} AS place_id, CASE WHEN {_S} IN (6, 7, 9, 10) THEN 'Alfa' || {_K} || ' Autoservisas' WHEN {_S} = 8 THEN 'Bendras Autoservisas' WHEN {_S} IN (11, 15) THEN 'Nauja' || {_K} || ' | Alfa' || {_K} WHEN {_S} IN (12, 13, 14) THEN 'Kitas' || {_K}
        WHEN {_S} = 16 THEN 'Autoservisas' WHEN {_S} = 17 THEN 'Niekas' || {_K} ELSE 'Alfa' || {_K} END AS name, 'auto' AS category, CASE WHEN {_S} IN (0, 3, 6, 7, 11, 12, 13, 14) THEN 'Upės g.' END AS street, {_K} AS street_number FROM $part
        UNION ALL SELECT 'q' || {_K}, 'Trečias' || {_K}, 'auto', 'Upės g.', {_K} FROM $part WHERE {_S} = 13""",
}


def _case(spark: SparkSession, sf_dir: str, relation: str) -> DataFrame:
    return spark.sql(spark_sql(relation, sf_dir))


def link_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``cascade.decide``: each of its outcomes is a twentieth of the places."""
    return cascade.decide(_case(spark, sf_dir, CASES["places"]), _case(spark, sf_dir, CASES["entities"]))


def link_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the rules considered, without the likeness of names, which SQL has no word for."""
    return cascade.candidates(_case(spark, sf_dir, CASES["places"]), _case(spark, sf_dir, CASES["entities"])).drop("matched_key")


_FOLDED = "list_filter(string_split(trim(regexp_replace(lower(strip_accents({0})), '[^0-9a-z]+', ' ', 'g')), ' '), lambda w: w NOT IN ('uab', 'mb', ''))"
_CORE = f"array_to_string(list_filter({_FOLDED}, lambda w: w <> 'autoservisas'), ' ')"
_CANDIDATES = f"""places AS ({duck(CASES["places"])}), entities AS ({duck(CASES["entities"])}),
p AS (SELECT place_id, category, CASE WHEN street IS NOT NULL THEN 'upes|g|' || street_number END AS address, array_to_string({_FOLDED.format("name")}, ' ') AS exact, {_CORE.format("name")} AS core,
             list_filter(list_transform(string_split(name, '|'), lambda x: {_CORE.format("x")}), lambda x: x <> '') AS parts FROM places),
e AS (SELECT ja_kodas, nexus, array_to_string({_FOLDED.format("legal_name")}, ' ') AS exact, {_CORE.format("legal_name")} AS core, lower(strip_accents(regexp_extract(registered_address, ', ([^ ]+)', 1))) || '|g|' || regexp_extract(registered_address, '([0-9]+)$', 1) AS address,
             len(list_filter(evrk_codes, lambda c: c LIKE '45.20%')) > 0 AS fits FROM entities WHERE is_active),
keys AS (
  SELECT place_id, address, 'exact_name' AS via, exact AS key FROM p UNION SELECT place_id, address, 'core_name', core FROM p WHERE core <> ''
  UNION SELECT place_id, address, 'name_part', x FROM (SELECT *, unnest(parts) AS x FROM p) WHERE x <> core UNION SELECT place_id, address, 'address', address FROM p WHERE address IS NOT NULL),
c AS (
  SELECT DISTINCT place_id, via, ja_kodas, coalesce(k.address = e.address, false) AS address_agrees, fits AS code_fits
  FROM keys k JOIN e ON CASE via WHEN 'exact_name' THEN nexus AND k.key = e.exact WHEN 'address' THEN k.key = e.address ELSE nexus AND k.key = e.core END)"""
_COUNTS = ", ".join(
    f"count(*) FILTER (WHERE via = '{via}' AND {cond}) AS {short}_{name}, min(ja_kodas) FILTER (WHERE via = '{via}' AND {cond}) AS {short}_{name}_id"
    for via, short in (("exact_name", "x"), ("core_name", "c"), ("name_part", "p"), ("address", "a")) for name, cond in (("n", "true"), ("addr", "address_agrees"), ("fit", "code_fits"))
)
_OUTCOMES = [
    ("x_n = 1 AND (x_addr = 1 OR x_fit = 1)", "x_n_id", "exact_name", "HIGH", "unique name, corroborated"), ("x_n = 1", None, None, "ambiguous", "exact name, activity and address do not fit"), ("x_n > 1 AND x_addr = 1", "x_addr_id", "exact_name+address", "HIGH", "the address singles one out"),
    ("x_n > 1 AND x_addr = 0 AND x_fit = 1", "x_fit_id", "exact_name+activity", "HIGH", "the activity singles one out"), ("x_n > 1", None, None, "ambiguous", "several entities share the name"), ("c_n > 0 AND c_addr = 1", "c_addr_id", "core_name+address", "HIGH", "core name and address"),
    ("c_addr > 1", None, None, "ambiguous", "several entities of the name at the address"), ("c_n > 0 AND NOT distinctive", None, None, "ambiguous", "generic name, no address agreement"), ("c_n > 0 AND c_fit = 1", "c_fit_id", "core_name+activity", "MEDIUM", "core name and activity"),
    ("c_n > 0", None, None, "ambiguous", "several entities share the name"), ("p_addr = 1", "p_addr_id", "name_part+address", "MEDIUM", "name part and address"), ("a_fit = 1 AND a_n <= 5 AND here = 1", "a_fit_id", "address_only", "MEDIUM", "only fitting entity at the address"),
    ("a_fit > 0 AND (a_n > 5 OR here > 1)", None, None, "ambiguous", "multi-tenant address"), ("a_fit > 1", None, None, "ambiguous", "several fitting entities at the address"), ("p_n > 0", None, None, "ambiguous", "name part without address"),
    ("core = ''", None, None, "unmatched", "no distinctive name"), ("true", None, None, "unmatched", "no candidate entity"),
]
_TEXT = lambda x: "NULL" if x is None else f"'{x}'"
_PICK = lambda value: "CASE " + " ".join(f"WHEN {o[0]} THEN {value(o)}" for o in _OUTCOMES) + " END"
_CASCADE_SQL = f"""WITH {_CANDIDATES},
n AS (SELECT place_id, {_COUNTS} FROM c GROUP BY place_id), words AS (SELECT w, count(*) AS df FROM (SELECT DISTINCT ja_kodas, unnest(string_split(core, ' ')) AS w FROM e) GROUP BY w),
h AS (SELECT address, count(*) AS here FROM p WHERE address IS NOT NULL GROUP BY address),
d AS (SELECT p.place_id, p.core, coalesce(here, 0) AS here, core <> '' AND (core LIKE '% %' OR coalesce(df, 0) <= 8) AS distinctive, n.* EXCLUDE (place_id) FROM p LEFT JOIN n ON n.place_id = p.place_id LEFT JOIN h ON h.address = p.address LEFT JOIN words ON w = p.core),
z AS (SELECT * REPLACE (coalesce(x_n, 0) AS x_n, coalesce(x_addr, 0) AS x_addr, coalesce(c_n, 0) AS c_n, coalesce(c_addr, 0) AS c_addr, coalesce(p_n, 0) AS p_n, coalesce(p_addr, 0) AS p_addr, coalesce(a_n, 0) AS a_n, coalesce(a_fit, 0) AS a_fit) FROM d)
SELECT place_id, {_PICK(lambda o: _TEXT("linked" if o[1] else o[3]))} AS status, {_PICK(lambda o: o[1] or "NULL")} AS ja_kodas, {_PICK(lambda o: _TEXT(o[2]))} AS method, {_PICK(lambda o: _TEXT(o[3] if o[1] else None))} AS confidence, {_PICK(lambda o: _TEXT(o[4]))} AS reason FROM z"""

# ---- fallback votes ---------------------------------------------------------------------------------------------------

#: Twelve letters from g to v that only names of one part have; names without them are of other letters.
_TOKEN = f"translate(substr(md5({_K}), 1, 12), '0123456789abcdef', 'ghijklmnopqrstuv')"
_STREET = f"'Gatve' || {_T.format('CAST(floor(p_partkey / 20) AS BIGINT)')}"
_HOUSE = f"(2 * ({_S}) + 1)"
EVIDENCE = {
    "places": f"SELECT 'p' || {_K} AS place_id, {_TOKEN} || ' baras' AS name, 'nightlife' AS category, {_STREET} || ' g.' AS street, {_T.format(_HOUSE)} AS street_number FROM $part",
    "entities": f"""SELECT p_partkey AS ja_kodas, 'UAB ' || CASE WHEN p_partkey % 5 = 0 THEN {_TOKEN} ELSE 'zxyw' || {_K} END AS legal_name, CASE WHEN p_partkey % 13 = 1 THEN 'Vilnius, ' || {_STREET} || ' g. ' || {_T.format(_HOUSE)} ELSE 'Vilnius, Kalnų g. ' || {_K} END AS registered_address,
        CASE WHEN p_partkey % 3 = 0 THEN {_LIST("'56.30'")} ELSE {_NONE} END AS evrk_codes, p_partkey % 11 <> 3 AS is_active FROM $part""",
    "found": f"""SELECT 'p' || {_K} AS place_id, 'website' AS source, 'c:' || {_K} AS raw, p_partkey AS ja_kodas FROM $part WHERE p_partkey % 2 = 0 UNION ALL SELECT 'p' || {_K}, 'serp', 'c:' || {_T.format("p_partkey + p_partkey % 4")}, p_partkey + p_partkey % 4 FROM $part WHERE p_partkey % 5 < 3
        UNION ALL SELECT 'p' || {_K}, 'trademark', 'c:' || {_T.format("p_partkey + 3")}, p_partkey + 3 FROM $part WHERE p_partkey % 7 = 0""",
    "premises": f"""SELECT p_partkey AS ja_kodas, CASE WHEN p_partkey % 4 < 2 THEN {_TOKEN} ELSE 'wxyz' || {_K} END AS trade_name, {_STREET} || CASE WHEN p_partkey % 9 = 4 THEN ' al. ' ELSE ' g. ' END || {_T.format(f"({_HOUSE} + (p_partkey % 3) * 2)")} || CASE WHEN p_partkey % 10 = 7 THEN 'a' ELSE '' END AS address
        FROM $part WHERE p_partkey % 6 <> 5""",
    "primary": f"SELECT 'p' || {_K} AS place_id, p_partkey + 3 AS ja_kodas FROM $part WHERE p_partkey % 14 = 0",
}


def premises_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.premises_evidence(_case(spark, sf_dir, EVIDENCE["places"]), _case(spark, sf_dir, EVIDENCE["premises"]))


def fallback_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Independent evidence and premises decide for places that the primary rules leave open: corroboration, then a strict majority."""
    r = {name: _case(spark, sf_dir, sql) for name, sql in EVIDENCE.items()}
    found = r["found"].unionByName(models.premises_evidence(r["places"], r["premises"])).distinct()
    return models.fallback_links(r["places"], found, r["entities"], r["primary"])


_PREMISES = f"""{", ".join(f"{name} AS ({duck(sql)})" for name, sql in EVIDENCE.items())},
m AS (SELECT *, regexp_extract(address, '^[^ ]+') AS s, regexp_extract(address, '^[^ ]+ ([a-z]+)', 1) AS t, regexp_extract(address, '([0-9]+a?)$', 1) AS n, count(*) OVER (PARTITION BY address) AS others FROM premises),
pl AS (SELECT *, regexp_extract(street, '^[^ ]+') AS s, regexp_extract(name, '^[^ ]+') AS token FROM places),
v AS (
  SELECT DISTINCT place_id, 'vmvt' AS source, 'c:' || CAST(ja_kodas AS VARCHAR) AS raw, ja_kodas FROM pl JOIN m ON pl.s = m.s
  WHERE m.t = 'g' AND m.n = street_number AND (others = 1 OR trade_name = token) OR m.n <> street_number AND abs(CAST(regexp_extract(m.n, '^[0-9]+') AS INT) - CAST(street_number AS INT)) <= 4 AND trade_name = token)"""
_FALLBACK_SQL = f"""WITH {_PREMISES},
f AS (SELECT * FROM found UNION SELECT * FROM v),
s AS (SELECT place_id, f.ja_kodas, list_sort(list(DISTINCT source)) AS sources FROM f JOIN entities e ON e.ja_kodas = f.ja_kodas AND is_active GROUP BY ALL),
c AS (
  SELECT s.place_id, s.ja_kodas, p.ja_kodas IS NOT NULL AS was, CASE WHEN p.ja_kodas IS NOT NULL THEN list_sort(list_append(sources, 'primary_candidate')) ELSE sources END AS sources
  FROM s JOIN entities e ON e.ja_kodas = s.ja_kodas JOIN pl ON pl.place_id = s.place_id LEFT JOIN "primary" p ON p.place_id = s.place_id AND p.ja_kodas = s.ja_kodas
  WHERE len(evrk_codes) > 0 OR registered_address = 'Vilnius, ' || street || ' ' || street_number OR p.ja_kodas IS NOT NULL OR legal_name = 'UAB ' || token),
b AS (SELECT *, max(len(sources)) OVER (PARTITION BY place_id) AS top FROM c)
SELECT place_id, 'linked' AS status, min(ja_kodas) AS ja_kodas, 'fallback:' || min(array_to_string(sources, '+')) AS method, 'MEDIUM' AS confidence, 'independent code evidence' AS reason FROM b WHERE len(sources) = top GROUP BY place_id HAVING count(*) = 1""".replace("primary AS (", '"primary" AS (')

# ---- areas ------------------------------------------------------------------------------------------------------------

BOX = (54.55, 24.95, 54.85, 25.55)
_ORDERS_AT = f"SELECT id, {BOX[0]}[[::DOUBLE||D]] + lat * 0.3[[::DOUBLE||D]] AS lat, {BOX[1]}[[::DOUBLE||D]] + lng * 0.6[[::DOUBLE||D]] AS lng FROM ({model_queries._POINTS}) p"


def haversine_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest other customer of every customer on a map."""
    return nearest(_case(spark, sf_dir, reporting.POINTS)).withColumn("metres", F.round("metres", 2))


def _cells(d: DataFrame) -> DataFrame:
    return d.select("path", F.round("lat", 6).alias("lat"), F.round("lng", 6).alias("lng"), F.round("radius_m", 3).alias("radius_m"), "depth", "n_results", "status")


def frontier_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell of the search for all orders on a map."""
    return _cells(sweep.frontier(_case(spark, sf_dir, _ORDERS_AT), BOX))


def frontier_sweep_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same under a budget of a search for every 40 orders: from the centre outward."""
    points = _case(spark, sf_dir, _ORDERS_AT)
    return _cells(sweep.frontier(points, BOX, budget=points.count() // 40))


_METRES = "2.0::DOUBLE * 6371000.0::DOUBLE * asin(sqrt(pow(sin((radians({2}) - radians({0})) / 2), 2) + cos(radians({0})) * cos(radians({2})) * pow(sin(radians({3} - {1}) / 2), 2)))"
_UP, _ASIDE = "half / 111320.0::DOUBLE", "half / (111320.0::DOUBLE * cos(radians(lat)))"
_CORNERS = ", ".join(_METRES.format("plat", "plng", f"lat {a} {_UP}", f"lng {b} {_ASIDE}") for a in "+-" for b in "+-")
_LAT0, _LNG0, _HALF0 = sweep.root_cell(BOX)
_SWEEP_CTE = f"""WITH RECURSIVE p AS MATERIALIZED ({duck(_ORDERS_AT)}),
c(path, parent, turn, lat, lng, half, depth, inside) AS (
  SELECT '', NULL::VARCHAR, [{{'m': 0.0::DOUBLE, 'p': ''}}], {_LAT0!r}::DOUBLE, {_LNG0!r}::DOUBLE, {_HALF0!r}::DOUBLE, 0, false
  UNION ALL
  SELECT path, parent, list_filter(turn, lambda e: e.m > own) || [{{'m': own, 'p': path}}], lat, lng, half, depth, greatest({_CORNERS}) < covered FROM (
    SELECT *, {_METRES.format(f"{_LAT0!r}::DOUBLE", f"{_LNG0!r}::DOUBLE", "lat", "lng")} AS own FROM (
      SELECT path || '/' || lpad(CAST(i AS VARCHAR), 2, '0') AS path, path AS parent, turn, lat AS plat, lng AS plng, covered, lat + (-half + half / k * (2 * (i // k) + 1)) / 111320.0::DOUBLE AS lat,
             lng + (-half + half / k * (2 * (i % k) + 1)) / (111320.0::DOUBLE * cos(radians(lat))) AS lng, half / k AS half, depth + 1 AS depth FROM (
        SELECT *, unnest(range(k * k)) AS i FROM (
          SELECT *, CAST(CASE WHEN covered <= 0 THEN 2 ELSE greatest(2, least(ceil(sqrt(20 / (pi() * covered * covered) * pow(2 * half, 2) / 12)), 6, greatest(2, floor(half * sqrt(2.0::DOUBLE) / 75.0::DOUBLE)))) END AS BIGINT) AS k FROM (
            SELECT path, turn, lat, lng, half, depth, count(*) AS n, least(max(seen), half * sqrt(2.0::DOUBLE)) AS covered FROM (
              SELECT *, row_number() OVER (PARTITION BY path ORDER BY d, id) AS r FROM (
                SELECT c.*, p.id, {_METRES.format("c.lat", "c.lng", "p.lat", "p.lng")} AS seen, {_METRES.format("round(c.lat, 6)", "round(c.lng, 6)", "p.lat", "p.lng")} AS d
                FROM c JOIN p ON abs(p.lat - c.lat) <= c.half * 1.5 / 111000 AND abs(p.lng - c.lng) <= c.half * 1.5 / 63000 WHERE NOT inside)
              WHERE d <= round(least(half * sqrt(2.0::DOUBLE), 50000), 1)) WHERE r <= 20 GROUP BY path, turn, lat, lng, half, depth)
          WHERE n >= 20 AND half * sqrt(2.0::DOUBLE) / 2 >= 75))))
), a AS (
  SELECT path, count(*) AS n FROM c JOIN p ON abs(p.lat - c.lat) <= c.half * 1.5 / 111000 AND abs(p.lng - c.lng) <= c.half * 1.5 / 63000
  WHERE NOT inside AND {_METRES.format("round(c.lat, 6)", "round(c.lng, 6)", "p.lat", "p.lng")} <= round(least(c.half * sqrt(2.0::DOUBLE), 50000), 1) GROUP BY path
), m AS (
  SELECT c.*, CAST(least(coalesce(n, 0), 20) AS INT) AS n, CASE WHEN inside THEN 'covered_by_parent' WHEN coalesce(n, 0) < 20 THEN 'complete' WHEN half * sqrt(2.0::DOUBLE) / 2 >= 75 THEN 'split' ELSE 'truncated' END AS status FROM c LEFT JOIN a USING (path)
)"""
_CELL = "path, round(lat, 6) AS lat, round(lng, 6) AS lng, round(half * sqrt(2.0::DOUBLE), 3) AS radius_m, depth"
_BUDGET_SQL = f"""{_SWEEP_CTE}, r AS (SELECT *, CASE WHEN NOT inside THEN row_number() OVER (PARTITION BY inside ORDER BY turn) END AS place FROM m), s AS (SELECT *, place <= (SELECT count(*) // 40 FROM p) AS reached FROM r)
SELECT {_CELL}, CASE WHEN reached THEN n ELSE 0 END AS n_results, CASE WHEN inside OR reached THEN status ELSE 'budget_exhausted' END AS status FROM s WHERE reached OR parent IS NULL OR parent IN (SELECT path FROM s WHERE reached AND status = 'split')"""

# ---- sites ------------------------------------------------------------------------------------------------------------

_SITE = "lower(regexp_extract(url, '^([A-Za-z]+://[^/?#]+)', 1))"
_LINKED = f"""SELECT page_id, url, html, {_SITE} AS site, lead(url, 1) OVER (PARTITION BY {_SITE} ORDER BY page_id) AS n1, lead(url, 2) OVER (PARTITION BY {_SITE} ORDER BY page_id) AS n2 FROM $pages"""
_PAGES = f"""SELECT page_id, url, coalesce(html, '') || '<a href="' || coalesce(n1, '/nowhere') || '">Contacts</a> <a href="/more?x=1#y">More</a>' || CASE WHEN page_id % 3 = 0 THEN '<a href=''' || coalesce(n2, '/nowhere') || '''>Privacy</a>' ELSE '' END
    || CASE WHEN page_id % 5 = 0 THEN '<A class=x HREF=/rekvizitai>here</A>' ELSE '' END AS html FROM ({_LINKED}) x"""


def site_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most four pages of every site, two links deep, over pages that have links to the next pages of their site written below them."""
    return sites.walk(_case(spark, sf_dir, _PAGES), deepest=2)


_EDGE = lambda when, target, i: f"SELECT site, split_part(url, '#', 1) AS url, {i} AS i, {target} AS target FROM l WHERE {when}"
_NEXT = lambda n: f"split_part(coalesce({n}, regexp_extract(url, '^([A-Za-z]+://[^/?#]+)', 1) || '/nowhere'), '#', 1)"
_WALK_SQL = f"""WITH l AS ({duck(_LINKED)}), known AS (SELECT split_part(url, '#', 1) AS url, min(page_id) AS page_id FROM l GROUP BY 1),
g AS ({_EDGE("true", _NEXT("n1"), 0)} UNION ALL {_EDGE("page_id % 3 = 0", _NEXT("n2"), 1)} UNION ALL {_EDGE("page_id % 5 = 0", "regexp_extract(url, '^([A-Za-z]+://[^/?#]+)', 1) || '/rekvizitai'", 2)}),
v0 AS (SELECT site, first(split_part(url, '#', 1) ORDER BY page_id) AS url, 0 AS turn, 0 AS depth FROM l GROUP BY site),
m1 AS (SELECT v0.site, target AS url, min(i) AS i FROM v0 JOIN g ON g.url = v0.url GROUP BY ALL),
v1 AS (SELECT site, url, CAST(row_number() OVER (PARTITION BY site ORDER BY i, url) AS INT) AS turn, 1 AS depth FROM m1 WHERE NOT EXISTS (SELECT 1 FROM v0 WHERE v0.site = m1.site AND v0.url = m1.url) QUALIFY turn < 4),
m2 AS (SELECT v1.site, target AS url, min({{'t': turn, 'i': i}}) AS o FROM v1 JOIN g ON g.url = v1.url GROUP BY v1.site, target),
s1 AS (SELECT * FROM v0 UNION ALL SELECT * FROM v1), t1 AS (SELECT site, max(turn) AS last FROM s1 GROUP BY site),
v2 AS (SELECT m2.site, m2.url, CAST(last + row_number() OVER (PARTITION BY m2.site ORDER BY o, m2.url) AS INT) AS turn, 2 AS depth FROM m2 JOIN t1 ON t1.site = m2.site WHERE NOT EXISTS (SELECT 1 FROM s1 WHERE s1.site = m2.site AND s1.url = m2.url) QUALIFY turn < 4)
SELECT site, x.url, page_id, turn, depth FROM (SELECT * FROM s1 UNION ALL SELECT * FROM v2) x LEFT JOIN known ON known.url = x.url"""

# ---- requests, pages of a service, refreshed evidence -----------------------------------------------------------------


def budget_work_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of all events under a budget of half as much as there are events; every fourth event's request is cached."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    e = e.withColumn("key", worklists.request_key(e, ["user_id", "event_type", "props"])).withColumn("cost", 1 + F.col("event_id") % 3)
    return worklists.work_list(e, e.where("event_id % 4 = 0"), e.count() // 2, priority="value", cost="cost")


_WORK_SQL = r"""WITH e AS (SELECT *, substr(sha256('{"event_type": "' || event_type || '", "props": "' || replace(props, '"', '\"') || '", "user_id": ' || CAST(user_id AS VARCHAR) || '}'), 1, 24) AS key FROM events),
r AS (SELECT key, max(value) AS priority, CAST(max(1 + event_id % 3) AS DOUBLE) AS cost, bool_or(event_id % 4 = 0) AS have FROM e GROUP BY key),
t AS (SELECT *, CASE WHEN NOT have THEN sum(cost) OVER (PARTITION BY have ORDER BY priority DESC NULLS LAST, key ROWS UNBOUNDED PRECEDING) END AS total FROM r)
SELECT key, priority, cost, total, CASE WHEN have THEN 'cached' WHEN total <= (SELECT count(*) // 2 FROM events) THEN 'to_fetch' ELSE 'budget_exhausted' END AS status FROM t"""


def paged_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a service's pages, of which the source takes four columns and the rows that its filters let through."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    folder = f"{shared_dir(spark)}/veinstone-pages-{uuid.uuid4().hex}"
    paged.write_pages(e.select("event_id", F.col("value").alias("amount"), F.struct(F.col("user_id").alias("id"), F.struct(F.col("event_type").alias("name")).alias("kind")).alias("user"), "props"), folder, rows=2000)
    paged.register(spark)
    rows = spark.read.format("paged_json").schema("event_id long, amount double, user__id long, user__kind__name string").load(folder)
    return rows.where("user__kind__name = 'click' AND event_id >= 100 AND amount < 50.0")


_REPLY = f"""SELECT 'p' || {_K} AS place_id, 'Alfa' || {_K} AS name, 'Alfa' || {_K} || ' rekvizitai' AS title, CASE WHEN p_partkey % 6 = 2 THEN 'nothing here' ELSE 'Įmonės kodas: ' || lpad({_T.format("p_partkey {0}")}, 9, '0') END AS desc FROM $part WHERE {{1}}
    UNION ALL SELECT 'p' || {_K}, 'Alfa' || {_K}, 'Kitas', 'kodas ' || lpad({_T.format("p_partkey {0}")}, 9, '0') FROM $part WHERE p_partkey % 2 = 0 AND {{1}}"""


def evidence_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes in cached replies after some replies changed, came and went: only these are read again."""
    cache, before = _case(spark, sf_dir, _REPLY.format("", "p_partkey % 7 <> 3")), _case(spark, sf_dir, _REPLY.format("+ CASE WHEN p_partkey % 5 = 0 THEN 1 ELSE 0 END", "p_partkey % 11 <> 4"))
    rows = staged(brands.search_codes(before), "codes")
    out, _, changed = refresh.refreshed(rows, cache, refresh.digests(before), brands.search_codes)
    return out.join(changed, "place_id", "left")


_REFRESH_SQL = f"""WITH r AS ({duck(_REPLY.format("", "p_partkey % 7 <> 3"))}), o AS ({duck(_REPLY.format("+ CASE WHEN p_partkey % 5 = 0 THEN 1 ELSE 0 END", "p_partkey % 11 <> 4"))}),
k AS (SELECT place_id, nullif(regexp_extract("desc", 'odas:? ([0-9]{{9}})', 1), '') AS code, title <> 'Kitas' AS named FROM r),
f AS (SELECT place_id, code, CAST(count(*) AS INT) AS hits, CAST(count(*) FILTER (WHERE named) AS INT) AS hits_named FROM k WHERE code IS NOT NULL GROUP BY ALL),
a AS (SELECT * FROM f UNION ALL SELECT DISTINCT place_id, NULL, 0, 0 FROM k WHERE place_id NOT IN (SELECT place_id FROM f)),
x AS (SELECT place_id, list_sort(list(title || "desc")) AS t FROM r GROUP BY 1), y AS (SELECT place_id, list_sort(list(title || "desc")) AS t FROM o GROUP BY 1)
SELECT a.*, CASE WHEN y.t IS NULL THEN 'added' WHEN x.t <> y.t THEN 'changed' END AS change FROM a JOIN x ON x.place_id = a.place_id LEFT JOIN y ON y.place_id = a.place_id"""

# ---- views over the models --------------------------------------------------------------------------------------------


def model_place_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place with its link, company and lead."""
    r = lambda name: model_queries.relation(spark, sf_dir, name)
    places = r("places").withColumns({"formatted_address": F.concat_ws(" ", "street", "street_number"), "phone": F.lit(None).cast("string"), "maps_uri": F.when(F.col("rating") > 4, F.concat(F.lit("maps/"), "place_id"))})
    out = reports.place_registry(places, r("links"), r("entities"), model_queries._leads(spark, sf_dir).select("run_month", "ja_kodas", "tier", "score"))
    return out.withColumn("score", F.round("score", 4)).drop("phone")


_REGISTRY_SQL = f"""WITH {model_queries._with("places", "entities", "links")}, ml AS ({model_queries._LEADS_SQL})
SELECT p.run_month, p.place_id, p.name, p.category, street || ' ' || street_number AS address, user_rating_count AS reviews, rating, website, CASE WHEN rating > 4 THEN 'maps/' || p.place_id ELSE '{reports.MAP_URL}' || p.place_id END AS google_maps,
       l.status AS link_status, l.method AS link_method, l.ja_kodas, legal_name, tier, score, in_scope
FROM places p LEFT JOIN links l ON l.run_month = p.run_month AND l.place_id = p.place_id LEFT JOIN entities e ON e.ja_kodas = l.ja_kodas LEFT JOIN ml ON ml.ja_kodas = l.ja_kodas"""


def model_category_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = reports.category_summary(model_queries._leads(spark, sf_dir))
    return out.withColumns({c: F.round(c, 4) for c in ("median_taxes_paid", "median_reviews_per_year")})


_SUMMARY_SQL = f"""{model_queries._LEADS_CTE},
z AS (SELECT *, CASE WHEN raw = 'A' THEN CASE WHEN row_number() OVER (PARTITION BY raw ORDER BY score DESC NULLS LAST, ja_kodas) <= 20 THEN 'A' ELSE 'B' END ELSE raw END AS tier FROM t)
SELECT '{model_queries.MONTH}' AS run_month, main_category, count(*) AS scored_entities, count(*) FILTER (WHERE tier = 'A') AS priority_a, count(*) FILTER (WHERE tier = 'B') AS watchlist,
       round(100.0::DOUBLE * count(*) FILTER (WHERE tier IN ('A', 'B')) / nullif(count(*) FILTER (WHERE tier <> 'D'), 0), 1) AS pct_flagged, round(median(dt), 4) AS median_taxes_paid, round(median(rpy), 4) AS median_reviews_per_year FROM z GROUP BY main_category"""


def similar_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different names of parts of one brand that are alike by 80 or more; tests hold it against all pairs."""
    p = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_brand", F.lower(F.concat_ws(" ", "p_name", "p_type", F.col("p_size").cast("string"))).alias("name"))
    return likeness.similar_names(p, "name", ["p_brand"], 80)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        link_cascade, link_candidates, premises_votes, fallback_votes, haversine_nearest, frontier_sweep, frontier_sweep_budget, site_walk, budget_work_list, paged_source, evidence_refresh, model_place_registry, model_category_summary, similar_names,
    )
}
ORACLES = {
    "link_cascade": _CASCADE_SQL, "link_candidates": f"WITH {_CANDIDATES} SELECT * FROM c", "premises_votes": f"WITH {_PREMISES} SELECT * FROM v".replace("primary AS (", '"primary" AS ('), "fallback_votes": _FALLBACK_SQL,
    "frontier_sweep": f"{_SWEEP_CTE} SELECT {_CELL}, n AS n_results, status FROM m", "frontier_sweep_budget": _BUDGET_SQL, "site_walk": _WALK_SQL, "budget_work_list": _WORK_SQL, "evidence_refresh": _REFRESH_SQL,
    "paged_source": "SELECT event_id, value AS amount, user_id AS user__id, event_type AS user__kind__name FROM events WHERE event_type = 'click' AND event_id >= 100 AND value < 50.0",
    "model_place_registry": _REGISTRY_SQL, "model_category_summary": _SUMMARY_SQL,
}
