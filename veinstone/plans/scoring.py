"""Peer comparison: thresholds, quintiles, hierarchical medians, gaps, signals, tiers and ranks.

What needs quintiles, medians, percentiles or ranks runs as DataFrame code on Spark (plans/programmatic.py), where no
task holds a whole group; here is its SQL for DuckDB.
"""


def _rounded(x: str, digits: int) -> str:
    """Spark rounds the shortest decimal that stands for a double, DuckDB the double times a power of ten; as halves go apart in these, and ranks with them, Spark is told to do the latter."""
    return f"[[round({x}, {digits})||round({x} * 1e{digits}) / 1e{digits}]]"


#: Gap of an entity's declared figure to its peers' median; shared by the queries that rank and tier.
BASE = f"""
  visible AS (SELECT o_custkey, sum(o_totalprice) / greatest(1.0[[::DOUBLE||D]], least(7.0[[::DOUBLE||D]], [[date_diff('day', min(CAST(o_orderdate AS DATE)), DATE '2001-09-01')||datediff(DATE '2001-09-01', min(CAST(o_orderdate AS DATE)))]] / 365.25[[::DOUBLE||D]])) AS activity FROM $orders GROUP BY o_custkey),
  last AS (SELECT max(CAST(year(l_shipdate) AS INT)) - 1 AS y FROM $lineitem),
  declared AS (SELECT o_custkey, sum(l_extendedprice * (1 - l_discount) * l_tax) AS declared FROM $lineitem JOIN $orders ON l_orderkey = o_orderkey CROSS JOIN last WHERE CAST(year(l_shipdate) AS INT) = y GROUP BY o_custkey),
  base AS (SELECT c_custkey, c_mktsegment AS category, c_nationkey, {_rounded('activity', 4)} AS activity, {_rounded('declared', 4)} AS declared FROM $customer JOIN visible v ON v.o_custkey = c_custkey LEFT JOIN declared d ON d.o_custkey = c_custkey)"""

_SCORED = BASE + """,
  ranked AS (SELECT *, CAST(ntile(5) OVER (PARTITION BY category ORDER BY activity, c_custkey) AS INT) AS quintile FROM base),
  peers AS (SELECT category, quintile, median(declared) AS m FROM ranked GROUP BY category, quintile),
  scored AS (SELECT r.*, CASE WHEN (m + 1) / (declared + 1) > 0 THEN round(ln((m + 1) / (declared + 1)), 6) END AS gap FROM ranked r JOIN peers p ON r.category = p.category AND r.quintile = p.quintile)"""

_TIERED = _SCORED + """,
  tiered AS (SELECT *, CASE WHEN declared IS NULL THEN 'D' WHEN quintile <= 2 THEN 'C' WHEN gap > 0.2 THEN 'A' ELSE 'B' END AS tier_raw FROM scored)"""

_CAPPED = _TIERED + """,
  capped AS (SELECT *, CASE WHEN tier_raw = 'A' AND row_number() OVER (PARTITION BY tier_raw ORDER BY gap DESC NULLS LAST, c_custkey) > 20 THEN 'B' ELSE tier_raw END AS tier FROM tiered)"""

TEMPLATES = {
    # Flagship: visible activity against the peers' median of the declared figure.
    "peer_gap_topk": f"WITH {_SCORED} SELECT c_custkey, category, quintile, activity, declared, gap FROM scored ORDER BY gap DESC NULLS LAST, c_custkey LIMIT 20",
    "activity_ntile": f"WITH {_SCORED} SELECT c_custkey, category, quintile FROM scored",
    "busy_quantile_flag": """
        WITH q AS (SELECT o_orderpriority, round([[quantile_cont(o_totalprice, 0.6)||percentile(o_totalprice, 0.6)]], 4) AS p60, round([[quantile_cont(o_totalprice, 0.8)||percentile(o_totalprice, 0.8)]], 4) AS p80 FROM $orders GROUP BY o_orderpriority)
        SELECT o_orderkey, p60, p80, o_totalprice >= CASE WHEN o_orderstatus = 'P' THEN p80 ELSE p60 END AS busy FROM $orders o JOIN q ON o.o_orderpriority = q.o_orderpriority""",
    "peer_medians_grouping_sets": """
        SELECT c_mktsegment, c_nationkey, c_custkey % 3 AS form, CAST(3 - grouping(c_nationkey) - grouping(c_custkey % 3) AS INT) AS lvl, count(*) AS n, round(median(c_acctbal), 4) AS med
        FROM $customer GROUP BY GROUPING SETS ((c_mktsegment, c_nationkey, c_custkey % 3), (c_mktsegment, c_nationkey), (c_mktsegment))""",
    "peer_level_fallback": """
        WITH c AS (SELECT c_custkey, c_mktsegment AS cat, c_nationkey AS q, c_custkey % 3 AS f, c_acctbal AS v FROM $customer),
        m3 AS (SELECT cat, q, f, median(v) AS m FROM c GROUP BY cat, q, f HAVING count(*) >= 8), m2 AS (SELECT cat, q, median(v) AS m FROM c GROUP BY cat, q HAVING count(*) >= 8), m1 AS (SELECT cat, median(v) AS m FROM c GROUP BY cat HAVING count(*) >= 8)
        SELECT c_custkey, CASE WHEN m3.m IS NOT NULL THEN 3 WHEN m2.m IS NOT NULL THEN 2 WHEN m1.m IS NOT NULL THEN 1 END AS peer_level, round(coalesce(m3.m, m2.m, m1.m), 4) AS peer_median
        FROM c LEFT JOIN m3 ON c.cat = m3.cat AND c.q = m3.q AND c.f = m3.f LEFT JOIN m2 ON c.cat = m2.cat AND c.q = m2.q LEFT JOIN m1 ON c.cat = m1.cat""",
    "renormalised_score": """
        WITH g AS (SELECT o_custkey, CASE WHEN sum(l_tax) > 0 THEN ln(sum(l_quantity) / 10 + 1) END AS g1, CASE WHEN max(l_discount) > 0.05 THEN ln(sum(l_discount) + 1) END AS g2, CASE WHEN count(*) > 20 THEN ln(count(*)) END AS g3
                   FROM $lineitem JOIN $orders ON l_orderkey = o_orderkey GROUP BY o_custkey)
        SELECT o_custkey, round((coalesce(0.5[[::DOUBLE||D]] * g1, 0) + coalesce(0.3[[::DOUBLE||D]] * g2, 0) + coalesce(0.2[[::DOUBLE||D]] * g3, 0)) / nullif(CASE WHEN g1 IS NULL THEN 0.0[[::DOUBLE||D]] ELSE 0.5[[::DOUBLE||D]] END + CASE WHEN g2 IS NULL THEN 0.0[[::DOUBLE||D]] ELSE 0.3[[::DOUBLE||D]] END + CASE WHEN g3 IS NULL THEN 0.0[[::DOUBLE||D]] ELSE 0.2[[::DOUBLE||D]] END, 0), 6) AS score FROM g""",
    "clamped_ratios": """
        SELECT o_custkey, round(sum(o_totalprice) / greatest(coalesce(sum(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END), 0), 1000.0[[::DOUBLE||D]]), 6) AS ratio,
               round(100.0[[::DOUBLE||D]] * count(*) FILTER (WHERE o_orderstatus = 'F') / nullif(count(*), 0), 4) AS pct_f FROM $orders GROUP BY o_custkey""",
    "signal_count": """
        SELECT o_orderkey, CAST(o_totalprice < 50000 AS INT) + CAST(o_orderstatus = 'F' AS INT) + CAST(o_orderpriority LIKE '1%' AS INT) AS n_signals FROM $orders""",
    "hold_reason_case": f"""WITH {_SCORED}
        SELECT c_custkey, CASE WHEN declared IS NULL THEN 'no declared figure' WHEN quintile = 1 THEN 'not busy' WHEN gap IS NULL THEN 'no gap' WHEN gap < -0.5 THEN 'declares more than peers' WHEN gap < 0.1 THEN 'like peers' WHEN c_nationkey IN (1, 2) THEN 'out of scope' END AS hold_reason FROM scored""",
    "tier_case_capped": f"WITH {_CAPPED} SELECT c_custkey, tier_raw, tier, CASE tier WHEN 'A' THEN 0 WHEN 'B' THEN 1 WHEN 'C' THEN 2 ELSE 3 END AS bucket FROM capped",
    "priority_rank": f"""WITH {_CAPPED}
        SELECT c_custkey, tier, CAST(rank() OVER (ORDER BY CASE tier WHEN 'A' THEN 0 WHEN 'B' THEN 1 WHEN 'C' THEN 2 ELSE 3 END, gap DESC NULLS LAST) AS INT) AS priority_rank FROM capped""",
    "unscored_anti_join": f"""WITH {_SCORED}
        SELECT c_custkey, 'D' AS tier, 'too few comparable peers' AS reason, CAST(NULL AS DOUBLE) AS gap FROM $customer c WHERE NOT EXISTS (SELECT 1 FROM scored s WHERE s.c_custkey = c.c_custkey AND s.gap IS NOT NULL)
        UNION ALL SELECT c_custkey, CASE WHEN gap > 0.2 THEN 'A' ELSE 'B' END, NULL, gap FROM scored WHERE gap IS NOT NULL""",
    "category_summary": f"""WITH {_CAPPED}
        SELECT category, count(*) AS n, count(*) FILTER (WHERE tier = 'A') AS n_a, round(100.0[[::DOUBLE||D]] * count(*) FILTER (WHERE declared IS NOT NULL) / nullif(count(*), 0), 4) AS pct_declared, round(median(activity), 4) AS median_activity, round(median(gap), 6) AS median_gap FROM capped GROUP BY category""",
    "confidence_weakest": """
        SELECT o_custkey, CASE max(CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 ELSE 4 END) WHEN 1 THEN 'URGENT' WHEN 2 THEN 'HIGH' WHEN 3 THEN 'MEDIUM' ELSE 'LOW' END AS weakest FROM $orders GROUP BY o_custkey""",
    "coverage_by_category": """
        SELECT c_mktsegment, count(DISTINCT c_custkey) AS entities, count(o_orderkey) AS places, round(100.0[[::DOUBLE||D]] * count(o_orderkey) FILTER (WHERE o_orderstatus = 'F') / nullif(count(o_orderkey), 0), 4) AS pct_linked, round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F') / nullif(sum(o_totalprice), 0), 6) AS reviews_covered
        FROM $customer LEFT JOIN $orders ON o_custkey = c_custkey GROUP BY c_mktsegment""",
}
