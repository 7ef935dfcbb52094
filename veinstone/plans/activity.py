"""Visible and declared activity of entities: aggregates, trailing windows, latest attributes, history.

Stand-ins: customer is an entity, an order a listing with o_totalprice as its popularity, line items are yearly
declared figures, events monthly ones; an order's month is its snapshot.
"""

TEMPLATES = {
    # Aggregates over the listings of an entity.
    "entity_visible_activity": """
        SELECT o_custkey, count(*) AS n_places, round(sum(o_totalprice), 2) AS reviews_total, round(max(coalesce(o_totalprice, 0)), 2) AS reviews_max,
               bool_and(o_orderstatus <> 'P') AS all_usable, bool_or(o_orderpriority = '1-URGENT') AS any_fits
        FROM $orders JOIN $customer ON o_custkey = c_custkey GROUP BY o_custkey""",
    "main_category_argmax": """
        SELECT o_custkey, max_by(o_orderpriority, [[struct_pack(p := o_totalprice, k := o_orderkey)||struct(o_totalprice, o_orderkey)]]) AS main_category FROM $orders GROUP BY o_custkey""",
    "ordered_list_agg": """
        WITH l AS (
          SELECT o_custkey, [[list(o_orderkey ORDER BY o_totalprice DESC, o_orderkey)||transform(array_sort(collect_list(struct(-o_totalprice AS p, o_orderkey AS k))), z -> z.k)]] AS place_ids,
                 [[list_sort(list(DISTINCT o_orderstatus))||sort_array(collect_set(o_orderstatus))]] AS statuses
          FROM $orders GROUP BY o_custkey)
        SELECT l.o_custkey, [[array_to_string(place_ids, '+')||array_join(place_ids, '+')]] AS place_ids, [[array_to_string(statuses, '+')||array_join(statuses, '+')]] AS statuses,
               o.o_orderpriority AS busiest_priority, [[list_contains(statuses, 'F')||array_contains(statuses, 'F')]] AS has_f
        FROM l JOIN $orders o ON o.o_orderkey = [[place_ids[1]||element_at(place_ids, 1)]]""",
    "weighted_rating": """
        SELECT l_suppkey, round(sum(l_discount * l_quantity) / nullif(sum(l_quantity), 0), 4) AS rating_weighted,
               round(sum(CASE WHEN l_tax = 0 THEN l_discount * l_quantity END) / nullif(sum(CASE WHEN l_tax = 0 THEN l_quantity END), 0), 4) AS rating_untaxed
        FROM $lineitem GROUP BY l_suppkey""",
    "declared_calendar_mean": """
        SELECT user_id, round(sum(value) / 12.0[[::DOUBLE||D]], 4) AS avg_calendar, count(DISTINCT date_trunc('day', ts)) AS days FROM $events
        WHERE CAST(year(ts) AS INT) = 2024 GROUP BY user_id""",
    "trailing_window_sum": """
        WITH p AS (SELECT max(CAST(ts AS DATE)) AS last_day FROM $events)
        SELECT user_id, round(sum(value), 4) AS trailing FROM $events CROSS JOIN p
        WHERE CAST(ts AS DATE) > CAST(last_day - INTERVAL 12 DAY AS DATE) GROUP BY user_id""",
    "prev_year_filter_agg": """
        WITH y AS (SELECT max(CAST(year(l_shipdate) AS INT)) AS current_year FROM $lineitem)
        SELECT o_custkey, round(sum(l_extendedprice) FILTER (WHERE CAST(year(l_shipdate) AS INT) = current_year - 1), 2) AS prev_year,
               round(sum(l_extendedprice) FILTER (WHERE CAST(year(l_shipdate) AS INT) = current_year - 2), 2) AS prev_year_2,
               coalesce(bool_or(CAST(year(l_shipdate) AS INT) = current_year - 1), false) AS has_prev_year,
               count(*) FILTER (WHERE CAST(year(l_shipdate) AS INT) = current_year) AS rows_current
        FROM $lineitem JOIN $orders ON l_orderkey = o_orderkey CROSS JOIN y GROUP BY o_custkey""",
    "last_reported_argmax_filtered": """
        WITH f AS (SELECT o_custkey, CAST(year(l_shipdate) AS INT) AS y, CASE WHEN max(l_quantity) > 20 THEN round(sum(l_extendedprice), 2) END AS v
                   FROM $lineitem JOIN $orders ON l_orderkey = o_orderkey GROUP BY o_custkey, CAST(year(l_shipdate) AS INT)),
        c AS (SELECT max(y) AS current_year FROM f)
        SELECT o_custkey, max_by(v, y) FILTER (WHERE y < current_year AND v IS NOT NULL) AS last_reported, max(y) FILTER (WHERE y < current_year AND v IS NOT NULL) AS last_year,
               [[any_value(current_year)||any_value(current_year, true)]] AS current_year
        FROM f CROSS JOIN c GROUP BY o_custkey""",
    "semi_join_reduction": """
        SELECT user_id, count(*) AS n, round(sum(value), 4) AS total FROM $events
        WHERE user_id IN (SELECT c_custkey FROM $customer WHERE c_acctbal > 0) GROUP BY user_id""",
    "years_active_clamp": """
        SELECT c_custkey, round(greatest(1.0[[::DOUBLE||D]], least(7.0[[::DOUBLE||D]], coalesce([[date_diff('day', min(CAST(o_orderdate AS DATE)), DATE '2001-09-01')||datediff(DATE '2001-09-01', min(CAST(o_orderdate AS DATE)))]] / 365.25[[::DOUBLE||D]], 7.0[[::DOUBLE||D]]))), 6) AS years_active
        FROM $customer LEFT JOIN $orders ON o_custkey = c_custkey GROUP BY c_custkey""",
    "month_boundary_age": """
        SELECT o_orderkey, CAST([[date_diff('month', CAST(o_orderdate AS DATE), make_date(2001, 9, 1))||(2001 * 12 + 9) - (year(o_orderdate) * 12 + month(o_orderdate))]] AS BIGINT) AS age_months,
               CAST(o_orderdate AS DATE) > CAST(make_date(2001, 9, 1) - INTERVAL 12 MONTH AS DATE) AS is_new FROM $orders""",
    "latest_attr_argmax_nonnull": """
        WITH e AS (SELECT user_id, ts, event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type END AS attr FROM $events)
        SELECT user_id, max_by(attr, [[struct_pack(a := ts, b := event_id)||struct(ts, event_id)]]) FILTER (WHERE attr IS NOT NULL) AS latest, min(attr) AS any_attr FROM e GROUP BY user_id""",
    "list_distinct_codes": """
        WITH a AS (SELECT user_id, [[list_sort(list(DISTINCT event_type) FILTER (WHERE value > 0))||sort_array(collect_set(event_type) FILTER (WHERE value > 0))]] AS x,
                          [[list_sort(list(DISTINCT upper(event_type)) FILTER (WHERE event_id % 7 = 0))||sort_array(collect_set(upper(event_type)) FILTER (WHERE event_id % 7 = 0))]] AS y FROM $events GROUP BY user_id)
        SELECT user_id, [[array_to_string(list_sort(list_distinct(list_concat(coalesce(x, []), coalesce(y, [])))), ',')||array_join(array_sort(array_distinct(concat(coalesce(x, array()), coalesce(y, array())))), ',')]] AS codes,
               CAST([[len(list_filter(list_concat(coalesce(x, []), coalesce(y, [])), lambda c: length(c) > 5))||size(filter(concat(coalesce(x, array()), coalesce(y, array())), c -> length(c) > 5))]] AS BIGINT) AS long_codes FROM a""",
    "distinct_filtered_counts": """
        SELECT o_custkey, count(DISTINCT o_orderpriority) AS priorities, count(DISTINCT o_orderpriority) FILTER (WHERE o_orderstatus = 'F') AS priorities_f,
               count(DISTINCT substr(o_orderpriority, 1, 1) || o_orderstatus) AS pairs, count(*) FILTER (WHERE o_totalprice > 100000) AS big FROM $orders GROUP BY o_custkey""",
    "entity_state_flags": """
        WITH f AS (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS registered, max(CAST(o_orderdate AS DATE)) FILTER (WHERE o_orderstatus = 'P') AS deregistered FROM $orders GROUP BY o_custkey)
        SELECT c_custkey, c_nationkey NOT IN (5, 6, 7, 9) AND c_mktsegment NOT IN ('MACHINERY') AS is_active, c_mktsegment IN ('BUILDING', 'HOUSEHOLD') AS owner_operated,
               coalesce(lower(c_name) LIKE 'customer#00000%' OR c_nationkey = 3, false) AS nexus,
               registered IS NOT NULL AND (deregistered IS NULL OR deregistered < registered) AS vat_registered, deregistered IS NULL OR deregistered >= DATE '2001-01-01' AS is_current
        FROM $customer LEFT JOIN f ON o_custkey = c_custkey""",
    # Snapshots and their history.
    "snapshot_lag_history": """
        WITH m AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS run_month, count(*) AS n, round(sum(o_totalprice), 2) AS total, min(o_orderstatus) AS tier FROM $orders GROUP BY 1, 2),
        h AS (SELECT *, lag(n) OVER w AS prev_n, lag(total) OVER w AS prev_total, lag(tier) OVER w AS prev_tier FROM m WINDOW w AS (PARTITION BY o_custkey ORDER BY run_month))
        SELECT o_custkey, run_month, n, total, prev_total, CASE WHEN prev_n IS NULL THEN 'new' WHEN tier IS DISTINCT FROM prev_tier THEN 'tier_changed' WHEN total IS DISTINCT FROM prev_total THEN 'changed' ELSE 'same' END AS change,
               CASE WHEN prev_n IS NULL THEN NULL WHEN n <> prev_n THEN 'visible activity changed' WHEN total NOT BETWEEN prev_total - 1 AND prev_total + 1 THEN 'declared figures changed' END AS reason FROM h""",
    "months_flagged_running": """
        WITH m AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS run_month, max(o_totalprice) > 150000 AS flagged FROM $orders GROUP BY 1, 2)
        SELECT o_custkey, run_month, flagged, count(CASE WHEN flagged THEN 1 END) OVER (PARTITION BY o_custkey ORDER BY run_month ROWS UNBOUNDED PRECEDING) AS months_flagged FROM m""",
    "first_flagged_month": """
        WITH m AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS run_month, max(o_totalprice) > 150000 AS flagged FROM $orders GROUP BY 1, 2)
        SELECT o_custkey, run_month, min(CASE WHEN flagged THEN run_month END) OVER (PARTITION BY o_custkey) AS first_flagged FROM m""",
    "place_registry": """
        WITH s AS (SELECT DISTINCT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS run_month FROM $orders)
        SELECT o_custkey, min(run_month) AS first_seen, max(run_month) AS last_seen, count(*) AS months_seen FROM s GROUP BY o_custkey""",
    "prev_snapshot_relinked": """
        WITH s AS (SELECT o_custkey, CAST(year(o_orderdate) AS INT) AS y, max_by(o_orderpriority, [[struct_pack(a := o_orderdate, b := o_orderkey)||struct(o_orderdate, o_orderkey)]]) AS link FROM $orders GROUP BY 1, 2),
        m AS (SELECT max(y) AS y FROM s), p AS (SELECT s.* FROM s WHERE y = (SELECT max(s2.y) FROM s s2 CROSS JOIN m WHERE s2.y < m.y))
        SELECT s.o_custkey, s.link, p.link AS prev_link, coalesce(s.link <> p.link, false) AS relinked FROM s JOIN m ON s.y = m.y LEFT JOIN p ON p.o_custkey = s.o_custkey""",
    "union_by_name_backfill": """
        SELECT o_custkey AS id, o_orderstatus AS status, CAST(NULL AS [[VARCHAR||STRING]]) AS segment, 'order' AS kind FROM $orders
        UNION ALL SELECT c_custkey, NULL, c_mktsegment, 'customer' FROM $customer""",
}
