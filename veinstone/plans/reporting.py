"""Data-quality checks, generic filters, formatting and geometry."""

_CHECKS = [
    ("orders_rows", "error", "SELECT CAST(count(*) AS DOUBLE) FROM $orders", ">=", 1000, "rows"),
    ("customer_rows", "error", "SELECT CAST(count(*) AS DOUBLE) FROM $customer", ">=", 100, "rows"),
    ("lineitem_rows", "error", "SELECT CAST(count(*) AS DOUBLE) FROM $lineitem", ">=", 4000, "rows"),
    ("supplier_rows", "error", "SELECT CAST(count(*) AS DOUBLE) FROM $supplier", ">=", 5, "rows"),
    ("pages_in_scope", "error", "SELECT CAST(count(*) AS DOUBLE) FROM $pages WHERE url LIKE 'http%'", ">=", 10, "pages"),
    ("events_lag", "error", "SELECT CAST(2024 * 12 + 2 - max(year(ts) * 12 + month(ts)) AS DOUBLE) FROM $events", "<=", 3, "months"),
    ("events_age", "warn", "SELECT CAST([[date_diff('day', max(CAST(ts AS DATE)), DATE '2024-03-01')||datediff(DATE '2024-03-01', max(CAST(ts AS DATE)))]] AS DOUBLE) FROM $events", "<=", 60, "days"),
    ("orders_pending", "warn", "SELECT CAST(count(*) AS DOUBLE) FROM $orders WHERE o_orderstatus = 'X'", "=", 0, "orders"),
    ("orders_truncated", "warn", "SELECT CAST(count(*) AS DOUBLE) FROM $orders WHERE o_totalprice < 0", "<=", 25, "orders"),
    ("duplicate_customers", "error", "SELECT CAST(count(*) - count(DISTINCT c_custkey) AS DOUBLE) FROM $customer", "=", 0, "customers"),
    ("balances_outside_box", "error", "SELECT CAST(count(*) AS DOUBLE) FROM $customer WHERE c_acctbal NOT BETWEEN -1000 AND 10000", "=", 0, "customers"),
    ("customers_without_orders", "warn", "SELECT 100.0[[::DOUBLE||D]] * count(*) FILTER (WHERE o_custkey IS NULL) / nullif(count(*), 0) FROM $customer LEFT JOIN (SELECT DISTINCT o_custkey FROM $orders) o ON o_custkey = c_custkey", "<=", 30, "%"),
    ("duplicate_orders", "error", "SELECT CAST(count(*) - count(DISTINCT o_orderkey) AS DOUBLE) FROM $orders", "=", 0, "orders"),
    ("orders_linked", "warn", "SELECT 100.0[[::DOUBLE||D]] * count(*) FILTER (WHERE o_orderstatus = 'F') / nullif(count(*), 0) FROM $orders", ">=", 20, "%"),
    ("links_in_conflict", "warn", "SELECT 100.0[[::DOUBLE||D]] * count(*) FILTER (WHERE quality = 0) / nullif(count(*), 0) FROM $labels", "<=", 10, "%"),
    ("orders_change", "warn", "SELECT 100.0[[::DOUBLE||D]] * abs(count(*) FILTER (WHERE CAST(year(o_orderdate) AS INT) = 2000) - count(*) FILTER (WHERE CAST(year(o_orderdate) AS INT) = 1999)) / nullif(count(*) FILTER (WHERE CAST(year(o_orderdate) AS INT) = 1999), 0) FROM $orders", "<=", 20, "%"),
    ("links_changed", "warn", "SELECT CAST(count(DISTINCT o_custkey) AS DOUBLE) FROM $orders WHERE o_orderpriority = '1-URGENT'", "<=", 25, "customers"),
    ("audited_correct", "warn", "SELECT 100.0[[::DOUBLE||D]] * sum(quality) / nullif(count(*), 0) FROM $labels", ">=", 80, "%"),
    ("revenue_missing", "warn", "SELECT CAST(max(l_tax) FILTER (WHERE l_quantity < 0) AS DOUBLE) FROM $lineitem", ">=", 50, "%"),
]

def _measured(checks: list[tuple]) -> str:
    """One row per check; all checks of a table (or of one join) come from a single aggregation over it."""
    groups: dict[str, list[tuple]] = {}
    for name, severity, sql, op, limit, unit in checks:
        value, _, rest = sql.removeprefix("SELECT ").partition(" FROM $")
        table, _, condition = rest.partition(" WHERE ") if " JOIN " not in rest else (rest, "", "")
        value = value.replace("count(*)", f"count(*) FILTER (WHERE {condition})") if condition and "max(" not in value else value
        groups.setdefault(table, []).append((name, severity, value, op, limit, unit))
    parts = []
    for table, own in groups.items():
        values = ", ".join(f"{value} AS v{k}" for k, (_, _, value, *_) in enumerate(own))
        fields = [("check_name", "'{0}'", 0), ("severity", "'{0}'", 1), ("op", "'{0}'", 3), ("threshold", "{0}.0[[::DOUBLE||D]]", 4), ("unit", "'{0}'", 5)]
        rows = ", ".join("[[struct_pack(||named_struct(]]" + f"[[observed_value := v{k}||'observed_value', v{k}]]" + "".join(f", [[{f} := ||'{f}', ]]" + text.format(check[at]) for f, text, at in fields) + ")" for k, check in enumerate(own))
        parts.append(f"SELECT r.* FROM (SELECT [[unnest([||explode(array(]]{rows}[[])||))]] AS r FROM (SELECT {values} FROM ${table}) v) x")
    return " UNION ALL ".join(parts)


_ROWS = _measured(_CHECKS)

#: Customers as points on a map; some share a place.
POINTS = """SELECT c_custkey AS id, CASE WHEN c_custkey % 40 = 7 THEN 54.61[[::DOUBLE||D]] + (c_custkey % 80) / 1000.0[[::DOUBLE||D]] ELSE 54.5[[::DOUBLE||D]] + (c_acctbal + 1000) / 11000 * 0.3[[::DOUBLE||D]] END AS lat,
        CASE WHEN c_custkey % 40 = 7 THEN 25.1[[::DOUBLE||D]] ELSE 24.9[[::DOUBLE||D]] + (c_custkey * 7919 % 10007) / 10007.0[[::DOUBLE||D]] * 0.6[[::DOUBLE||D]] END AS lng FROM $customer"""

TEMPLATES = {
    "dq_suite": f"""
        WITH c AS ({_ROWS})
        SELECT check_name, severity, CASE op WHEN '>=' THEN observed_value >= threshold WHEN '<=' THEN observed_value <= threshold ELSE observed_value = threshold END AS passed,
               CASE WHEN observed_value IS NULL THEN 'n/a' WHEN unit = '%' THEN [[format('{{:,.1f}}', observed_value)||format_number(observed_value, 1)]] || ' %' ELSE [[format('{{:,}}', CAST(round(observed_value) AS BIGINT))||format_number(round(observed_value), 0)]] || ' ' || CASE WHEN round(observed_value) = 1 THEN [[rtrim(unit, 's')||trim(TRAILING 's' FROM unit)]] ELSE unit END END AS observed,
               CASE op WHEN '>=' THEN 'at least ' WHEN '<=' THEN 'at most ' ELSE 'exactly ' END || [[format('{{:,}}', CAST(threshold AS BIGINT))||format_number(threshold, 0)]] || ' ' || unit AS expected FROM c""",
    # Runs as a DataFrame on Spark (plans/engine_queries.py): here all pairs, for comparison.
    "haversine_nearest": f"""
        WITH n AS ({POINTS}),
        d AS (SELECT a.id, b.id AS other, 2.0::DOUBLE * 6371000.0::DOUBLE * asin(sqrt(pow(sin((radians(b.lat) - radians(a.lat)) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lng - a.lng) / 2), 2))) AS metres FROM n a JOIN n b ON a.id <> b.id),
        r AS (SELECT id, min({{'metres': metres, 'other': other}}) AS m FROM d GROUP BY id)
        SELECT id, m.other AS nearest, round(m.metres, 2) AS metres FROM r""",
    "filter_builder_contains": """
        SELECT c_custkey, c_name, c_mktsegment FROM $customer WHERE lower(CAST(c_mktsegment AS [[VARCHAR||STRING]])) LIKE '%build%' AND c_acctbal >= 100 AND c_nationkey IN (1, 3, 5, 7) ORDER BY c_custkey LIMIT 200""",
    "timestamp_format": """
        SELECT event_id, [[strftime(ts, '%Y-%m-%d %H:%M')||date_format(ts, 'yyyy-MM-dd HH:mm')]] AS at, trim(upper(substr(event_type, 1, 3))) || '-' || replace(event_type, 'c', 'k') AS code, CAST(length(event_type) AS INT) AS n FROM $events""",
}
