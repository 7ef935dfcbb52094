"""Record linkage: normalised keys, candidate joins, the rule cascade, evidence votes, validation, overrides."""

#: Core of a part's name: small letters, generic words out, single spaces.
_KEY = "trim(regexp_replace(regexp_replace(lower({0}), '[^0-9a-z]+', ' '[[, 'g'||]]), '(^| )(uab|mb|ltd|inc|part|the)( |$)', ' '[[, 'g'||]]))"

TEMPLATES = {
    "exact_key_join": f"""
        WITH p AS (SELECT p_partkey, {_KEY.format("p_name")} AS k FROM $part), n AS (SELECT k, count(*) AS n, min(p_partkey) AS first_id FROM p GROUP BY k)
        SELECT p.p_partkey, p.k AS exact_key, n.n AS n_same, CASE WHEN n.n = 1 THEN 'exact_name' WHEN n.n <= 5 THEN 'ambiguous' ELSE 'generic' END AS outcome, n.first_id FROM p JOIN n ON p.k = n.k""",
    "core_key_variants": f"""
        WITH v AS (SELECT p_partkey, [[string_split(p_name, ' ')||split(p_name, ' ')]] AS parts FROM $part),
        e AS (SELECT p_partkey, pos, {_KEY.format("word")} AS k FROM (SELECT p_partkey, [[unnest(range(len(parts))) AS pos, unnest(parts) AS word FROM v||pos, word FROM v LATERAL VIEW posexplode(parts) x AS pos, word]]) z)
        SELECT k AS core_key, count(*) FILTER (WHERE pos = 0) AS as_core, count(*) FILTER (WHERE pos > 0) AS as_part, count(DISTINCT p_partkey) AS entities FROM e WHERE length(k) >= 3 GROUP BY k""",
    "address_key_hotspot": """
        WITH a AS (SELECT s_suppkey, regexp_extract(s_name, '([A-Za-z]+)', 1) || '|' || n_name || '|' || CAST(s_suppkey % 7 AS [[VARCHAR||STRING]]) AS address_key FROM $supplier JOIN $nation ON s_nationkey = n_nationkey)
        SELECT s_suppkey, address_key, count(*) OVER (PARTITION BY address_key) AS at_address, count(*) OVER (PARTITION BY address_key) > 2 AS hotspot FROM a""",
    "link_cascade_case": """
        WITH c AS (SELECT c_custkey, c_mktsegment, count(o_orderkey) FILTER (WHERE o_orderpriority = '1-URGENT') AS n1, count(o_orderkey) FILTER (WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F') AS n1_addr,
                          count(o_orderkey) FILTER (WHERE o_orderpriority = '2-HIGH') AS n2, count(o_orderkey) FILTER (WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'O') AS n2_evrk, count(o_orderkey) FILTER (WHERE o_orderpriority = '5-LOW') AS n4
                   FROM $customer LEFT JOIN $orders ON o_custkey = c_custkey GROUP BY c_custkey, c_mktsegment)
        SELECT c_custkey, CASE WHEN n1 = 1 AND n1_addr = 1 THEN 'exact_name' WHEN n1 = 1 THEN 'ambiguous' WHEN n1 > 1 AND n1_addr = 1 THEN 'exact_name+address' WHEN n1 > 1 THEN 'ambiguous'
                               WHEN n2 > 0 AND n2_evrk = 1 THEN 'core_name+activity' WHEN n2 > 0 THEN 'ambiguous' WHEN n4 = 1 THEN 'address_only' WHEN n4 > 1 THEN 'ambiguous' ELSE 'unmatched' END AS method,
               CASE WHEN n1 > 0 AND n1_addr = 1 THEN 'HIGH' WHEN n1 = 0 AND (n2_evrk = 1 OR n2 = 0 AND n4 = 1) THEN 'MEDIUM' END AS confidence FROM c""",
    "token_document_frequency": """
        WITH t AS (SELECT DISTINCT p_partkey, [[unnest(string_split(lower(p_name), ' '))||explode(split(lower(p_name), ' '))]] AS token FROM $part)
        SELECT token, count(*) AS df, count(*) <= 8 AS distinctive FROM t GROUP BY token""",
    "band_join_house_number": """
        WITH h AS (SELECT o_orderkey, o_custkey AS street, CAST(o_orderkey % 97 AS INT) AS house, floor((o_orderkey % 97) / 5[[.0)||D)]] AS cell FROM $orders),
        b AS (SELECT *, cell + d AS near FROM h CROSS JOIN (SELECT -1 AS d UNION ALL SELECT 0 UNION ALL SELECT 1) z)
        SELECT a.o_orderkey AS a, b.o_orderkey AS b, abs(a.house - b.house) AS gap FROM h a JOIN b ON a.street = b.street AND a.cell = b.near AND abs(a.house - b.house) <= 4 AND a.house <> b.house AND a.o_orderkey < b.o_orderkey""",
    "evidence_vote_majority": """
        WITH s AS (SELECT user_id, CAST(event_id % 4 AS INT) AS entity, count(DISTINCT event_type) AS sources FROM $events GROUP BY 1, 2),
        r AS (SELECT *, max(sources) OVER (PARTITION BY user_id) AS top FROM s), n AS (SELECT user_id, max(top) AS top, count(*) FILTER (WHERE sources = top) AS winners, min(entity) FILTER (WHERE sources = top) AS entity, count(*) AS candidates FROM r GROUP BY user_id)
        SELECT user_id, top AS support, CASE WHEN winners = 1 THEN entity END AS linked, CASE WHEN candidates = 1 THEN 'unique' WHEN winners = 1 THEN 'majority' ELSE 'tie' END AS outcome FROM n""",
    "verdict_confirm_conflict": """
        WITH v AS (SELECT user_id, event_type, bool_or(event_id % 5 = user_id % 5) AS own, bool_or(event_id % 5 <> user_id % 5) AS other FROM $events GROUP BY 1, 2),
        w AS (SELECT user_id, event_type, CASE WHEN own THEN 'confirms' WHEN other THEN 'conflicts' ELSE 'silent' END AS verdict FROM v)
        SELECT user_id, count(*) FILTER (WHERE verdict = 'confirms') AS confirms, count(*) FILTER (WHERE verdict = 'conflicts') AS conflicts, [[string_agg(concat(event_type, ':', verdict), ', ' ORDER BY event_type)||listagg(concat(event_type, ':', verdict), ', ') WITHIN GROUP (ORDER BY event_type)]] AS detail
        FROM w JOIN $customer ON c_custkey = user_id GROUP BY user_id""",
    "policy_page_preference": """
        WITH h AS (SELECT page_id, regexp_extract(url, '://([^/]+)', 1) AS host, [[regexp_matches(url, '/(en|privacy)/')||url RLIKE '/(en|privacy)/']] AS policy FROM $pages),
        m AS (SELECT *, bool_or(policy) OVER (PARTITION BY host) AS has_policy FROM h)
        SELECT page_id, host, policy FROM m WHERE policy OR NOT has_policy""",
    "override_apply": """
        WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'set' WHEN o_orderkey % 11 = 0 THEN 'reject' END AS action FROM $orders WHERE o_orderkey % 7 = 0 OR o_orderkey % 11 = 0)
        SELECT l.o_orderkey, CASE o.action WHEN 'set' THEN l.o_custkey + 1 WHEN 'reject' THEN NULL ELSE l.o_custkey END AS entity, CASE WHEN o.action IS NULL THEN l.o_orderpriority ELSE 'override' END AS method, CASE o.action WHEN 'set' THEN 'HIGH' WHEN 'reject' THEN 'ambiguous' ELSE l.o_orderstatus END AS status
        FROM $orders l LEFT JOIN o ON l.o_orderkey = o.o_orderkey""",
    "validation_status_case": """
        WITH e AS (SELECT user_id, count(*) AS n, count(*) FILTER (WHERE event_type = 'click') AS confirms, count(*) FILTER (WHERE event_type = 'purchase') AS conflicts, max(event_type) AS method,
                          [[len(list_filter(string_split(concat(max(event_type), '+a'), '+'), lambda x: x <> 'a'))||size(filter(split(concat(max(event_type), '+a'), '[+]'), x -> x <> 'a'))]] AS families FROM $events GROUP BY user_id)
        SELECT user_id, CASE WHEN user_id % 13 = 0 THEN 'override' WHEN quality = 0 THEN 'rejected_by_audit' WHEN quality = 1 THEN 'confirmed_by_audit' WHEN conflicts > confirms THEN 'conflict' WHEN confirms >= 20 THEN 'confirmed'
                             WHEN families >= 2 THEN 'confirmed_families' WHEN method LIKE 'b%' THEN 'brand_level_only' WHEN [[regexp_full_match(method, '(view|signup)')||method RLIKE '^(view|signup)$']] THEN 'single_source' WHEN lower(method) LIKE '%e%' THEN 'brand_site_code' ELSE 'unverified' END AS validation_status
        FROM e LEFT JOIN $labels ON doc_id = user_id""",
    "usable_flag": """
        WITH e AS (SELECT user_id, count(DISTINCT event_type) AS families, sum(value) > 100 AS activity_fits, max(value) > 90 AS address_agrees, min(event_type) AS method FROM $events GROUP BY user_id)
        SELECT user_id, coalesce(user_id % 17 <> 0 AND coalesce(quality, 1) <> 0 AND (families >= 4 OR (method = 'click' AND (activity_fits OR address_agrees)) OR (families = 1 AND activity_fits AND method IN ('view', 'purchase'))), false) AS usable FROM e LEFT JOIN $labels ON doc_id = user_id""",
    "shared_domain_having": """
        WITH d AS (SELECT regexp_extract(url, '://(?:www[.])?([^/]+)', 1) AS domain, regexp_extract(url, '://[^/]+(/[^?#]*)', 1) AS path FROM $pages)
        SELECT domain, count(DISTINCT path) AS paths, count(*) AS pages FROM d GROUP BY domain HAVING count(DISTINCT path) >= 3""",
    "stratified_hash_sample": """
        WITH r AS (SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '1%' THEN 'exact' WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM') THEN 'core' ELSE 'other' END AS stratum, md5(CAST(o_orderkey AS [[VARCHAR||STRING]]) || '-seed') AS h FROM $orders),
        n AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY h) AS rn FROM r)
        SELECT stratum, o_orderkey, CAST(rn AS INT) AS rn FROM n WHERE rn <= 3""",
    "seeded_sample_limit": "SELECT c_custkey, c_name FROM $customer ORDER BY md5(CAST(c_custkey AS [[VARCHAR||STRING]]) || '-7') LIMIT 100",
    "busiest_unlinked_topk": """
        SELECT c_custkey, round(sum(o_totalprice), 2) AS busy FROM $orders JOIN $customer c ON o_custkey = c_custkey WHERE NOT EXISTS (SELECT 1 FROM $events e WHERE e.user_id = c.c_custkey) GROUP BY c_custkey ORDER BY round(sum(o_totalprice), 2) DESC, c_custkey LIMIT 30""",
    # A mark meets only names with its rarest word: a word that very many names have is joined on only where a mark has no other.
    "array_subset_match": """
        WITH p AS (SELECT p_partkey, [[string_split(p_name, ' ')||split(p_name, ' ')]] AS w, [[string_split(p_type, ' ')||split(p_type, ' ')]] AS y, p_size FROM $part),
        marks AS (SELECT p_partkey AS mark, [[list_append||array_append]](w, concat('size', p_size)) AS w, y FROM p WHERE p_partkey % 50 = 0),
        names AS (SELECT p_partkey, [[list_append||array_append]](w, concat('size', p_size)) AS w, y FROM p),
        a AS (SELECT p_partkey, w, y, [[unnest(list_distinct(w))||explode(array_distinct(w))]] AS token FROM names),
        df AS (SELECT token, count(*) AS n FROM a GROUP BY token),
        m AS (SELECT mark, w, y, [[unnest(list_distinct(w))||explode(array_distinct(w))]] AS token FROM marks),
        k AS (SELECT mark, w, y, token FROM (SELECT m.*, row_number() OVER (PARTITION BY mark ORDER BY n, m.token) AS rn FROM m JOIN df ON df.token = m.token) x WHERE rn = 1)
        SELECT mark, p_partkey FROM k JOIN a ON a.token = k.token AND mark <> p_partkey AND [[len(list_filter(k.w, lambda x: NOT list_contains(a.w, x)))||size(array_except(k.w, a.w))]] = 0 AND [[list_has_any(k.y, a.y)||arrays_overlap(k.y, a.y)]]""",
    "vat_dictionary_join": """
        WITH d AS (SELECT s_nationkey, s_suppkey, s_name, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS rn FROM $supplier)
        SELECT c_custkey, s_suppkey, s_name FROM $customer JOIN d ON s_nationkey = c_nationkey AND rn = 1""",
    "prefix_match_any": """
        SELECT p_partkey, p_type, [[len(list_filter(['STANDARD', 'PROMO', 'SMALL'], lambda x: starts_with(p_type, x))) > 0||exists(array('STANDARD', 'PROMO', 'SMALL'), x -> startswith(p_type, x))]] AS matches,
               CASE WHEN p_type LIKE 'STANDARD%' THEN 'hair' WHEN p_type LIKE 'PROMO%' THEN 'nightlife' WHEN p_type LIKE 'ECONOMY%' THEN 'auto' END AS category FROM $part""",
    "scope_reason_case": """
        WITH n AS (SELECT count(*) AS parts FROM $part), o AS (SELECT *, o_orderkey % parts AS partkey FROM $orders CROSS JOIN n)
        SELECT o_orderkey, coalesce(CASE WHEN o_orderpriority = '5-LOW' THEN 'no category' WHEN o_custkey % 5 = 0 THEN 'outside the city' WHEN o_orderstatus = 'P' THEN 'not operational' WHEN NOT [[regexp_matches(lower(p_name), '[[:alpha:]]{3}')||lower(p_name) RLIKE '\\\\p{Alpha}{3}']] THEN 'address only' END, '') AS out_of_scope_reason,
               [[regexp_matches(strip_accents(lower(p_name)), '(self|auto|red)')||translate(lower(p_name), 'ąčęėįšųūž', 'aceeisuuz') RLIKE '(self|auto|red)']] AS self_service, TRY_CAST(substr(o_orderpriority, 1, 1) AS INT) AS rank
        FROM o JOIN $part ON p_partkey = partkey""",
    "domain_and_url_parts": """
        SELECT page_id, lower(regexp_extract(url, '^([a-z]+)://', 1)) AS scheme, lower(regexp_extract(url, '://([^/?#]+)', 1)) AS host, regexp_extract(url, '://[^/]+(/[^?#]*)', 1) AS path, regexp_extract(url, '[?]([^#]*)', 1) AS query,
               [[len(list_filter(['facebook', 'booking', 'cheap'], lambda m: contains(url, m))) > 0||exists(array('facebook', 'booking', 'cheap'), m -> contains(url, m))]] AS skip FROM $pages""",
    "code_extraction_regex": """
        WITH c AS (SELECT doc_id, [[unnest(regexp_extract_all(text, '[0-9]{4,}'))||explode(regexp_extract_all(text, '[0-9]{4,}', 0))]] AS code FROM $documents)
        SELECT doc_id, code, count(*) AS hits FROM c GROUP BY doc_id, code""",
    "json_path_extract": """
        SELECT event_id, [[json_extract_string(props, '$.k')||get_json_object(props, '$.k')]] AS k, length(props) > 2 AS has_props FROM $events""",
}
