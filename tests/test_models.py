"""Models, reports and brand evidence on small tables: a row for every branch."""

import datetime as dt

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from veinstone.config import Thresholds
from veinstone.plans import brands, models, ranks, reports
from veinstone.plans.cascade import company_names, name_likeness

M = "2024-05"


def test_company_names_by_what_stands_next_to_a_form():
    assert company_names("UAB „Lapės maistas“, Vilnius. Vilkas Bebras, UAB rekvizitai. MB Meška plius siūlo darbą") == ["Lapės maistas", "Meška plius", "Vilkas Bebras"]
    assert company_names("UAB Aa Bb Cc Dd Ee; UAB uab. KUAB X") == ["Aa Bb Cc Dd"] and company_names(None) == []


def validated(spark, links, agreement=(), audits=(), earlier=()):
    places = [(M, p, "auto" if i % 2 else "nightlife", f"https://www.site{i}.lt/", True, f"g{i}", str(i)) for i, p in enumerate("abcdefghijklm")] + [(M, f"chain{i}", "auto", "https://chain.lt", True, "g", str(i)) for i in range(3)]
    return {
        r.place_id: r
        for r in models.validated_links(
            M, spark.createDataFrame([(M, p, j, "linked", m, c, s) for p, j, m, c, s in links] + [("2024-04", p, j, "linked", "exact_name", "HIGH", "primary") for p, j in earlier], "run_month string, place_id string, ja_kodas long, status string, method string, confidence string, stage string"),
            spark.createDataFrame(places, "run_month string, place_id string, category string, website string, in_scope boolean, street string, street_number string"),
            spark.createDataFrame([(1, True, True), (2, False, True)], "ja_kodas long, is_active boolean, vilnius_nexus boolean"),
            spark.createDataFrame([(M, "a", 1, True, False, 50.0, "one"), (M, "h", 1, True, False, 1.0, "x y"), (M, "chain0", 1, True, True, 1.0, "x")], "run_month string, place_id string, ja_kodas long, evrk_consistent boolean, address_agrees boolean, name_similarity double, matched_key string"),
            spark.createDataFrame([(M, *a) for a in agreement], "run_month string, place_id string, source string, verdict string"),
            spark.createDataFrame([(p, j, v, dt.date(2024, 1, d)) for p, j, v, d in audits], "place_id string, ja_kodas long, verdict string, audited_on date"),
        ).collect()
    }


def test_every_validation_status(spark):
    primary, fallback = ("HIGH", "primary"), ("MEDIUM", "fallback")
    links = [("a", 1, "core_name+address", *primary), ("b", 1, "override", "HIGH", "override"), ("c", 1, "exact_name", *primary), ("d", 1, "exact_name", *primary), ("e", 1, "exact_name", *primary), ("f", 2, "exact_name", *primary)]
    links += [("g", 1, "fallback:job_ads+trademark", *fallback), ("h", 1, "fallback:website", *fallback), ("i", 1, "fallback:serp+website", *fallback), ("j", 1, "fallback:primary_candidate+serp", *fallback), ("chain0", 1, "fallback:primary_candidate+website", *fallback)]
    out = validated(spark, links, agreement=[("c", "website", "conflicts"), ("d", "website", "conflicts"), ("d", "serp", "confirms"), ("e", "trademark", "confirms")], audits=[("e", 1, "correct", 1), ("e", 1, "wrong", 2)], earlier=[("a", 9), ("b", 1)])
    assert {p: r.validation_status for p, r in out.items()} == {
        "a": "unverified", "b": "confirmed_by_audit", "c": "conflict", "d": "confirmed", "e": "rejected_by_audit", "f": "unverified", "g": "brand_level_only", "h": "single_source", "i": "confirmed", "j": "single_source", "chain0": "brand_site_code",
    }
    assert out["a"].single_token_name and out["a"].relinked_since_last_run and not out["b"].relinked_since_last_run and out["e"].brand_confirming == 1 and out["chain0"].chain_site
    # one entity with links in two categories and many sites: implausible, whatever else speaks for it
    assert all(r.implausible_spread and not r.usable for p, r in out.items() if p != "f") and not out["f"].usable
    few = validated(spark, [links[0], links[7], ("l", 1, "exact_name", *primary)])
    assert (few["a"].usable, few["h"].usable, few["l"].usable) == (True, True, False)


def test_evidence_verdicts_and_fallback(spark):
    vat = spark.createDataFrame([("LT300", 3)], "vat_code string, ja_kodas long")
    web = [("p1", "company", "1", "http://x/"), ("p1", "vat", "300", "http://x/Privacy"), ("p2", "company", "2", "http://x/"), ("p2", "vat", "999", "http://x/"), ("p3", "company", "9", "http://x/"), ("p4", "company", "1", "http://x/"), ("p5", "company", "2", "http://x/")]
    website = spark.createDataFrame([(M, *r) for r in web], "run_month string, place_id string, code_type string, code string, page_url string")
    serp = spark.createDataFrame([(M, "p2", "2", 1), (M, "p2", "1", 0), (M, "p4", "2", 3), (M, "p6", None, 0)], "run_month string, place_id string, code string, hits_named int")
    brand = spark.createDataFrame([(M, "p5", "trademark", 2), (M, "p5", "job_ads", None)], "run_month string, place_id string, source string, ja_kodas long")
    found = models.evidence(M, vat, website, serp, brand)
    assert {(r.place_id, r.source, r.ja_kodas) for r in found.collect()} == {("p1", "website", 3), ("p2", "website", 2), ("p2", "website", None), ("p2", "serp", 2), ("p3", "website", 9), ("p4", "website", 1), ("p4", "serp", 2), ("p5", "website", 2), ("p5", "trademark", 2)}
    assert models.evidence(M, vat).count() == 0
    entities = spark.createDataFrame([(1, "UAB Lapė", "Vilnius, Liepų g. 1", ["45.20"], True), (2, "UAB Vilkas", "Vilnius, Eglių g. 2", ["56.30"], True), (3, "UAB Ona", "Kaunas, X g. 3", ["10.10"], True), (9, "UAB Nebėra", "Vilnius, Y g. 9", ["45.20"], False)], "ja_kodas long, legal_name string, registered_address string, evrk_codes array<string>, is_active boolean")
    linked = spark.createDataFrame([("p1", 3), ("p2", 1), ("p3", 1)], "place_id string, ja_kodas long")
    verdicts = {(r.place_id, r.source): (r.verdict, r.evidence) for r in models.source_verdicts(linked, found, entities).collect()}
    assert verdicts == {("p1", "website"): ("confirms", "v:300"), ("p2", "website"): ("conflicts", "c:2,v:999"), ("p2", "serp"): ("conflicts", "c:2")}
    opened = spark.createDataFrame([("p1", "Kitas", "auto", None, None), ("p2", "Kitas", "nightlife", None, None), ("p3", "x", "auto", None, None), ("p4", "Kitas", "auto", "Eglių g.", "2"), ("p5", "Vilkas baras", "auto", None, None)], "place_id string, name string, category string, street string, street_number string")
    primary = spark.createDataFrame([("p4", 1)], "place_id string, ja_kodas long")
    got = {r.place_id: (r.ja_kodas, r.method) for r in models.fallback_links(opened, found, entities, primary, name_likeness).collect()}
    # p1: nothing corroborates; p3: no active entity; p4: two sources for 1 (it was a candidate) against one for 2, which is at the address
    assert got == {"p2": (2, "fallback:serp+website"), "p4": (1, "fallback:primary_candidate+website"), "p5": (2, "fallback:trademark+website")}


def test_premises_at_and_near_an_address(spark):
    premises = spark.createDataFrame([(1, "Lapė", "Liepų g. 10, Vilnius"), (2, "Kita", "Liepų g. 10, Vilnius"), (3, "Viena", "Eglių g. 7, Vilnius"), (4, "Meška", "Liepų g. 15, Vilnius"), (None, "Lapė", "Liepų g. 10, Vilnius")], "ja_kodas long, trade_name string, address string")
    places = spark.createDataFrame([("both", "Lapė", "nightlife", "Liepų g.", "10"), ("alone", "Visai kas nors", "nightlife", "Eglių g.", "7"), ("near", "Meška", "nightlife", "Liepų g.", "12"), ("far", "Meška", "nightlife", "Liepų g.", "20"), ("auto", "Lapė", "auto", "Liepų g.", "10"), ("none", "Lapė", "nightlife", None, None)], "place_id string, name string, category string, street string, street_number string")
    assert {(r.place_id, r.ja_kodas) for r in models.premises_evidence(places, premises, name_likeness).collect()} == {("both", 1), ("alone", 3), ("near", 4)}


@pytest.fixture(scope="module")
def activity(spark):
    base = dict(run_month=M, main_category="auto", n_places=1, reviews_total=700, rating_weighted=4.2, weekly_open_hours_max=100.0, any_self_service=False, all_links_usable=True, activity_fits=True, owner_operated=False, vat_registered=True, registered_on=dt.date(2010, 1, 1), taxes_prev_year=9000.0, taxes_last_reported=9000.0, taxes_last_reported_year=2023, taxes_has_tax_year_row=True, has_vmi_record=True, has_sodra_record=True, insured_avg_prev_year=5.0, insured_avg_t12m=5.0, contributions_prev_year=8000.0, contribution_months_suppressed=0, revenue_latest=100000.0, revenue_fy=2023, revenue_is_stale=False, multi_site=False, new_entity=False, tax_year=2023, link_methods=["exact_name"])
    rows = [base | {"ja_kodas": i, "reviews_total": 70 + i} for i in range(20)]
    busy = {"reviews_total": 7000}
    cases = {
        100: busy | {"new_entity": True}, 101: busy | {"has_vmi_record": False, "taxes_prev_year": None, "taxes_last_reported": None, "has_sodra_record": False}, 102: {"main_category": "other"}, 103: {"reviews_total": 5}, 104: {"reviews_total": 69},
        105: busy, 106: busy | {"taxes_prev_year": 100.0, "all_links_usable": False}, 107: busy | {"taxes_prev_year": 1000.0}, 108: busy | {"taxes_prev_year": 100.0}, 109: busy | {"taxes_prev_year": 200.0}, 110: busy | {"any_self_service": True},
        111: busy | {"taxes_prev_year": 100.0, "rating_weighted": 4.9, "reviews_total": 9000}, 112: busy | {"taxes_prev_year": None, "taxes_last_reported": None, "revenue_latest": 10.0},
    }
    return spark.createDataFrame([Row(**r) for r in [*rows, *(base | {"ja_kodas": k} | v for k, v in cases.items())]])


def test_every_hold_reason_and_tier(activity):
    out = {r.ja_kodas: r for r in models.scored_leads(activity, Thresholds(capacity=2)).collect()}
    start = {k: (r.hold_reason or "").split(" (")[0] for k, r in out.items()}
    assert [start[k] for k in (100, 101, 102, 103, 104, 105, 106, 107, 111)] == [
        "entity younger than 12 months", "no tax record", "too few comparable peers", "too few reviews for the rating profile", "not visibly busy vs category", "taxes in line with peers", "link to legal entity not verified enough", "no corroborating signal", "no corroborating signal",
    ]
    assert 110 not in out and out[101].tier == out[102].tier == "D_insufficient_evidence" and out[105].tier == "C_not_flagged" and out[106].tier == out[107].tier == out[111].tier == "B_watchlist"
    top = [k for k, r in out.items() if r.tier == "A_priority"]
    assert sorted(top) == [108, 112] or sorted(top) == [108, 109]
    late = next(k for k in (108, 109, 112) if k not in top)
    assert out[late].tier == "B_watchlist" and out[late].hold_reason is None  # beyond capacity
    strict = {r.ja_kodas: r for r in models.scored_leads(activity, Thresholds(capacity=1, strict=True)).collect()}
    assert strict[112].tier == "C_not_flagged" and {strict[108].tier, strict[109].tier} == {"A_priority", "B_watchlist"} and all((r.hold_reason is None) == (r.tier == "A_priority") for r in strict.values())
    assert sorted(r.priority_rank for r in out.values())[0] == 1


def test_reasons_and_history(spark, activity):
    leads = models.scored_leads(activity)
    text = {r.ja_kodas: r.reasons for r in reports.reasons(leads).where("ja_kodas IN (105, 108)").collect()}
    assert any("taxes in line" in x for x in text[105]) and any("next to nothing" in x for x in text[108]) and not any("Held back" in x for x in text[108])
    later = leads.withColumn("run_month", F.lit("2099-01")).withColumns({"d_taxes": F.when(F.col("ja_kodas") == 1, F.col("d_taxes") + 50000).otherwise(F.col("d_taxes")), "tier": F.when(F.col("ja_kodas") == 1, "C_x").otherwise(F.col("tier")), "reviews_total": F.when(F.col("ja_kodas") == 2, F.col("reviews_total") + 100).otherwise(F.col("reviews_total"))})
    h = {r.ja_kodas: r for r in reports.lead_history(leads.unionByName(later)).where("run_month = '2099-01'").collect()}
    assert (h[1].change_type, h[1].change_reason, h[2].change_reason, h[3].change_reason) == ("tier_changed", "other declared figures", "other visible activity", "no input changed")


def test_report_and_audit_sample(spark):
    places = spark.createDataFrame([(M, f"p{i}", f"n{i}", "auto", i < 8, False, None if i < 8 else "closed", 10 * i, None, None) for i in range(10)], "run_month string, place_id string, name string, category string, in_scope boolean, self_service boolean, out_of_scope_reason string, user_rating_count int, maps_uri string, website string")
    links = spark.createDataFrame([(M, f"p{i}", "linked" if i < 6 else "unmatched", "exact_name" if i < 6 else None, "HIGH", "no candidate") for i in range(8)], "run_month string, place_id string, status string, method string, confidence string, reason string")
    validation = spark.createDataFrame([(M, f"p{i}", 1, "auto", "exact_name" if i < 4 else "fallback:website+serp", "confirmed" if i % 2 else "unverified", i > 2, "override" if i == 5 else "primary") for i in range(6)], "run_month string, place_id string, ja_kodas long, category string, method string, validation_status string, usable boolean, stage string")
    activity = spark.createDataFrame([(M, "auto", True, True, None, 2023, True, False, False)], "run_month string, main_category string, has_vmi_record boolean, has_sodra_record boolean, revenue_fy int, tax_year int, owner_operated boolean, vat_registered boolean, new_entity boolean")
    sweep = spark.createDataFrame([(M, "complete", 5)], "run_month string, status string, n_results int")
    text = reports.coverage_report(M, sweep=sweep, places=places, links=links, validation=validation, activity=activity)
    assert "| auto | 8 | 6 | 75.0 | 8 | 0 | 2 |" in text and text.count("## ") == 8 and "| closed | 2 |" in text
    entities = spark.createDataFrame([(1, "UAB Lapė", "Vilnius")], "ja_kodas long, legal_name string, registered_address string")
    sample = reports.audit_sample(M, validation, places, entities, spark.createDataFrame([("p0",)], "place_id string"), each=2).collect()
    assert len(sample) == 3 and {r.place_id for r in sample} <= {"p1", "p2", "p3", "p4"} and sample[0].maps_uri.endswith(sample[0].place_id) and sample[0].registry_page.endswith("=1")


def test_brand_evidence(spark):
    names = spark.createDataFrame([("7 Fridays Vingis", None, "1"), ("Lapė | baras", "Liepų g.", None)], "n string, s string, m string")
    got = names.select(brands.brand_of(F.col("n")), brands.search_text(F.col("n"), F.col("s"), F.col("m")), brands.job_ad_text(F.lit("x"))).collect()
    assert [tuple(r) for r in got] == [("7 Fridays", "7 Fridays Vingis 1 Vilnius įmonės kodas", '"x" Vilnius darbo skelbimas'), ("Lapė", "Lapė | baras Liepų g. Vilnius įmonės kodas", '"x" Vilnius darbo skelbimas')]
    entities = spark.createDataFrame([(1, "UAB Lapės maistas", True), (2, "UAB Vilko namai", True)], "ja_kodas long, legal_name string, is_active boolean")
    results = spark.createDataFrame([("p", "Lapė plius", "Lapė Plius", "įmonės kodas 123456789"), ("p", "Lapė plius", "Kita", "kodas 123456789"), ("q", "Ona", "t", "d")], "place_id string, name string, title string, desc string")
    assert {tuple(r) for r in brands.search_codes(results).collect()} == {("p", "123456789", 2, 1), ("q", None, 0, 0)}
    ads = spark.createDataFrame([("p", "Lapė plius", "UAB „Lapės maistas“ siūlo darbą", "restoranas Lapė plius"), ("p", "Lapė plius", "UAB „Vilko namai“", "kitur")], "place_id string, brand string, title string, desc string")
    assert [(r.company_name, r.ja_kodas) for r in brands.employers(ads, entities).collect()] == [("Lapės maistas", 1)]
    targets = spark.createDataFrame([("p", "Lapė Didžioji Žuvis", "nightlife")], "place_id string, name string, category string")
    marks = spark.createDataFrame([("1", "LAPĖ ŽUVIS", ["43"], "Registruotas"), ("2", "LAPĖ KITA", ["43"], "Registruotas"), ("3", "LAPĖ", ["43"], "Atmestas"), ("4", "LAPĖ", ["9"], "Registruotas")], "application_no string, text string, classes array<string>, status string")
    owners = spark.createDataFrame([(str(i), "LAPĖ", "UAB Vilko namai", "Vilnius") for i in range(1, 5)], "application_no string, mark string, owner_name string, owner_address string")
    assert [(r.place_id, r.ja_kodas) for r in brands.trademark_evidence(targets, marks, owners, entities, {"nightlife": ("43",)}).collect()] == [("p", 2)]
    sites = spark.createDataFrame([("https://lape.lt", "https://lape.lt/a", "company", "1", "x"), ("https://lape.lt", "https://lape.lt/b", "company", "1", "y")], "site string, page_url string, code_type string, code string, context string")
    places = spark.createDataFrame([("p", "https://lape.lt/kontaktai"), ("q", "https://LAPE.lt"), ("r", "https://facebook.com/lape"), ("s", None)], "place_id string, website string")
    assert {(r.place_id, r.context) for r in brands.site_places(sites, places).collect()} == {("p", "y"), ("q", "y")}


def test_positions_equal_windows(spark):
    rows = [(i % 3, float(i * 7 % 11) if i % 5 else None, i) for i in range(200)]
    df = spark.createDataFrame(rows, "g int, v double, k int")
    out = ranks.positions(df, "v", within=("g",), ties=("k",), descending=True).collect()
    for g in range(3):
        order = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is None, -(r[1] or 0), r[2]))
        assert [(r.k, r.row_number) for r in sorted((r for r in out if r.g == g), key=lambda r: r.row_number)] == [(r[2], i + 1) for i, r in enumerate(order)]
        first = {}
        for i, r in enumerate(order):
            first.setdefault(r[1], i + 1)
        assert all(r.rank == first[r.v] and r.group_rows == len(order) for r in out if r.g == g)
    tile = spark.range(1, 14).select(ranks.ntile(F.col("id"), F.lit(13), 5).alias("t")).collect()
    assert [r.t for r in tile] == [1, 1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 5, 5]


def test_leads_move_no_lists_and_join_line_items_once(spark):
    from veinstone import staging
    from veinstone.plans import model_queries

    before = staging.staged_now()
    model_queries.model_leads(spark, "/root/testdata/sf0.001")
    made = {path.rpartition("/")[2].split("-")[1]: path for path in staging.staged_now() - before}
    assert {"lines", "taxes", "payroll"} <= made.keys()
    assert not any(kind.startswith("array") for name in ("activity", "scored") for _, kind in spark.read.parquet(made[name]).dtypes)


def test_verdicts_are_dealt_by_counted_rows(spark, monkeypatch):
    import re

    from veinstone import staging
    from veinstone.plans import model_queries

    folder = "/root/testdata/sf0.001"
    rows = lambda df: sorted(map(tuple, df.collect()))
    usual = rows(model_queries.model_source_verdicts(spark, folder))
    monkeypatch.setattr(staging, "TASK_ROWS", 1000)
    df = model_queries.model_source_verdicts(spark, folder)
    assert rows(df) == usual and usual
    items = spark.read.parquet(f"{folder}/lineitem.parquet").count()
    dealt = re.findall(r"hashpartitioning\((\w+)#\d+L?, (\d+)\), REPARTITION_BY_NUM", df._jdf.queryExecution().executedPlan().toString())
    assert {name for name, _ in dealt} == {"place_id", "code", "key"} and {int(n) for _, n in dealt} == {-(-2 * items // 1000)}
    made = [path for path in staging.staged_now() if "veinstone-named" in path]
    assert made and staging.dealt(spark.range(2500), 2500, "id").rdd.getNumPartitions() == 4 == staging.dealt(spark.range(9500).repartition(4), 3500, "id").rdd.getNumPartitions()


def test_codes_of_nobody_are_evidence(spark):
    vat = spark.createDataFrame([("LT300", 3)], "vat_code string, ja_kodas long")
    website = spark.createDataFrame([(M, "p1", "vat", "999", "http://x/"), (M, "p1", "company", "3", "http://x/"), (M, "3", "vat", "998", "http://x/")], "run_month string, place_id string, code_type string, code string, page_url string")
    entities, linked = spark.createDataFrame([(3, True)], "ja_kodas long, is_active boolean"), spark.createDataFrame([("p1", 3), ("3", 3)], "place_id string, ja_kodas long")
    got = models.source_verdicts(linked, models.evidence(M, vat, website), entities).collect()
    assert [(r.place_id, r.verdict, r.evidence) for r in got] == [("p1", "confirms", "c:3,v:999")]
