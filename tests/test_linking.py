"""The rule cascade, one place per outcome; name resolution; similarity; names in running text."""

import json

from pyspark.sql import functions as F

from veinstone.plans import cascade

ENTITY = "ja_kodas long, legal_name string, registered_address string, evrk_codes array<string>, nexus boolean, is_active boolean"
PLACE = "place_id string, name string, category string, street string, street_number string"


def entities(spark):
    rows = [
        (1, "UAB Lapė Baras", "Vilnius, Liepų g. 1", ["56.30"], True, True), (2, "UAB Vilkas", "Vilnius, Ąžuolų g. 2", ["10.10"], True, True), (3, "UAB Meška", "Vilnius, Eglių g. 3", [], True, True),
        (4, "MB Meška", "Vilnius, Pušų g. 4", [], True, True), (5, "UAB Stirna", "Vilnius, Klevų g. 5", ["56.30"], True, True), (6, "MB Stirna", "Kaunas, Klevų g. 5", ["10.10"], True, True),
        (7, "UAB Bebras plius", "Vilnius, Beržų g. 7", ["56.30"], True, True), (8, "UAB Kita", "Vilnius, Uosių g. 8", ["45.20"], True, True), (9, "UAB Mirusi", "Vilnius, Uosių g. 9", ["45.20"], True, False),
    ]
    return spark.createDataFrame(rows, ENTITY)


def test_every_outcome(spark):
    places = spark.createDataFrame(
        [
            ("exact", "Lapė Baras", "nightlife", "Kita g.", "9"), ("exact-unfit", "Vilkas", "nightlife", None, None), ("exact-address", "Meška", "auto", "Pušų g.", "4"), ("exact-activity", "Stirna", "nightlife", None, None),
            ("exact-ambiguous", "Meška", "auto", None, None), ("core-address", "Lapė pub", "auto", "Liepų g.", "1"), ("core-activity", "Lapė klubas", "nightlife", None, None), ("part-address", "Naujas | Vilkas", "auto", "Ąžuolų g.", "2-5"),
            ("part-only", "Naujas | Vilkas", "auto", None, None), ("address-only", "Kitas vardas", "auto", "Uosių g.", "8"), ("none", "Visai naujas", "auto", "Uosių g.", "9"), ("generic", "Baras", "nightlife", None, None),
        ],
        PLACE,
    )
    got = {r.place_id: (r.status, r.ja_kodas, r.method) for r in cascade.decide(places, entities(spark)).collect()}
    assert got == {
        "exact": ("linked", 1, "exact_name"), "exact-unfit": ("ambiguous", None, None), "exact-address": ("linked", 4, "exact_name+address"), "exact-activity": ("linked", 5, "exact_name+activity"),
        "exact-ambiguous": ("ambiguous", None, None), "core-address": ("linked", 1, "core_name+address"), "core-activity": ("linked", 1, "core_name+activity"), "part-address": ("linked", 2, "name_part+address"),
        "part-only": ("ambiguous", None, None), "address-only": ("linked", 8, "address_only"), "none": ("unmatched", None, None), "generic": ("unmatched", None, None),
    }


def test_hotspot_is_ambiguous(spark):
    places = spark.createDataFrame([(f"p{i}", f"Vardas{i} kitoks", "auto", "Uosių g.", "8") for i in range(2)], PLACE)
    assert {r.reason for r in cascade.decide(places, entities(spark)).collect()} == {"multi-tenant address"}


def test_resolver_backs_off_but_stops_at_ambiguity(spark):
    names = spark.createDataFrame([("UAB Bebras plius siūlo darbą",), ("Bebras",), ("Meška ir ko",), ("Meška",), ("Vilkas",), ("",), (None,)], "name string")
    assert {r.name: r.ja_kodas for r in cascade.resolve_names(names, entities(spark)).collect()} == {"UAB Bebras plius siūlo darbą": 7, "Vilkas": 2}


def test_similarity_and_mentions(spark):
    assert cascade.token_set_ratio("lape baras", "baras lape") == cascade.token_set_ratio("lape", "lape baras") == 100.0
    assert cascade.token_set_ratio("", "x") == 0.0 and 0 < cascade.token_set_ratio("lapes", "lape") < 100
    df = spark.createDataFrame([("UAB „Lapės maistas“, Vilnius. Vilkas, UAB rekvizitai. MB Meška siūlo darbą", "lape", "lape baras"), (None, None, "x")], "t string, a string, b string")
    rows = df.select(cascade.company_names_in("t").alias("n"), cascade.name_likeness(F.col("a"), F.col("b")).alias("s")).collect()
    assert {"Lapės maistas", "Vilkas", "Meška"} <= set(rows[0].n) and rows[0].s == 100.0 and rows[1].n == [] and rows[1].s == 0.0


def test_branches_and_candidates(spark):
    places = spark.createDataFrame([("p", "Gerasis klubas Rytas", "nightlife", "Uosių g.", "8"), ("q", "Senas skyrius", "auto", None, None)], PLACE)
    branches = spark.createDataFrame([(8, "UAB Gerasis klubas Rytas", True, True), (2, "Senas skyrius", True, False), (9, "Senas skyrius", True, True)], "ja_kodas long, branch_name string, in_vilnius boolean, is_current boolean")
    assert {r.place_id: r.status for r in cascade.decide(places, entities(spark)).collect()} == {"p": "unmatched", "q": "unmatched"}
    got = {r.place_id: (r.status, r.ja_kodas, r.method) for r in cascade.decide(places, entities(spark), branches).collect()}
    assert got == {"p": ("linked", 8, "exact_name"), "q": ("unmatched", None, None)}  # old branches and those of entities that are gone do not count
    rows = cascade.candidate_table("2024-05", places, entities(spark), branches).where("source = 'exact_name'").collect()
    assert len(rows) == 1 and rows[0].ja_kodas == 8 and rows[0].address_agrees and not rows[0].evrk_consistent and json.loads(rows[0].evidence)["matched_key"] == rows[0].matched_key == "gerasis klubas rytas"


def test_copies_of_a_name_are_one_class(spark, tmp_path):
    from veinstone.plans import programmatic

    rows = [(i, name, "B1" if i % 2 else "B2") for i, name in enumerate(["red bolt", "red bolt", "red ring", "red ring", "blue bolt", "blue bolt", "red bolt", "red bolt", "", ""] * 20)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    out = programmatic.token_set_similarity(spark, str(tmp_path)).collect()
    first = {(b, n): min(i for i, m, c in rows if (m, c) == (n, b)) for _, n, b in rows}
    assert {(r.p_partkey, r.other, r.likeness) for r in out if r.kind == "member"} == {(i, first[b, n], 100.0 if n else 0.0) for i, n, b in rows}
    assert {(r.p_partkey, r.other, r.likeness) for r in out if r.kind == "pair"} == {(first[b, "red bolt"], first[b, "red ring"], round(cascade.token_set_ratio("red bolt", "red ring"), 1)) for b in ("B1", "B2")}
    assert len(out) == len(rows) + 2


def test_subset_match_of_copies(spark, tmp_path):
    import duckdb

    from veinstone import staging
    from veinstone.plans import catalog

    names = ["red bolt", "red red", "red", "bolt red ring", "blue ring", "", None]
    rows = [(i, names[i % 7], ["SMALL", "SMALL BRASS", "LARGE", None][i % 4], i % 2 + 1) for i in range(700)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_type string, p_size int").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    before = staging.staged_now()
    out = catalog.QUERIES["array_subset_match"](spark, str(tmp_path))
    classes = [spark.read.parquet(path).count() for path in staging.staged_now() - before if "veinstone-classes-" in path]
    assert classes == [15]  # 450 parts meet as 15 classes
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet/*.parquet' WHERE p_name IS NOT NULL")
    assert sorted(map(tuple, out.collect())) == sorted(con.execute(catalog.ORACLES["array_subset_match"]).fetchall())


def test_long_keys_of_one_split_are_made_by_all_tasks(spark, tmp_path):
    import pathlib

    from veinstone import staging
    from veinstone.plans import models

    def files(before, name):
        return [len(list(pathlib.Path(path.removeprefix("file:")).glob("*.parquet"))) for path in staging.staged_now() - before if f"veinstone-{name}-" in path]

    at = lambda name, rows, schema: spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}") or spark.read.parquet(f"{tmp_path}/{name}")
    places = at("places", [(f"p{i}", f"Lapė{i} baras", "nightlife", "Upės g.", str(i)) for i in range(200)], "place_id string, name string, category string, street string, street_number string")
    premises = at("premises", [(i, f"Lapė{i}", f"Upės g. {i}, Vilnius") for i in range(200)], "ja_kodas long, trade_name string, address string")
    entities = at("entities", [(i, f"UAB Lapė{i}", f"Vilnius, Upės g. {i}", ["56.30"], True, True) for i in range(200)], "ja_kodas long, legal_name string, registered_address string, evrk_codes array<string>, nexus boolean, is_active boolean")
    before = staging.staged_now()
    assert {(r.place_id, r.ja_kodas) for r in models.premises_evidence(places, premises).collect()} >= {(f"p{i}", i) for i in range(200)}
    assert {r.status for r in cascade.decide(places, entities).collect()} == {"linked"}
    assert files(before, "premises-keys")[0] > 1 and all(n > 1 for n in files(before, "place-keys")) and len(files(before, "place-keys")) == 2
