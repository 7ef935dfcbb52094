"""Readers, sinks, checks, SQL surface, sweep and the catalog against DuckDB."""

import gzip
import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from veinstone.plans import catalog, quality, sqlsurface, sweep
from veinstone.plans.dialect import duck, spark_sql
from veinstone.sources import readers, sinks


def test_register_and_payroll(spark, tmp_path):
    (tmp_path / "r.csv").write_text("|".join(readers.REGISTER_COLUMNS) + '\n1|UAB "Lapė"|Vilnius|2020-01-01|310|UAB|0|x|bad\nbad|x|x|x|1|x|1|x|x\n')
    r = readers.read_register(spark, str(tmp_path / "r.csv"), "f1").collect()
    assert len(r) == 1 and r[0].ja_kodas == 1 and r[0].status_since is None and r[0].fetch_id == "f1"
    (tmp_path / "a.csv").write_text("Kodas (jarCode);Mėnuo (month);Apdrausti (numInsured);Veikla (ecoActCode)\n1;202401;5;563000\n")
    (tmp_path / "b.csv").write_text("Kodas (jarCode);Mėnuo (month);Apdrausti (numInsured);Naujas (other);Įmokos (tax)\n1;202502;6;z;12.5\n")
    p = readers.read_payroll(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], "f").orderBy("month").collect()
    assert [(str(x.month), x.num_insured, x.evrk, x.contributions) for x in p] == [("2024-01-01", 5, "56.30.00", None), ("2025-02-01", 6, None, 12.5)]
    (tmp_path / "c.csv").write_text("A (jarCode);B (x)\n1;2\n")
    with pytest.raises(readers.SchemaDrift):
        readers.read_payroll(spark, [str(tmp_path / "c.csv")], "f")


def test_json_sources(spark, tmp_path):
    with gzip.open(tmp_path / "t.jsonl.gz", "wt") as f:
        f.write('{"mm_kodas__ja_kodas":"7","metai":"2024","menuo":"12","suma":"10.5"}\n{"mm_kodas__ja_kodas":null}\n')
    assert [(r.ja_kodas, r.year, r.taxes_paid) for r in readers.read_taxes(spark, str(tmp_path / "t.jsonl.gz"), "f").collect()] == [(7, 2024, 10.5)]
    line = json.dumps({"juridinis_asmuo__ja_kodas": "7", "reiksme": "5", "laikotarpis_iki": "2024-12-31"})
    (tmp_path / "v.jsonl").write_text(f"{line}\n{line}\n")
    assert [(r.fiscal_year, r.revenue) for r in readers.read_revenue(spark, str(tmp_path / "v.jsonl"), "f").collect()] == [(2024, 5.0)]
    place = {"id": "p", "displayName": {"text": "Lapė"}, "addressComponents": [{"longText": "Liepų g.", "types": ["route"]}], "primaryType": "pub", "priceRange": {"startPrice": {"units": "10", "nanos": 500000000}}, "regularOpeningHours": {"periods": [{"open": {"day": 1, "hour": 9, "minute": 0}, "close": {"day": 1, "hour": 10, "minute": 0}}]}}
    r = readers.parse_listings(spark.createDataFrame([(json.dumps(place),)], "payload string")).first()
    assert (r.place_id, r.street, r.category, r.price_from, r.price_to, r.weekly_open_hours) == ("p", "Liepų g.", "nightlife", 10.5, None, 1.0)
    payload = json.dumps({"results": [{"content": {"results": {"organic": [{"title": "t", "desc": "d"}]}}}, {"content": "text"}]})
    assert [(r.title, r.desc) for r in readers.search_results(spark.createDataFrame([(payload,), ("{}",)], "payload string")).collect()] == [("t", "d")]
    nested = spark.createDataFrame([(((1, 2),), "x")], "a struct<b:struct<c:int,_d:int>>, _id string")
    assert nested.select(readers.flattened(nested)).columns == ["a__b__c", "_id"]
    assert [r.v for r in readers.first_seen(spark.createDataFrame([(1, 2, "b"), (1, 1, "a")], "k int, o int, v string"), "k", "o").collect()] == ["a"]


def test_months_upserts_and_overrides(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_month(spark.createDataFrame([("2024-01", 1), ("2024-02", 2)], "run_month string, v int"), path)
    sinks.write_month(spark.createDataFrame([("2024-02", 3)], "run_month string, v int"), path)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 3]
    old = spark.createDataFrame([("2024-01", 1), ("2024-02", 2)], "run_month string, v int")
    new = spark.createDataFrame([("2024-02", 9, "n")], "run_month string, v int, extra string")
    assert {tuple(r) for r in sinks.with_history(new, old, "2024-02").collect()} == {("2024-02", 9, "n"), ("2024-01", 1, None)}
    assert {tuple(r) for r in sinks.upsert(old, new, ["run_month"]).collect()} == {("2024-02", 9, "n"), ("2024-01", 1, None)}
    links = spark.createDataFrame([("p", "linked", 1, "exact", "HIGH", ""), ("q", "linked", 2, "exact", "HIGH", ""), ("r", "unmatched", None, "", None, "")], "place_id string, status string, ja_kodas long, method string, confidence string, reason string")
    over = spark.createDataFrame([("p", None, " Reject ", "no"), ("r", 5, "set", "yes")], "place_id string, ja_kodas long, action string, reason string")
    got = {r.place_id: (r.status, r.ja_kodas, r.method) for r in sinks.apply_overrides(links, over).collect()}
    assert got == {"p": ("ambiguous", None, "override"), "q": ("linked", 2, "exact"), "r": ("linked", 5, "override")}
    fetches = spark.createDataFrame([("f1", "s", 1), ("f2", "s", 2)], "fetch_id string, source string, fetched_at int")
    assert {r.fetch_id: r.row_count for r in sinks.row_counts(fetches, [spark.createDataFrame([("f1",), ("f1",)], "fetch_id string")]).collect()} == {"f1": 2, "f2": None}
    assert sinks.latest_fetch(fetches, "s").first().fetch_id == "f2"
    sinks.write_csv(spark.createDataFrame([(1, ["a", "b"])], "k int, l array<string>"), str(tmp_path / "c"))
    assert spark.read.csv(str(tmp_path / "c"), header=True, escape='"').first().l == '["a","b"]'
    assert sinks.markdown(spark.createDataFrame([(1, 1234.56, None)], "a int, b double, c string")).splitlines()[2] == "| 1 | 1,234.6 |  |"


def test_gate_treats_unknown_as_failed(spark):
    tables = {"t": spark.createDataFrame([(1,), (2,)], "v int")}
    checks = [quality.Check("rows", "error", "t", "count(*)", ">=", 2), quality.Check("none", "error", "t", "max(v) FILTER (WHERE v > 5)", "<=", 3), quality.Check("warned", "warn", "t", "max(v)", "=", 9)]
    assert quality.gate(quality.run_checks(tables, checks)) == ["none"]


def test_sql_surface_is_read_only(spark):
    sqlsurface.register({"t_numbers": spark.range(5).toDF("v")})
    assert sqlsurface.read_only(spark, "WITH x AS (SELECT v FROM t_numbers) SELECT sum(v) AS s FROM x WHERE v > :low", low=2).first().s == 7
    for bad in ("DROP VIEW t_numbers", "CREATE TABLE x AS SELECT 1", "INSERT INTO t_numbers VALUES (1)", "SET a = b"):
        with pytest.raises(PermissionError):
            sqlsurface.read_only(spark, bad)
    df = spark.createDataFrame([("Abc", 1), (None, 2)], "s string, n int")
    assert [r.n for r in sqlsurface.filtered(df, [("s", "contains", "B")]).collect()] == [1] and [r.n for r in sqlsurface.filtered(df, [("s", "is empty")]).collect()] == [2]
    assert sqlsurface.filtered(df, [("n", ">=", 1), ("n", "<", 2)]).count() == 1
    with pytest.raises(ValueError, match="no such operation"):
        sqlsurface.condition("s", "or 1=1")


def test_adaptive_cells_hold_every_point_or_say_so(spark):
    rng = random.Random(1)
    points = [(i, min(max(rng.gauss(0.5, 0.1), 0), 1), min(max(rng.gauss(0.3, 0.1), 0), 1)) for i in range(400)] + [(999, 0.9, 0.9)] * 30 + [(1000, None, 0.2), (1001, 2.0, 0.2)]
    cells = sweep.area_cells(spark.createDataFrame(points, "id int, lat double, lng double"), (0.0, 0.0, 1.0, 1.0), 20, 5).collect()
    assert sum(c.n_results for c in cells if c.status != "split") == 430
    assert all((c.n_results >= 20) == (c.status != "complete") and (c.status == "truncated") <= (c.depth == 5) for c in cells)
    assert any(c.status == "truncated" for c in cells) and sum(c.depth == 0 for c in cells) == 1


def test_dialect():
    t = "SELECT [[a||b]] FROM $orders"
    assert duck(t) == "SELECT a FROM orders" and spark_sql(t, "/d") == "SELECT b FROM parquet.`/d/orders.parquet`"


@pytest.mark.parametrize("name", ["peer_gap_topk", "tier_case_capped", "priority_rank", "link_cascade_case", "dq_suite", "model_entity_activity", "model_leads", "model_link_validation", "model_source_verdicts", "adaptive_sweep", "name_prefix_backoff"])
def test_queries_equal_their_sql(spark, name):
    import duckdb

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents pages labels".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    df = catalog.QUERIES[name](spark, folder)
    cols = sorted(df.columns)
    clean = lambda rows: sorted([tuple(round(v, 4) if isinstance(v, float) else v for v in r) for r in rows], key=repr)
    assert clean(df.select(cols).collect()) == clean(con.execute(f"SELECT {', '.join(cols)} FROM ({catalog.ORACLES[name]})").fetchall())


def test_halves_are_rounded_and_ranked_as_in_sql(spark, tmp_path):
    """Each pair of customers has one line item each, of 0.09595 and 0.0959 and the like: the first is a half, so the ranks tell how it is rounded."""
    import duckdb

    halves = [(10.1, 0.05, 0.0959), (11.5, 0.07, 0.107), (11.95, 0.1, 0.1076), (14.35, 0.1, 0.1291), (13.7, 0.05, 0.1301), (16.45, 0.1, 0.148), (17.15, 0.1, 0.1543), (17.5, 0.01, 0.1732)]
    items = [item for price, discount, rounded in halves for item in ((price, discount), (rounded * 100, 0.0))]
    at = lambda day: f"TIMESTAMP '{day}'"
    union = lambda rows: " UNION ALL ".join(f"SELECT {r}" for r in rows)
    n = range(len(items))
    con = duckdb.connect()
    con.execute("CREATE TABLE customer AS " + union([f"{k}::BIGINT AS c_custkey, 1 AS c_nationkey, 'BUILDING' AS c_mktsegment" for k in n]))
    con.execute("CREATE TABLE orders AS " + union([f"{k}::BIGINT AS o_orderkey, {k}::BIGINT AS o_custkey, {1000.0 + k}::DOUBLE AS o_totalprice, {at('1996-01-01')} AS o_orderdate" for k in n]))
    lines = [f"{k}::BIGINT AS l_orderkey, {p}::DOUBLE AS l_extendedprice, {d}::DOUBLE AS l_discount, 0.01::DOUBLE AS l_tax, {at('2000-05-01')} AS l_shipdate" for k, (p, d) in enumerate(items)]
    con.execute("CREATE TABLE lineitem AS " + union([*lines, f"0, 1000.0, 0.0, 0.01, {at('2001-05-01')}"]))
    for t in ("customer", "orders", "lineitem"):
        con.execute(f"COPY {t} TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
    ours = sorted(tuple(r) for r in catalog.QUERIES["priority_rank"](spark, str(tmp_path)).select("c_custkey", "tier", "priority_rank").collect())
    assert ours == sorted(con.execute(f"SELECT c_custkey, tier, priority_rank FROM ({catalog.ORACLES['priority_rank']})").fetchall())


def test_flagship_prunes_columns_and_filters_early(spark):
    plan = catalog.QUERIES["busiest_unlinked_topk"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "l_comment" not in plan
    assert catalog.QUERIES["peer_gap_topk"](spark, "/root/testdata/sf0.001").count() == 20


def test_more_sources(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x.csv", "\ufeffa;b\r\n1;ą\r\n")
        z.writestr("y.csv", "no")
    assert [r.value for r in readers.zipped_lines(spark, str(tmp_path / "a.zip")).collect()] == ["a;b", "1;ą"]
    write = lambda name, *rows: (tmp_path / name).write_text("\n".join(json.dumps(r) for r in rows)) and str(tmp_path / name)
    t = readers.read_taxpayers(spark, write("t.jsonl", {"ja_kodas": "5", "pvm_kodas": "LT5", "pagrindine": "1", "isreg_data": "bad", "ekonomine_veikla__kodas": "563000"}, {"ja_kodas": None}), "f").collect()
    assert [(r.ja_kodas, r.vat_code, r.is_main_activity, r.deregistered_on, r.activity_code, r.fetch_id) for r in t] == [(5, "LT5", True, None, "563000", "f")]
    premises = {"ja_kodas": "7", "trade_name": "Lapė", "address": "Liepų g. 1", "issued_on": "2024-02-03"}
    p = readers.read_premises(spark, write("p.jsonl", premises, premises), "f").collect()
    assert len(p) == 1 and (p[0].ja_kodas, str(p[0].issued_on)) == (7, "2024-02-03")
    w = readers.read_website_codes(spark, write("w.jsonl", {"place_id": "p", "host": "h.lt", "code": "1", "fetched_at": "2024-01-01T10:00:00Z"}), "2024-01").first()
    assert (w.site, w.run_month, w.fetched_at is not None) == ("https://h.lt", "2024-01", True)
    assert readers.read_manifest(spark, write("m.jsonl", {"lat": 1.5, "depth": 2, "status": "split"})).first().depth == 2
    (tmp_path / "o1.csv").write_text('place_id,ja_kodas,action,reason,analyst,decided_on\np,1, SET ,"two\nlines",a,\n')
    (tmp_path / "o2.csv").write_text("place_id,ja_kodas,action,reason,analyst,decided_on,extra\nq,,reject,no,b,2024-05-06,z\n")
    o = {r.place_id: r for r in readers.read_overrides(spark, [str(tmp_path / "o1.csv"), str(tmp_path / "o2.csv")]).collect()}
    assert (o["p"].action, o["p"].decided_on, o["p"].reason) == ("set", None, "two\nlines") and (o["q"].ja_kodas, str(o["q"].decided_on)) == (None, "2024-05-06")
    assert [r.place_id for r in readers.without_seen(spark.createDataFrame([("p",), ("z",)], "place_id string"), readers.read_csv_union(spark, [str(tmp_path / "o1.csv")]), ["place_id"]).collect()] == ["z"]
    spark.range(1).createOrReplaceTempView("there")
    assert readers.table_if_there(spark, "there").count() == 1 and readers.table_if_there(spark, "not_there") is None


def test_parsed_pages(spark):
    cells = "".join(f"<td>c{i} &amp;</td>" for i in range(12))
    page = f"<table><tr><td>x</table><TABLE class=a><tr><th>h</th></tr><tr>{cells}</tr><tr><td>short</td></tr></TABLE>"
    rows = readers.table_rows(spark.createDataFrame([(1, page), (2, None), (3, "<table></table>")], "id int, html string"), readers.PREMISES_CELLS).collect()
    assert len(rows) == 1 and rows[0].id == 1 and rows[0].address == "c7 &" and rows[0].risk_group == "c11 &"
    mark = "<tr><td><a href='/trademark/details/9'>x</a></td><td>LAPĖ</td><td/><td>9</td><td></td><td></td><td>43, 44,</td><td></td><td>Registruotas</td></tr><tr><td>no</td></tr>"
    m = readers.trademark_rows(spark.createDataFrame([(f"<table>{mark}</table>",)], "html string")).collect()
    assert [(r.application_no, r.text, r.classes, r.status) for r in m] == [("9", "LAPĖ", ["43", "44"], "Registruotas")]
    detail = "<body><p>(540)</p><p>LAPĖ</p><div>(732)</div><b>Pavadinimas</b><i>UAB Lapė</i><b>Adresas</b><i>Vilnius</i></body>"
    o = readers.trademark_owners(spark.createDataFrame([(detail,), ("<p>(732)</p>",)], "html string")).collect()
    assert [(r.mark, r.owner_name, r.owner_address) for r in o] == [("LAPĖ", "UAB Lapė", "Vilnius")]
    responses = spark.createDataFrame([(b"<!DOCTYPE html>", "", "json"), (b"{}", "application/json", "json"), (b"<html>", "text/html", None), (b"Access denied", "", "html"), (None, None, "csv")], "c binary, t string, e string")
    assert [r.b for r in responses.select(readers.blocked(F.col("c"), F.col("t"), F.col("e")).alias("b")).collect()] == [True, False, False, True, False]


def test_more_sinks(spark, tmp_path):
    old = spark.createDataFrame([("m", "primary", "p", 1), ("m", "fallback", "p", 2)], "run_month string, stage string, place_id string, ja_kodas int")
    new = spark.createDataFrame([(7, "p", "fallback", "m")], "ja_kodas int, place_id string, stage string, run_month string")
    assert {r.ja_kodas for r in sinks.replaced(old, new, ["run_month", "stage", "place_id"]).collect()} == {1, 7}
    assert sinks.appended(old, new.drop("stage")).where("stage IS NULL").first().ja_kodas == 7
    with pytest.raises(ValueError, match="unknown"):
        sinks.appended(old, new.withColumn("more", F.lit(1)))
    none = spark.createDataFrame([], "fetch_id string, source string, url string, fetched_at timestamp, path string, sha256 string, bytes long, row_count long, run_month string")
    made = lambda content: spark.createDataFrame([("a", content, 3)], "path string, content binary, row_count long")
    one = sinks.recorded_fetch(none, made(b"x"), "s", "u", "2024-01")
    two = sinks.recorded_fetch(one, made(b"yy"), "s", "u", "2024-02").collect()
    assert len(two) == 1 and (two[0].bytes, two[0].run_month, len(two[0].fetch_id)) == (2, "2024-02", 16)
    sinks.write_jsonl(old, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    leads = spark.createDataFrame([("m", 1), ("n", 2)], "run_month string, ja_kodas int")
    sinks.export_month({"links": (old, "month"), "taxes": (leads, "leads"), "fetches": (none, "all")}, str(tmp_path / "e"), "m", leads)
    assert spark.read.parquet(str(tmp_path / "e/taxes.parquet")).count() == 1 and "path" not in spark.read.parquet(str(tmp_path / "e/fetches.parquet")).columns
    with pytest.raises(ValueError, match="rows"):
        sinks.markdown(spark.range(1001))
