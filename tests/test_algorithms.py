"""Order statistics, areas, neighbours, walks, work lists, paged sources and refreshed evidence against plain Python."""

import hashlib
import heapq
import itertools
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from veinstone.plans import brands, geo, likeness, ranks, refresh, reports, sites, sqlsurface, sweep, worklists
from veinstone.sources import paged, readers


def skewed(spark, n=20_000):
    rng = random.Random(1)
    rows = [(i, "large" if i % 3 else f"g{i % 7}", None if i % 50 == 1 else 5.0 if i % 4 == 0 else math.exp(rng.gauss(0, 2)), rng.randrange(4)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, kind string, v double, b int").repartition(5)


@pytest.mark.parametrize("descending", [False, True])
def test_positions_and_ranks(spark, descending):
    rows, df = skewed(spark, 3000)
    out = {r.id: r for r in ranks.positions(df, "v", within=("kind",), after=("b",), ties=("id",), descending=descending).collect()}
    sign = -1 if descending else 1
    for kind in {r[1] for r in rows}:
        own = sorted((r for r in rows if r[1] == kind), key=lambda r: (r[3], r[2] is None, sign * (r[2] or 0), r[0]))
        first = {}
        for k, r in enumerate(own, 1):
            first.setdefault((r[3], r[2]), k)
            assert (out[r[0]].row_number, out[r[0]].rank, out[r[0]].group_rows) == (k, first[r[3], r[2]], len(own)), r


def test_no_range_holds_more_than_twice_its_share(spark, request):
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are one partition
    rows, df = skewed(spark)
    df = df.where("v IS NOT NULL")
    for group in (["kind"], []):
        sizes = [r["count"] for r in ranks.ranged(df, group, F.asc("v"), ()).groupBy("_part").count().collect()]
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert max(sizes) <= 2 * sum(sizes) / parts, sizes  # a third of the rows have one value, two thirds one group


def test_percentiles_medians_and_levels(spark):
    import numpy as np

    rows, df = skewed(spark, 3000)
    got = {r.kind: r for r in ranks.percentiles(ranks.positions(df.where("v IS NOT NULL"), "v", within=("kind",)), "v", ("kind",), {"p10": 0.1, "p50": 0.5, "p80": 0.8}).collect()}
    for kind, r in got.items():
        own = [v for _, k, v, _ in rows if k == kind and v is not None]
        assert np.allclose([r.p10, r.p50, r.p80], np.percentile(own, [10, 50, 80]))
    levels = ranks.level_medians(df, [("kind", "b"), ("kind",)], {"m": "v"}, F.max("id").alias("last"), least=60).collect()
    for r in levels:
        own = [x for x in rows if x[1] == r.kind and (r.lvl == 1 or x[3] == r.b)]
        assert r.n == len(own) >= 60 and r.last == max(x[0] for x in own) and math.isclose(r.m, np.median([x[2] for x in own if x[2] is not None]))
    assert {r.lvl for r in levels} == {1, 2} and all(r.b is None for r in levels if r.lvl == 1)
    assert ranks.medians(df.limit(0), "v", ("kind",)).collect() == []


def test_running_totals(spark):
    rows, df = skewed(spark, 2000)
    got = {r.id: r.total for r in ranks.running_totals(df, "b", "v", ties=("id",), descending=True).collect()}
    total = 0
    for i, _, v, b in sorted(rows, key=lambda r: (r[2] is None, -(r[2] or 0), r[0])):
        total += b
        assert got[i] == total


def metres(a, b):
    p1, p2 = math.radians(a[0]), math.radians(b[0])
    x = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6_371_000 * math.asin(math.sqrt(min(1.0, x)))


def test_nearest_neighbours(spark):
    rng = random.Random(2)
    at = [(54.6 + rng.gauss(0, 0.02), 25.2 + rng.gauss(0, 0.02)) for _ in range(250)] + [(54.7, 25.3)] * 5 + [(54.70001, 25.3)] + [(rng.uniform(-80, 80), rng.uniform(-170, 170)) for _ in range(60)] + [(88.9, 0.0), (88.9, 90.0)]
    rows = [(i, *p) for i, p in enumerate(at)]
    got = {r.id: r for r in geo.nearest(spark.createDataFrame([*rows, (1000, None, 1.0)], "id long, lat double, lng double").repartition(3)).collect()}
    assert got.keys() == set(range(len(at)))
    for i, *p in rows:
        d, j = min((round(metres(p, q), 6), j) for j, *q in rows if j != i)
        assert got[i].nearest == j and math.isclose(got[i].metres, d, abs_tol=1e-4), i
    one = geo.nearest(spark.createDataFrame([(7, 1.0, 2.0)], "id long, lat double, lng double")).collect()
    assert [(r.id, r.nearest, r.metres) for r in one] == [(7, None, None)] and geo.nearest(spark.createDataFrame([], "id long, lat double, lng double")).collect() == []


def slow_sweep(points, box, budget=None, most=20):
    """The searches one by one, by a heap."""
    deg = 111_320.0
    lat0, lng0, half0 = sweep.root_cell(box)
    out, heap, n = {}, [(0.0, 0, "", lat0, lng0, half0, 0)], 0
    while heap:
        _, _, path, lat, lng, half, depth = heapq.heappop(heap)
        if budget is not None and n >= budget:
            for x in [(0, 0, path), *heap]:
                out[x[2]] = ("budget_exhausted", 0)
            break
        n += 1
        radius, centre = half * math.sqrt(2), (round(lat, 6), round(lng, 6))
        near = sorted((d, i) for i, *q in points if (d := metres(centre, q)) <= round(min(radius, 50_000), 1))[:most]
        status = "complete" if len(near) < most else "split" if radius / 2 >= 75 else "truncated"
        out[path] = (status, len(near))
        if status != "split":
            continue
        at = {i: q for i, *q in points}
        covered = min(max(metres((lat, lng), at[i]) for _, i in near), radius)
        k = 2 if covered <= 0 else max(2, min(math.ceil(math.sqrt(most / (math.pi * covered**2) * (2 * half) ** 2 / 12)), 6, max(2, int(radius / 75))))
        child, aside = half / k, deg * math.cos(math.radians(lat))
        for i, (y, x) in enumerate(itertools.product(range(k), range(k))):
            la, ln, name = lat + (-half + child * (2 * y + 1)) / deg, lng + (-half + child * (2 * x + 1)) / aside, f"{path}/{i:02d}"
            corners = [(la + a * child / deg, ln + b * child / (deg * math.cos(math.radians(la)))) for a in (-1, 1) for b in (-1, 1)]
            if all(metres((lat, lng), c) < covered for c in corners):
                out[name] = ("covered_by_parent", 0)
            else:
                heapq.heappush(heap, (metres((lat0, lng0), (la, ln)), len(out) * 100 + i, name, la, ln, child, depth + 1))
    return out


def test_frontier_follows_the_searches(spark):
    rng = random.Random(3)
    box = (54.55, 24.95, 54.85, 25.55)
    points = [(i, 54.68 + rng.gauss(0, 0.01), 25.28 + rng.gauss(0, 0.02)) for i in range(700)] + [(700 + i, rng.uniform(54.5, 54.9), rng.uniform(24.9, 25.6)) for i in range(200)] + [(900 + i, 54.68, 25.2801) for i in range(30)]
    df = spark.createDataFrame(points, "id long, lat double, lng double")
    same = lambda d: {r.path: (r.status, r.n_results) for r in d.collect()}
    whole = slow_sweep(points, box)
    assert same(sweep.frontier(df, box)) == whole and {s for s, _ in whole.values()} == {"split", "complete", "truncated", "covered_by_parent"}
    for budget in (0, 1, 37, 90):
        assert same(sweep.frontier(df, box, budget=budget)) == slow_sweep(points, box, budget), budget
    assert {s for s, _ in same(sweep.frontier(df, box, budget=50, quota=10)).values()} >= {"split", "quota_exhausted"}
    assert same(sweep.frontier(df.limit(0), box)) == {"": ("complete", 0)}


def test_bound_of_likeness_loses_no_pair(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(rng.randrange(1, 8)))
    names = sorted({" ".join(word() for _ in range(rng.randrange(1, 4))) for _ in range(70)} | {"", "x", "é ū", "a b", "b a", "a b c"})
    df = spark.createDataFrame([(n,) for n in names], "name string")
    for least in (60, 80, 90):
        got = {(r.name, r.other): r.likeness for r in likeness.similar_names(df.withColumn("all", F.lit(1)), "name", ["all"], least).collect()}
        pairs = {(a, b): round(likeness.token_set_ratio(a, b), 1) for a, b in itertools.combinations(names, 2)}
        assert got == {p: x for p, x in pairs.items() if x >= least}
    p = df.select(likeness.profile(F.col("name")).alias("p"))
    share = p.crossJoin(p.withColumnRenamed("p", "q")).select(F.avg((likeness.most_likeness(F.col("p"), F.col("q")) >= 79.95).cast("int"))).first()[0]
    assert share < 0.6


def test_alike_names_of_large_blocks_meet_in_parts(spark, monkeypatch):
    rng = random.Random(6)
    monkeypatch.setattr(likeness, "PART", 16)
    word = lambda most=7: "".join(rng.choice("abcd") for _ in range(rng.randrange(1, most)))
    names = sorted({" ".join(word() for _ in range(rng.randrange(1, 5))) for _ in range(70)} | {"", "x", "é ū", "a b", "b a", "a b c", "a" * 64, "a" * 65, "x " * 40 + "yy", word(70) + " " + word(60)})
    df = spark.createDataFrame([(b, n) for b in ("one", "two", None) for n in names] * 2, "b string, name string")
    out = likeness.similar_names(df, "name", ["b"], 70)
    assert out.rdd.getNumPartitions() > 10  # one task held all pairs before
    pairs = {(a, b): round(likeness.token_set_ratio(a, b), 1) for a, b in itertools.combinations(names, 2)}
    pairs = {p: x for p, x in pairs.items() if x >= 70}
    rows = out.collect()
    assert {(r.b, r.name, r.other): r.likeness for r in rows} == {(b, *p): x for b in ("one", "two") for p, x in pairs.items()} and len(rows) == 2 * len(pairs)


def site(spark, pages, **options):
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    return {(r.site, r.turn): (r.url, r.page_id, r.depth) for r in sites.walk(df, **options).collect()}


def test_walk_of_links(spark):
    a = "http://A.lt"
    pages = [
        (1, "http://a.lt/", f'<a href="x">no hint</a><a href="/kontaktai#top">K</a><a href="{a}/kontaktai">again</a><a href="http://b.lt/contact">B</a><a href=""> About &amp; us</a><A HREF=\'gone\'>Privacy</A><a href="4">company</a><a href="5">company</a>'),
        (2, "http://a.lt/kontaktai", '<a href="/">about: back</a><a href="/deep">terms</a>'), (3, "http://a.lt/x", None), (4, "http://a.lt/4", ""), (9, "http://a.lt/4#twice", ""), (5, None, "x"), (6, "no address", "x"),
        (7, "https://a.lt/", "<p>no links"), (8, "http://c.lt/?q=1", '<a href="?q=1">about</a><a href="http://[broken">about</a>'), (10, "http://d.lt/1", '<a href="/2">about</a>'), (11, "http://d.lt/2", '<a href="/1">about</a><a href="/3">about</a>'), (12, "http://d.lt/3", '<a href="/2">about</a>'),
    ]
    out = site(spark, pages)
    assert {k: v for k, v in out.items() if k[0] == "http://a.lt"} == {
        ("http://a.lt", 0): ("http://a.lt/", 1, 0), ("http://a.lt", 1): ("http://a.lt/kontaktai", 2, 1), ("http://a.lt", 2): ("http://A.lt/kontaktai", None, 1) if ("http://a.lt", 2) in out and out["http://a.lt", 2][0].startswith("http://A") else ("http://a.lt/gone", None, 1), ("http://a.lt", 3): out["http://a.lt", 3],
    }
    assert out["https://a.lt", 0][1] == 7 and ("https://a.lt", 1) not in out and ("http://c.lt", 1) not in out and ("http://b.lt", 0) not in out
    assert [out["http://d.lt", k][1] for k in range(2)] == [10, 11] and ("http://d.lt", 2) not in out
    assert [site(spark, pages, deepest=3)["http://d.lt", k][1:] for k in range(3)] == [(10, 0), (11, 1), (12, 2)]
    assert site(spark, pages, others=True)["http://a.lt", 3][1:] != (None,) and site(spark, []) == {}


def test_walk_of_a_large_site(spark):
    rows = [(i, f"http://big.lt/{i}", "".join(f'<a href="/{(i * 7 + k) % 10_000}">about</a>' for k in range(1, 4))) for i in range(10_000)]
    out = site(spark, rows, deepest=3, most=30)
    seen, frontier, order = ["0"], ["0"], {}
    for _ in range(3):
        new = []
        for u in frontier:
            new += [t for k in range(1, 4) if (t := str((int(u) * 7 + k) % 10_000)) not in seen and t not in new]
        frontier = new[: 30 - len(seen)]
        seen += frontier
    assert [out["http://big.lt", k][0].rpartition("/")[2] for k in range(len(seen))] == seen and len(out) == len(seen) == 30 and not order


def test_request_keys_are_those_of_sorted_json(spark):
    rows = [("Žuvis \"a\"\\\n\t\U0001f600", 5, 54.25, True, ["x", "ą"], {"b": 1, "a": 2}, ("y", 1.5)), (None, None, None, None, None, None, None), ("", -1, 50000.0, False, [], {}, (None, None))]
    schema = "query string, n long, radius double, parse boolean, types array<string>, extra map<string, int>, centre struct<zeta: string, alpha: double>"
    df = spark.createDataFrame(rows, schema).coalesce(1)
    names = ["query", "n", "radius", "parse", "types", "extra", "centre"]
    for row, r in zip(rows, df.select(worklists.request_key(df, names).alias("k"), worklists.request_key(df, names[::-1]).alias("again")).collect(), strict=True):
        body = dict(zip(names, row, strict=True))
        body["centre"] = dict(zip(("zeta", "alpha"), row[6], strict=True)) if row[6] else None
        assert r.k == r.again == hashlib.sha256(json.dumps(body, sort_keys=True).encode()).hexdigest()[:24], json.dumps(body, sort_keys=True)


def test_work_list_under_a_budget(spark):
    rng = random.Random(5)
    rows = [(f"k{rng.randrange(400)}", None if i % 40 == 0 else float(rng.randrange(12)), rng.randrange(1, 5)) for i in range(600)]
    df = spark.createDataFrame(rows, "key string, priority double, cost int").repartition(4)
    have = {f"k{i}" for i in range(0, 400, 5)}
    out = {r.key: r for r in worklists.work_list(df, spark.createDataFrame([(k,) for k in have], "key string"), 300, spent=100, cost="cost").collect()}
    best = {}
    for k, p, c in rows:
        q, d = best.get(k, (None, 0))
        best[k] = (p if q is None else q if p is None else max(p, q), max(c, d))
    total = 0
    for k, (p, c) in sorted(((k, x) for k, x in best.items() if k not in have), key=lambda kx: (kx[1][0] is None, -(kx[1][0] or 0), kx[0])):
        total += c
        assert (out[k].total, out[k].status) == (total, "to_fetch" if total <= 200 else "budget_exhausted")
    assert all(out[k].status == "cached" for k in have & best.keys()) and out.keys() == best.keys()


def test_search_targets(spark):
    m = "2024-05"
    places = spark.createDataFrame([(m, f"p{i}", i != 3, i == 4, None if i == 9 else i * 10, f"n{i}", "s", "1") for i in range(10)], "run_month string, place_id string, in_scope boolean, self_service boolean, user_rating_count int, name string, street string, street_number string")
    links = spark.createDataFrame([(m, f"p{i}", "linked" if i % 2 else "ambiguous", "fallback" if i == 7 else "primary") for i in range(10)], "run_month string, place_id string, status string, stage string")
    out = [(r.place_id, r.purpose) for r in worklists.search_targets(places, links, m, least_reviews=20, fallback=3, validation=2).collect()]
    assert out[:3] == [("p8", "fallback"), ("p7", "fallback"), ("p6", "fallback")] and all(p in {"p1", "p5", "p9"} and w == "validation" for p, w in out[3:]) and len(out) == 5
    assert worklists.unsearched(places, places.where("user_rating_count > 30")).count() == 5


def test_paged_source_takes_filters_and_columns(spark, tmp_path):
    rows = [{"id": i, "who": {"ref": None} if i % 4 == 0 else {"code": f"c{i % 3}", "more": {"deep": i}}, "on": f"2024-01-{i % 28 + 1:02d}", "extra": [1]} for i in range(50)]
    for k in range(0, 50, 20):
        (tmp_path / f"{k:03d}.json").write_text(json.dumps({"_data": rows[k : k + 20], "_page": {"next": str(k + 20)}}))
    (tmp_path / "900.json").write_text(json.dumps({"_data": []}))
    paged.register(spark)
    df = spark.read.format("paged_json").schema("id long, who__code string, who__more__deep long, on date").load(str(tmp_path))
    some = df.where("id >= 10 AND who__code = 'c1' AND id % 2 = 1")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "% 2) = 1" in plan and ">= 10" not in plan and "= c1" not in plan and df.rdd.getNumPartitions() == 4  # what the source takes is no filter of Spark's any more
    assert [tuple(r)[:3] for r in some.orderBy("id").collect()] == [(i, "c1", i) for i in range(10, 50) if i % 3 == 1 and i % 2 and i % 4]
    assert df.where("who__code IS NULL").count() == 13 and df.agg(F.max("on")).first()[0].isoformat() == "2024-01-28"
    with pytest.raises(Exception, match="no such type"):
        spark.read.format("paged_json").schema("id array<long>").load(str(tmp_path)).collect()


def test_refreshed_evidence_equals_a_full_rebuild(spark):
    reply = lambda i, code, name="lape": (f"p{i}", name, f"{name} rekvizitai", f"Įmonės kodas: {code:09d}")
    schema = "place_id string, name string, title string, desc string"
    before = spark.createDataFrame([reply(i, i) for i in range(8)] + [reply(1, 77)], schema)
    after = spark.createDataFrame([reply(1, 77), reply(1, 1), reply(2, 99), reply(3, 3, "vilkas"), *(reply(i, i) for i in (0, 5, 6, 7)), reply(20, 20)], schema)
    parsed = []

    def parse(cache):
        parsed.append({r.place_id for r in cache.collect()})
        return brands.search_codes(cache)

    rows, now, changed = refresh.refreshed(brands.search_codes(before), after, refresh.digests(before), parse)
    key = lambda d: sorted(map(tuple, d.select("place_id", "code", "hits", "hits_named").collect()))
    assert key(rows) == key(brands.search_codes(after)) and parsed == [{"p2", "p3", "p20"}]
    assert {(r.place_id, r.change) for r in changed.collect()} == {("p2", "changed"), ("p3", "changed"), ("p4", "deleted"), ("p20", "added")}
    assert refresh.refreshed(rows, after, now, parse)[2].count() == 0 and refresh.refreshed(rows, after, now, parse, version="2")[2].count() == 8


@pytest.mark.parametrize(
    "text",
    [
        "SELECT reflect('java.lang.System', 'setProperty', 'a', 'b')", "SELECT * FROM parquet.`/root/testdata/sf0.001/nation.parquet`", "WITH x AS (SELECT java_method('java.lang.System', 'getenv', 'HOME') AS h) SELECT * FROM x", "DROP VIEW v",
        "SELECT * FROM v WHERE id IN (SELECT id FROM csv.`/etc/passwd`)", "SELECT (SELECT max(try_reflect('java.lang.System', 'lineSeparator'))) FROM v", "CREATE TABLE t AS SELECT 1", "INSERT INTO v SELECT 1", "SET a = b", "SELECT TRANSFORM(id) USING 'cat' AS x FROM v",
    ],
)
def test_console_refuses(spark, text):
    spark.range(3).createOrReplaceTempView("v")
    with pytest.raises(PermissionError):
        sqlsurface.read_only(spark, text)


def test_console_reads(spark):
    spark.range(5).createOrReplaceTempView("v")
    assert sqlsurface.read_only(spark, "WITH x AS (SELECT id FROM v WHERE id > :low) SELECT count(*) AS n FROM x WHERE id IN (SELECT id FROM v) AND EXISTS (SELECT 1 FROM v)", low=2).first().n == 2


def test_snapshots_of_all_months(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "id long, x string").write.parquet(f"{tmp_path}/2024-05/t.parquet")
    spark.createDataFrame([(2, "b", 3)], "id long, x string, more int").write.parquet(f"{tmp_path}/2024-06/t.parquet")
    assert sorted(tuple(r) for r in readers.read_snapshots(spark, str(tmp_path), "t").select("id", "x", "more").collect()) == [(1, "a", None), (2, "b", 3)]


def test_detail_and_quality_views(spark):
    m = "2024-05"
    checks = spark.createDataFrame([(m, "a", "warn", True), (m, "b", "error", False), (m, "c", "error", None), ("2024-04", "a", "warn", False)], "run_month string, check_name string, severity string, passed boolean")
    fetches = spark.createDataFrame([("s", "1", "f1", 5), ("s", "2", "f2", 7), ("t", "1", "f3", None)], "source string, fetched_at string, fetch_id string, row_count int")
    views = reports.quality_view(checks, fetches, m)
    assert [r.check_name for r in views["Checks"].collect()] == ["b", "c", "a"] and [(r.source, r.fetch_id, r.row_count) for r in views["Sources"].collect()] == [("s", "f2", 7), ("t", "f3", None)]
