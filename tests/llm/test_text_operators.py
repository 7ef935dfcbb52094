"""Periodic runs, fill-in-middle and license scans against brute force, on nulls, empty and long texts, repeats and odd columns."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from veinstone.llm import fill_in_middle, license_scan, periodic_runs

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
#: Columns besides id and text have names that the operators use themselves.
SCHEMA = "doc_id long, text string, id long, n int, units string, h double, form string, runs string, matches int"
EXTRA = (1, 2, "x", 0.5, "y", "z", 3)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, *EXTRA) for i, t in rows], SCHEMA)


def slow_runs(w, least=24, times=3):
    best = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, times * q):
                best.setdefault((i, j + q), q)
            i = j
    return sorted((a, b - a, q) for (a, b), q in best.items())


def odd_texts(rng):
    words = lambda n, k: [f"w{rng.randrange(k)}" for _ in range(n)]
    out = [None, "", " \n\t ", "a", "a " * 23, "a " * 24, "a\tb\n" * 12, "é 日本 x " * 40, "a b " * 30 + "a c " * 30, "x " * 3000]
    for _ in range(60):
        unit, more = words(rng.randrange(1, 12), 6), words(rng.randrange(0, 30), 3)
        out.append(" ".join(words(rng.randrange(0, 40), 5) + unit * rng.randrange(2, 9) + unit[: rng.randrange(len(unit))] + more + unit * 4))
    out += [" ".join(words(200, 2)) for _ in range(20)] + [" ".join((words(3, 3) * 9 + words(2, 3)) * 5)] + [" ".join(words(3000, 900) * 4)]
    return out


@pytest.mark.parametrize(("least", "times"), [(24, 3), (6, 2), (9, 4)])
def test_runs_against_brute_force(least, times):
    rng = random.Random(11)
    for k in range(400):
        w = [rng.randrange(1 + k % 3) for _ in range(rng.randrange(0, 90))]
        if k % 2:
            unit = [rng.randrange(4) for _ in range(1 + rng.randrange(9))]
            w = w[:20] + unit * rng.randrange(2, 12) + unit[: rng.randrange(len(unit))] + w[20:]
        got = [tuple(r) for r in periodic_runs.runs_of(np.array(w, np.int64), least, times).tolist()]
        assert got == slow_runs(w, least, times), w


def test_periodic_runs_query(spark, tmp_path):
    texts = odd_texts(random.Random(12))
    rows = [*enumerate(texts), (None, "b " * 30), (3, "a"), (3, "a")]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    expected = []
    for i, text in rows:
        w = SPACED.findall(text or "")
        if i is not None and zlib.crc32(str(i).encode()) % 10 == 0 and w:
            g, n = zlib.crc32(str(i).encode()) // 10, len(w)
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        runs = slow_runs(w)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
        lines, left = "".join("%d,%d,%d\n" % r for r in runs), " ".join(x for k, x in enumerate(w) if k not in gone)
        expected.append((i, len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest()))
    out = periodic_runs.op11_periodic_runs(spark, str(tmp_path))
    assert out.columns == "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(expected, key=repr)
    assert any(r[1] > 1 for r in expected)


def test_long_texts_have_their_runs_found_in_time():
    n = 300_000
    w = np.arange(n) % 1000
    assert periodic_runs.runs_of(w).tolist() == [[0, n, 1000]] and periodic_runs.runs_of(np.zeros(n, np.int64)).tolist() == [[0, n, 1]]


UNITS = {
    "line": r"[^\n]*\n|[^\n]+", "character": r"[\s\S]", "word": r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*|[\x20\x09-\x0D]+", "paragraph": r"(?:(?!\n\n[^\n])[\s\S])*\n\n(?=[^\n])|[\s\S]+",
    "sentence": r"(?:(?![.!?][\x20\x09-\x0D][^\x20\x09-\x0D])[\s\S])*[.!?][\x20\x09-\x0D](?=[^\x20\x09-\x0D])|[\s\S]+",
}


@pytest.mark.parametrize("units", UNITS)
def test_units_are_those_of_their_grammar(spark, units):
    rng = random.Random(13)
    texts = ["".join(rng.choice("ab. !\n\n\té\U0001f600\r") for _ in range(rng.randrange(0, 60))) for _ in range(300)] + ["", "\n", "\n\n\n", "\U0001f600" * 5]
    got = spark.createDataFrame([(t,) for t in texts], "text string").select("text", fill_in_middle.units_of(fill_in_middle.F.col("text"), units).alias("u")).collect()
    for r in got:
        assert r.u == re.findall(UNITS[units], r.text), repr(r.text)


def test_fill_in_middle_query(spark, tmp_path):
    rng = random.Random(14)
    texts = [None, "", "\n", "one line", "has <P> in it", "a<S", "<M>", "é\U0001f600\r\nb\n\n"] + ["".join(rng.choice("ab <>PSM\n\né") for _ in range(rng.randrange(1, 90))) for _ in range(150)] + ["line\n" * 30_000]
    rows = [*enumerate(texts), (None, "a\nb\nc"), (7, "x\ny"), (7, "x\ny")]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    expected = []
    for i, text in rows:
        text = text or ""
        u = re.findall(r"[^\n]*\n|[^\n]+", text)
        x = sha(f"7:{'' if i is None else i}")
        h = [int(x[8 * k : 8 * k + 8], 16) for k in range(4)]
        low, high = sorted(h[k] % (len(u) + 1) for k in (0, 1))
        a, b, c = "".join(u[:low]), "".join(u[low:high]), "".join(u[high:])
        form = "plain" if not text or re.search("<[PSM]>", text) else "spm" if h[3] % 100 < 50 else "psm"
        out = {"plain": text, "psm": f"<P>{a}<S>{c}<M>{b}", "spm": f"<S>{c}<P>{a}<M>{b}"}[form]
        expected.append((i, len(u), form, *((None, None) if form == "plain" else (len(a), len(b))), sha(out), sha(text)))
    out = fill_in_middle.op12_fill_in_middle(spark, str(tmp_path))
    assert out.columns == "doc_id n form prefix_chars middle_chars output_sha256 restored_sha256".split()
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(expected, key=repr)
    assert {r[2] for r in expected} == {"plain", "psm", "spm"}


def test_fill_in_middle_shares_and_sentinels(spark):
    d = frame(spark, [(i, f"a{i} b c. d\n") for i in range(2000)])
    own = ("[pre]", "[suf]", "[mid]")
    out = fill_in_middle.fill_in_middle(d, units="word", share=60, spm_share=25, seed=3, sentinels=own)
    out = out.withColumn("again", fill_in_middle.restored(fill_in_middle.F.col("output"), fill_in_middle.F.col("form"), own)).collect()
    assert all(r.again == f"a{r.id} b c. d\n" and r.n == 4 for r in out)
    made = [r for r in out if r.form != "plain"]
    assert abs(len(made) / 2000 - 0.6) < 0.05 and abs(sum(r.form == "spm" for r in made) / len(made) - 0.25) < 0.05
    assert all((r.prefix or "") + (r.middle or "") + (r.suffix or "") == r.again for r in made)


def license_texts(rng):
    out = [None, "", " - ", "The MIT License", "CC BY-NC 4.0, gnu General public\nlicense; Apache-License", "mit license mit license", "cc by", "cc  -- BY by cc by"]
    for label, template, _ in license_scan.TEMPLATES:
        def written(parts):
            made = []
            for p in parts:
                if isinstance(p, str):
                    made.append(rng.choice([p, p.upper(), p.title()]))
                elif p[0] == "any":
                    made += ["filler"] * rng.randrange(p[1] + 1)
                elif p[0] == "one":
                    made += rng.choice(p[1])
                elif rng.random() < 0.5:
                    made += written(p[1])
            return made

        w = written(license_scan.parsed(template))
        out += [" ".join(["before", *w, "after"]), rng.choice([", ", "\n", " -- "]).join(w)]
        k = next(i for i, x in enumerate(w) if i > len(w) // 2 and x != "filler")
        out += [" ".join([*w[:k], "otherwise", *w[k + 1 :]]), " ".join(w[: len(w) // 2]), " ".join([*w[:2], *w])]
    return out


def test_license_scan_query(spark, tmp_path):
    rng = random.Random(15)
    texts = license_texts(rng) + ["Released under the MIT License.\n" * 4000, "word " * 50_000 + "Licensed under CC BY 4.0"]
    rows = [*enumerate(texts), (None, "apache license"), (4, "mit license"), (4, "mit license")]
    frame(spark, rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    expected = []
    compiled = [(label, re.compile(r"(?:^| )" + license_scan.pattern(license_scan.parsed(t))), whole) for label, t, whole in license_scan.TEMPLATES]
    for i, text in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        base = [(k, label) for phrase, label in license_scan.PHRASES.items() for k in range(len(w)) if w[k : k + len(phrase.split())] == phrase.split()]
        line = " ".join(w) + " "
        hits = [(label, whole) for label, p, whole in compiled if p.search(line)]
        names = {label for _, label in base}
        score = 1.0 if any(x for _, x in hits) else 0.9 if hits else 0.5 if base else 0.0
        places = [k for k, _ in base]
        expected.append((i, len(w), len(base), min(places, default=None), max(places, default=None), ",".join(sorted(names)), ",".join(sorted(names | {x for x, _ in hits})), score))
    out = license_scan.op13_license_scan(spark, str(tmp_path))
    assert out.columns == "doc_id n_words n_base first_word last_word base_labels labels score".split()
    got = sorted(map(tuple, out.collect()), key=repr)
    for a, b in zip(got, sorted(expected, key=repr), strict=True):
        assert a == b, texts[a[0]] if a[0] is not None else a
    assert {x for r in expected for x in r[6].split(",")} >= {label for label, _, _ in license_scan.TEMPLATES}


def test_license_spans_and_own_templates(spark):
    own = [("note", "use <<one:it|them all>> freely <<optional>>and <<optional>>very <<end>>often<<end>> by <<any:2>> leave", False)]
    texts = ["Use it freely by leave", "x use them all freely and often by your kind leave y", "use it freely and very often by a b c leave", "use it freely very often by leave", "use it freely by leave use it freely by leave"]
    out = {r.id: r for r in license_scan.license_scan(frame(spark, list(enumerate(texts))), own, {}).collect()}
    assert [[(m.label, m.start, m.end) for m in out[i].matches] for i in range(5)] == [[("note", 0, 5)], [("note", 1, 11)], [], [], [("note", 0, 5), ("note", 5, 10)]]
    with pytest.raises(ValueError):
        license_scan.parsed("a <<optional>> b")


def test_text_operators_on_no_documents(spark):
    none = frame(spark, [])
    assert periodic_runs.periodic_runs(none).collect() == [] and fill_in_middle.fill_in_middle(none).collect() == [] and license_scan.license_scan(none).collect() == []


@pytest.mark.parametrize("name", ["op12_fill_in_middle", "op13_license_scan"])
def test_queries_equal_their_sql(spark, name):
    import duckdb

    from veinstone.llm import queries

    folder = "/root/testdata/sf0.01"
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    there = duckdb.sql(queries.ORACLES[name])
    here = queries.QUERIES[name](spark, folder)
    assert here.columns == there.columns
    assert sorted(map(tuple, here.collect())) == sorted(there.fetchall())
