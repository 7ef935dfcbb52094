"""The corpus operators on small fixtures with nulls, empty and long texts, ties, repeats, and against brute force."""

import hashlib
import itertools
import random
import re
import time
import zlib
from collections import Counter

import pytest

from veinstone.llm import common, fingerprints, html_extraction, mixing, near_dedup, packing, quality_rules, resampling, substring_dedup, toxicity, warc

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, h string"


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}x" + ("." if rng.random() < 0.1 else "") for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    passage = prose(rng, 70, 5000)
    out = [(i, prose(rng, rng.randrange(60, 300), 3000), "en", f"s{i % 5}", 0, 1, "x") for i in range(60)]
    out += [(100 + i, t, "en", "s0", 0, 1, "x") for i, t in enumerate([out[0][1], out[0][1], out[1][1] + " more words", f"{prose(rng, 40)} {passage} {prose(rng, 30)}", f"{prose(rng, 25)} {passage} {prose(rng, 44)}"])]
    out += [(200, None, "en", None, None, None, None), (201, "", None, "s1", 0, None, None), (202, " \n\t ", "en", "s2", 3, 1, "x"), (203, "a b", "fr", "", 3, 1, "x"), (204, "a b", "fr", "", 3, 1, "x"), (205, "é 日本 " * 3000, "xx", "s3", 1, 1, "x")]
    return out + [(206, "Über *** ### same line\nsame line\nsame line\n" * 30, "de", "s4", 1, 1, "x"), (None, "no id here at all", "en", "s1", 1, 1, "x")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, key="id"):
    return {r[key]: r for r in df.collect()}


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(25)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    expected = {x: find(x) for x in parent if find(x) != x}
    got = {r["id"]: r["component"] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == expected


def test_packing_is_a_round_trip(docs, rows, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {r[0]: [*t.encode(r[1] or "", add_special_tokens=False).ids, 1] for r in rows}
    pieces, sequences = {}, {}
    for p in packing.pack(docs).collect():
        part = b"".join(i.to_bytes(4, "little") for i in ids[p.doc_id][p.start : p.start + p.length])
        assert p.doc_tokens == len(ids[p.doc_id]) and zlib.crc32(part) == p.ids_crc32
        pieces.setdefault(p.doc_id, []).append((p.start, p.length))
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert pieces.keys() == ids.keys()
    for parts, total in [*((v, len(ids[k])) for k, v in pieces.items()), *((v, None) for v in sequences.values())]:
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == total if total is not None else at <= packing.WINDOW
    assert packing.pack(empty).collect() == []


@pytest.mark.parametrize("text", ["a  b\n\nc\t d <|endoftext|> x's it'll", " lead", "trail \n", "a\nb\r\nc", "é 日本語 1234 a　b\x1c c\0d", "\n", "x," * 5])
def test_cached_tokens_equal_the_tokenizer(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert packing.tokens_of_worker(None).with_added(text).tolist() == t.encode(text, add_special_tokens=False).ids


def test_packing_takes_literal_special_tokens_as_one_id(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>\n x", "end  <|endoftext|>", "a<|endoftext|", "<|endoftext|> lead\tt <|endoftext|>é"]
    out = {p.doc_id: p for p in packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), with_ids=True).collect()}
    for k, text in enumerate(texts):
        ids = [*t.encode(text, add_special_tokens=False).ids, 1]
        assert out[k].ids == ids and out[k].doc_tokens == len(ids) and out[k].ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids)), text


def test_packed_windows_are_full_and_whole():
    import numpy as np

    lengths = np.random.default_rng(2).integers(1, 2048, 3000)
    full, rest = packing.packed(lengths)
    assert all(sum(n for _, _, n in row) == packing.WINDOW for row in full) and sum(n for _, _, n in rest) < packing.WINDOW
    used = np.zeros(len(lengths), int)
    for k, _, n in [p for row in [*full, rest] for p in row]:
        used[k] += n
    assert (used == lengths).all()


def test_quality_rules_measures(docs, rows, empty):
    got = by_id(quality_rules.quality_rules(docs))
    for doc_id, text, *_ in rows:
        w = WORDS.findall(text or "")
        lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
        triples = Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {k for i, t in enumerate(zip(w, w[1:], w[2:], strict=False)) if triples[t] > 1 for k in (i, i + 1, i + 2)}
        r = got[doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)), doc_id
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and not (r.kept and r.base_failed)
    assert all(got[i].kept for i in range(60)) and quality_rules.quality_rules(empty).collect() == []


def test_fingerprints_follow_generalised_jaccard(docs, rows, empty):
    got = by_id(fingerprints.fingerprints(docs))
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    true, found = [], []
    for k, r in enumerate(order):
        text, after = r[1] or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert got[r[0]].n_chars == len(text) and got[r[0]].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b = Counter(WORDS.findall(text)), Counter(WORDS.findall(edited))
        if a or b:
            true.append(sum((a & b).values()) / sum((a | b).values()))
            found.append(got[r[0]].near_edited)
        b = Counter(WORDS.findall(after))
        if a or b:
            true.append(sum((a & b).values()) / sum((a | b).values()))
            found.append(got[r[0]].near_next)
    errors = [a - b for a, b in zip(true, found, strict=True)]
    assert abs(sum(errors)) / len(true) < 0.04 and (sum(e * e for e in errors) / len(errors)) ** 0.5 < 0.097 and max(map(abs, errors)) < 4 * 0.08
    assert got[100].fingerprint == got[101].fingerprint == got[0].fingerprint and got[101].near_next == 1.0
    assert fingerprints.fingerprints(empty).collect() == []


def test_fingerprints_of_many_equal_ids(spark):
    rng = random.Random(31)
    rows = [(None if i % 3 else 7 if i % 2 else i, prose(rng, 12), i) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, range int")
    out = fingerprints.fingerprints(df).collect()
    by_text = {}
    for r in out:
        by_text.setdefault(r.id, []).append(r)
    assert len(out) == 400 and {k: len(v) for k, v in by_text.items()} == Counter(r[0] for r in rows)
    found = {r.edited_sha256 for r in out}
    texts = {(i, t) for i, t, _ in rows}
    edited = lambda t, after: hashlib.sha256((t[: len(t) - len(t) // 2] + after[: len(t) // 2]).encode()).hexdigest()
    follows = {a: b for a in texts for b in texts if a != b and edited(a[1], b[1]) in found}
    at, seen = next(iter(texts)), set()
    while at not in seen:  # the next of the next and so on is every row once
        seen.add(at)
        at = follows[at]
    assert len(found) == len(follows) == len(seen) == 400


def test_near_dedup_against_brute_force(spark, docs, rows, empty):
    rng = random.Random(5)
    base = prose(rng, 150, 5000).split()
    many = list(rows)
    for i in range(40):  # variants at different distances, some of them linked only through others
        w = list(base)
        for _ in range(rng.randrange(0, 9)):
            w[rng.randrange(len(w))] = f"z{rng.randrange(9999)}"
        many.append((300 + i, " ".join(w), "en", "s0", 0, 1, "x"))

    def shingles(text):
        w = (text or "").encode().lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = {r[0]: shingles(r[1]) for r in many if r[0] is not None}
    low = {k: k for k in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            if low[a] != low[b]:
                low[a] = low[b] = min(low[a], low[b])
                changed = True
    got = by_id(near_dedup.near_dedup(spark.createDataFrame(many, SCHEMA).repartition(4)))
    assert {k: (len(sets[k]), low[k], low[k] == k) for k in sets} == {k: (r.n_shingles, r.component, r.kept) for k, r in got.items() if k is not None}
    assert got[None].component is None and got[None].kept
    assert near_dedup.near_dedup(empty).collect() == []


def test_mixing_targets_and_shares(docs, rows, empty):
    d, segments = mixing.mixed(docs, block=64)
    out = mixing.taken(docs, block=64).collect()
    assert len(out) == len(rows)
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(WORDS.findall(r[1] or ""))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, left = {}, set(order)
    while True:
        rest = 1.5 * sum(sizes.values()) - sum(target.values())
        full = {s for s in left if rest * weight[s] / sum(weight[x] for x in left) > 2 * sizes[s]}
        if not full:
            break
        target |= {s: 2.0 * sizes[s] for s in full}
        left -= full
    target |= {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
    got = Counter()
    for r in out:
        assert r.taken <= 2 * r.size and r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6
        got[r.source] += r.taken
    parts = segments.collect()
    slots = round(sum(target.values()) / 64)
    u = [((i + 1) * mixing.GOLDEN) % 1 for i in range(slots)]
    high = list(itertools.accumulate(target[s] / sum(target.values()) for s in order))
    drawn = Counter(next((s for s, h in zip(order, high, strict=True) if x < h), order[-1]) for x in u)
    assert all(got[s] == min(64 * drawn[s], 2 * sizes[s]) and abs(64 * drawn[s] - target[s]) <= 3 * 64 for s in order)
    assert sum(r.words for r in parts) == sum(got.values()) and {r.slot for r in parts} <= set(range(slots))
    for k in range(0, slots, 97):  # any stretch of the schedule holds a source about as often as its share says
        seen = Counter(next((s for s, h in zip(order, high, strict=True) if x < h), order[-1]) for x in u[k : k + 200])
        assert all(abs(seen[s] - len(u[k : k + 200]) * target[s] / sum(target.values())) <= 4 for s in order)
    assert mixing.taken(empty).collect() == []


def test_resampling_prefers_good_text(spark, empty):
    rng = random.Random(8)
    good = [(i, prose(rng, 80, 200)) for i in range(60)]
    bad = [(100 + i, " ".join(f"j{rng.randrange(3000)}" for _ in range(80))) for i in range(20)]
    df = spark.createDataFrame([*good, *bad, (500, None), (501, "")], "doc_id long, text string")
    out = by_id(resampling.resample(df, spark.createDataFrame([(i,) for i in range(0, 60, 2)], "doc_id long"), 0.7))
    assert sum(out[i].kept for i, _ in good) >= 55 and not out[500].kept and sum(r.kept for r in out.values()) == round(0.7 * 82)
    keys = sorted((r.key for r in out.values() if r.key is not None), reverse=True)
    assert {r.key for r in out.values() if r.kept} == set(keys[: round(0.7 * 82)])
    assert resampling.resample(empty, empty, 0.5).collect() == []


@pytest.mark.parametrize("few", [1, 5000])
def test_kth_highest(spark, few):
    keys = [(float(i % 7), i) for i in range(50)]
    df = spark.createDataFrame(keys, "key double, id long")
    order = sorted(keys, key=lambda k: (-k[0], k[1]))
    for k in (1, 8, 25, 50):
        key, last = resampling.kth_highest(df, k, few=few)
        assert key == order[k - 1][0] and (last is None or last == order[k - 1][1])
    assert resampling.kth_highest(df, 51) is None


def test_substring_dedup_cuts_the_shared_passage(docs, rows, empty):
    out = by_id(substring_dedup.substring_dedup(docs))
    text = {r[0]: r[1] for r in rows}
    assert out[103].text == text[103] and out[104].removed_words >= 70 and len(out[104].text.split()) <= 70
    assert out[100].text == "" and out[101].text == "" and all(out[i].text == text[i] for i in range(60))
    assert out[200].text is None and out[201].text == "" and out[205].text == text[205] and out[None].text == text[None]
    assert substring_dedup.substring_dedup(empty).collect() == []


def test_passages_with_a_changed_word_meet():
    import numpy as np
    import pyarrow as pa

    from veinstone.llm.shingles import Words, windows

    rng = random.Random(23)

    def met(n, changed):
        """Whether a passage of n words meets its copy with other words at the places ``changed``, in other surroundings."""
        passage = prose(rng, n, 50000).split()
        copy = [f"changed{rng.randrange(99)}" if i in changed else w for i, w in enumerate(passage)]
        texts = [" ".join([prose(rng, rng.randrange(20, 60), 50000), *p, prose(rng, rng.randrange(20, 60), 50000)]) for p in (passage, copy) if p]
        words = Words(pa.array([t.encode() for t in texts], pa.binary()))
        grams = windows(words.hashes, substring_dedup.WIDTH)
        at = substring_dedup.minima(grams, words.at)
        return bool(set(grams[at[at < words.at[1]]].tolist()) & set(grams[at[at >= words.at[1]]].tolist()))

    for n in (50, 52, 55, 60, 80):
        middle, anywhere, adjacent = (np.mean([met(n, places) for places in cases]) for cases in ([{n // 2}] * 300, [{rng.randrange(n)} for _ in range(300)], [{n // 2, n // 2 - 1}] * 300))
        assert middle >= 0.99 and anywhere >= 0.99 and adjacent >= 0.95, (n, middle, anywhere, adjacent)
    assert np.mean([met(75, {25, 50}) for _ in range(300)]) >= 0.95


def test_substring_dedup_cuts_passages_with_a_changed_word(spark):
    rng = random.Random(21)
    rows = []
    for k in range(40):
        passage = prose(rng, (51, 55, 60, 80)[k % 4], 50000).split()
        changed = list(passage)
        changed[len(passage) // 2] = "changed"
        rows += [(k, f"{prose(rng, 50, 50000)} {' '.join(passage)} {prose(rng, 40, 50000)}"), (100 + k, f"{prose(rng, 35, 50000)} {' '.join(changed)} {prose(rng, 60, 50000)}")]
    out = by_id(substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")))
    assert [k for k in range(40) if out[100 + k].removed_words < (51, 55, 60, 80)[k % 4] - 2] == []
    assert all(out[k].removed_words == 0 for k in range(40))


def test_substring_dedup_of_texts_that_repeat_themselves(spark):
    rng = random.Random(24)
    pair = lambda n: " ".join(["over again"] * n)
    rows = [(i, f"{prose(rng, 60, 50000)} {pair(40 + 3 * i)} {prose(rng, 60, 50000)}") for i in range(12)]
    out = by_id(substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")))
    assert out[0].removed_words == 0
    for i in range(1, 12):
        assert out[i].text.count("over again") <= 24 and out[i].removed_words <= 2 * (40 + 3 * i)


def test_substring_dedup_behind_partial_earlier_quotes(spark):
    rng = random.Random(22)
    rows = []
    for k in range(60):  # the first document holds too little of the passage that the two others share
        passage = prose(rng, 50 + k % 12, 50000).split()
        at = 0 if k % 2 else len(passage) - 45
        for d, part in enumerate((passage[at : at + 45], passage, passage)):
            rows.append((1000 * d + k, f"{prose(rng, 30 + 7 * d, 50000)} {' '.join(part)} {prose(rng, 50 - 9 * d, 50000)}"))
    out = by_id(substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)))
    seen: set[tuple] = set()
    for i, text in sorted(rows):  # brute force: an earlier document holds no 50 words that are left here
        left = (out[i].text or "").lower().split()
        assert not seen & {tuple(left[k : k + 50]) for k in range(len(left) - 49)}, i
        words = text.lower().split()
        seen |= {tuple(words[k : k + 50]) for k in range(len(words) - 49)}
    assert all(out[i].removed_words == 0 for i in range(60)) and all(out[1000 + i].removed_words == 0 for i in range(60))


def test_archives_round_trip_and_checks(spark):
    big = "x" * 1500 + "é"
    pages = [(1, "http://a/ü b", big), (2, None, big), (3, "http://a", None), (4, "u", "y" * 1200), (None, "u", big), (5, "http://a\r\nEvil: 1", "small"), (6, "u", "small"), (2, "u", big)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = warc.read_archives(warc.write_archives(df), with_payload=True).collect()
    assert len(got) == len(pages) and all(r.error is None for r in got)
    assert sorted(r.type for r in got) == ["response"] * 6 + ["revisit"] * 2
    assert {r.refers_to for r in got if r.type == "revisit"} == {"<urn:page:2>"}
    assert sorted(r.payload_bytes for r in got) == sorted(len((h or "").encode()) for _, _, h in pages)
    assert warc.read_archives(warc.write_archives(df.limit(0))).collect() == []
    good = warc.archive([warc.record(1, "u", b"payload", hashlib.sha1(b"payload").hexdigest(), None, False)] * 3)
    assert [e for _, e in warc.frames(good)] == [None] * 3
    assert [e for _, e in warc.frames(good[:-5])][-1] is not None and [e for _, e in warc.frames(b"junk")] == ["no dictionary frame"]
    data = next(warc.frames(good))[0]
    assert warc.checked(data)["error"] is None and warc.checked(data.replace(b"payload", b"Payload"))["error"] and warc.checked(data[:-1])["error"] == "content-length is wrong"


def test_main_text():
    page = """<html><head><title>T</title><style>p{}</style></head><body><nav><a>Menu</a></nav><header>Site</header><div class="cookie-notice">Accept</div>
    <article><h1>Head &amp; line</h1><p>One  two<br>three<p>Four &lt;b&gt;<script>var a="</p>";</script><aside>Side</aside><form><input>Search</form><ul><li>x<li>y</ul>
    <section id="comments"><p>Reader</p></section></article><div class="ad">Buy</div><footer>&copy;</footer></body></html>"""
    assert html_extraction.main_text(page) == "Head & line\nOne two\nthree\nFour <b>\nx\ny"
    assert html_extraction.main_text(None) == html_extraction.main_text("") == "" and html_extraction.main_text("plain <b>text") == "plain text"


def test_main_text_of_broken_and_deep_pages():
    m = html_extraction.main_text
    assert m('<p class="x>hello') == "hello" and m("<p>a <p>b</p") == "a\nb" and m("a < b and <3") == "a < b and <3"
    assert m('<article><header><h1>T</h1><p>Lead</p></header><section class="related-work"><p>kept</p></section><p id="share">too</p><div class="comment-free">this</div></article>') == "T\nLead\nkept\ntoo\nthis"
    assert m("<body>" + "<div>" * 3000 + "<nav>deep menu</nav><p>text</p>") == "text"
    began = time.perf_counter()
    for bad in ('<p a="' + "x<p " * 1_250_000, "<" * 5_000_000, '<a href="x' * 400_000, "</div>" * 600_000):
        m(bad)
    assert time.perf_counter() - began < 20


def test_templates_by_structure(spark):
    rng = random.Random(15)
    nav = lambda: "<div id='m1'><ul>" + "".join(f"<li><a href='/{k}'>{prose(rng, 1)}</a></li>" for k in range(6)) + "</ul></div>"
    page = lambda: f"<body>{nav()}<div class='zz-promo9'>{prose(rng, 6, 9999)}</div><div class='story'><p>{prose(rng, 60, 9999)}</p><p>{prose(rng, 30, 9999)}</p></div></body>"
    rows = [(i, f"http://h.example/{i}", page()) for i in range(30)] + [(100, "http://alone.example/", page())]
    out = by_id(html_extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")), "page_id")
    for i, _, html in rows[:30]:  # menu and advert have other words on each page; only their structure recurs
        assert out[i].text == "\n".join(re.findall("<p>(.*?)</p>", html)), i


def test_templates_recur_on_a_host(spark):
    rng = random.Random(4)
    frame = "<body><div><p>Our site in brief</p></div>{}<div>About us all</div></body>"
    rows = [(i, "http://h.example/%d" % i, frame.format(f"<div><p>{prose(rng, 30)}</p></div>")) for i in range(8)] + [(20, "http://o.example/", frame.format("<p>one</p>")), (21, None, None)]
    out = by_id(html_extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")), "page_id")
    assert all("site" not in out[i].text and "About" not in out[i].text and out[i].n_chars > 50 for i in range(8))
    assert out[20].text == "Our site in brief\none\nAbout us all" and out[21].text == ""


def test_templates_of_a_section_of_a_large_host(spark):
    rng = random.Random(14)
    menu, advert = "<div><p>Rivers Lakes Seas</p></div>", "<div><p>Buy our boats</p></div>"
    body = lambda: f"<div><p>{prose(rng, 30, 5000)}</p></div>"
    rows = [(i, f"http://h.example/{i}", f"<body>{menu if i % 4 == 0 else ''}{body()}</body>") for i in range(240)]
    rows += [(300 + i, f"http://h.example/a{i}", f"<body>{advert}<article><p>{prose(rng, 40, 5000)}</p>{advert}</article></body>") for i in range(30)]
    quoted = f"<div><p>{prose(rng, 9, 5000)}</p></div>"
    rows += [(400 + i, f"http://h.example/b{i}", f"<body><article><p>{prose(rng, 40, 5000)}</p>{quoted}</article></body>") for i in range(30)]
    same = f"<body>{body()}<div><p>Said but once</p></div></body>"
    rows += [(500 + i, f"http://h.example/c{i}", same) for i in range(30)]
    out = by_id(html_extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")), "page_id")
    assert not [i for i, r in out.items() if "Rivers" in r.text or "boats" in r.text] and all(r.n_chars > 50 for r in out.values())
    assert all("Said but once" in out[500 + i].text for i in range(30))
    assert all(re.sub("<[^>]*>", "", quoted) in out[400 + i].text for i in range(30))  # inside articles only: no template


def test_all_articles_of_a_page_count():
    m = html_extraction.main_text
    two = "<article><h2>A</h2><p>first story</p></article><article><p>second</p><article class='comment'><p>no</p></article></article>"
    assert m(f"<body><nav>menu</nav><div>{two}</div><div class='related'><article><p>teaser</p></article></div><article class='comment'>no</article><footer>f</footer></body>") == "A\nfirst story\nsecond"
    assert m(f"<body><header>site</header><main><p>intro</p>{two}</main><aside><article>side</article></aside></body>") == "intro\nA\nfirst story\nsecond"
    assert m("<body><main><p>around</p><article><p>one</p></article></main></body>") == "one"
    began = time.perf_counter()
    m("<article>" * 200_000 + "x")
    m("<main>" + "<article>x</article>" * 100_000)
    assert time.perf_counter() - began < 20


def test_templates_by_brute_force(spark):
    rng = random.Random(16)
    parts = [f"<div class='c{k}'><p>{prose(rng, 3, 50)}</p></div>" for k in range(12)]
    pages = []
    for i in range(150):
        picked = "".join(rng.choice(parts) for _ in range(3))
        pages.append((i, (f"http://h{i % 2}.example/{i}", "http://small.example/", None)[0 if i < 120 else 1 if i < 140 else 2], f"<body>{picked}<article><p>{prose(rng, 20)}</p>{rng.choice(parts)}</article></body>", "z", 1, "q", ["g"]))
    pages += [(200, "http://h0.example/x", pages[0][2], "z", 1, "q", ["g"]), (200, "http://h0.example/x", pages[0][2], "z", 1, "q", ["g"]), (201, "http://h1.example/", None, None, None, None, None), (202, "http://h1.example/", "", "z", 2, "", [])]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, host string, page int, id string, gone array<string>").repartition(3)
    by_host = {}
    for _, url, html, *_ in pages:
        by_host.setdefault(re.match("http://([^/]*)", url)[1] if url else "", set()).add(html or "")
    expected = {}
    for host, own in by_host.items():
        counts, outside = Counter(), Counter()
        for html in own:
            for h, out in (html_extraction.hashes_of(html) if html else {}).items():
                counts[h] += 1
                outside[h] += out
        n = len(own)
        expected[host] = {h for h, c in counts.items() if c >= 5 and (outside[h] >= max(5, min(20, -(-n // 10))) or 2 * c >= n)}
    got = html_extraction.extract(df).collect()
    assert len(got) == len(pages) and any(expected.values())
    want = Counter((i, url, html_extraction.main_text(html, expected[re.match("http://([^/]*)", url)[1] if url else ""])) for i, url, html, *_ in pages)
    assert Counter((r.page_id, r.url, r.text) for r in got) == want and all(r.n_chars == len(r.text) for r in got)
    assert html_extraction.extract(df.limit(0)).collect() == []


def test_toxicity_finds_planted_words(spark):
    rng = random.Random(9)
    docs = [(i, prose(rng, 60, 300) + (" vile rotten vile " + prose(rng, 20, 300) if i % 5 == 0 else "")) for i in range(300)]
    df = spark.createDataFrame([*docs, (900, None), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(200)] + [(7, None)], "doc_id long, toxic int")
    out = by_id(toxicity.toxicity(df, labels))
    assert all((out[i].score >= 0.5) == (i % 5 == 0) for i in range(200, 300)) and out[900].score == out[901].score < 0.5
    text = dict(docs)[205]
    odd = toxicity.toxicity(spark.createDataFrame([(1, "İİİİ Vile rotten, vile rotten VILE")], "doc_id long, text string").unionByName(df), labels).where("id = 1 AND size(spans) > 0").collect()
    assert {r.lower() for o in odd for r in ("İİİİ Vile rotten, vile rotten VILE"[x.start : x.end] for x in o.spans)} <= {"vile", "rotten"}
    assert {text[s.start : s.end] for s in out[205].spans} <= {"vile", "rotten"} and out[205].spans and not out[206].spans
    assert toxicity.toxicity(df.limit(0), labels).collect() == []


def test_forward_backward_against_enumeration():
    import numpy as np

    rng = np.random.default_rng(0)
    e, turn = rng.normal(size=6), rng.normal(size=(2, 2))
    weight = {y: np.exp(sum(e[i] * y[i] for i in range(6)) + sum(turn[a, b] for a, b in itertools.pairwise(y))) for y in itertools.product((0, 1), repeat=6)}
    z = sum(weight.values())
    p, counts = toxicity.marginals([e, e[:1], e[:0]], turn)
    assert np.allclose(p[0], [sum(w for y, w in weight.items() if y[i]) / z for i in range(6)]) and len(p[2]) == 0
    assert np.allclose(counts, [[sum(w * sum(pair == (a, b) for pair in itertools.pairwise(y)) for y, w in weight.items()) / z for b in (0, 1)] for a in (0, 1)])


def test_resampling_weights_by_brute_force(spark):
    import numpy as np
    import pyarrow as pa

    from veinstone.llm.shingles import Words

    rng = random.Random(18)
    texts = [prose(rng, rng.randrange(0, 60), 80) for _ in range(50)] + ["x" * 3000 + " y", "same same", "same same"]
    df = spark.createDataFrame([(i, t, 1.0, "k") for i, t in enumerate(texts)], "doc_id long, text string, key double, bucket string")
    out = by_id(resampling.resample(df, df.where("doc_id % 3 = 0").select("doc_id"), 0.5, bits=10))
    words = Words(pa.array([t.encode() for t in texts], pa.binary()))
    grams = [resampling.buckets(words.of(i), 10).tolist() for i in range(len(texts))]
    raw, good = Counter(g for x in grams for g in x), Counter(g for i, x in enumerate(grams) for g in x if i % 3 == 0)
    log = lambda c, g: np.log((c[g] + 1.0) / (sum(c.values()) + 1024))
    for i, x in enumerate(grams):
        if x:
            assert out[i].n_grams == len(x) and abs(out[i].log_weight - sum(log(good, g) - log(raw, g) for g in x)) < 1e-6
        else:
            assert out[i].log_weight is None and not out[i].kept
    assert sum(r.kept for r in out.values()) == round(0.5 * len(texts))


CONTRACT = {
    "op1_nnls_packing": ("documents", "doc_id start length ids_crc32 doc_tokens sequence_id offset"), "op2_divergence_rules": ("documents", "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept"),
    "op3_weighted_sampling_fingerprints": ("documents", "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next"), "op4_importance_resampling": ("documents", "doc_id kept"), "op5_low_discrepancy_mix": ("documents", "doc_id size source_size target taken"),
    "op6_minhash_near_dedup": ("documents", "doc_id n_shingles component_id kept"), "op7_zstd_warc": ("pages", "page_id payload_bytes payload_digest record_type refers_to"), "op8_site_template_removal": ("pages", "page_id url text n_chars"),
    "op9_paragraph_substring_dedup": ("documents", "doc_id text removed_words"), "op10_crf_toxicity": ("documents", "doc_id held_out score predicted"),
}


@pytest.mark.parametrize("name", CONTRACT)
def test_queries_return_their_columns_for_every_row(spark, name):
    from veinstone.llm import queries

    table, columns = CONTRACT[name]
    folder = "/root/testdata/sf0.001"
    key = "page_id" if table == "pages" else "doc_id"
    ids = {r[0] for r in spark.read.parquet(f"{folder}/{table}.parquet").select(key).collect()}
    out = queries.QUERIES[name](spark, folder)
    assert out.columns[: len(columns.split())] == columns.split() or set(columns.split()) <= set(out.columns)
    rows = [r[key] for r in out.select(key).collect()]
    assert set(rows) == ids and (len(rows) == len(ids) or name == "op1_nnls_packing")


def test_toxicity_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    out = toxicity.op10_crf_toxicity(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").select("toxic", "predicted").collect()
    assert sum(r.toxic == r.predicted for r in out) / len(out) > 0.9
