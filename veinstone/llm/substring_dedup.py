"""Substring dedup: MinHash banding of overlapping paragraphs, exact checks, removal by components.

Repeated passages do not keep to lines, so a paragraph here is every stretch of ``GAP + WIDTH - 1`` = 22 words. Its
MinHash is the least hash of its shingles of ``WIDTH`` = 10 words; neighbouring paragraphs mostly share theirs, and
then count once, with the place of that shingle. The banding is one band of one row, which keeps no two equal
paragraphs apart wherever they stand. Of two passages of 50 words or more at a Jaccard similarity of 0.75 or more (of
5-grams, by changed words), some paragraph is equal: c changes need 35 c + 4 words, which leaves 24 in a row.

Equal texts fold to the first one before anything else. Each bucket then links its paragraphs to its first one only
(stars, not pairs). Linked paragraphs of two documents on one diagonal form a run. A run is compared with the other
document word by word, with ``MARGIN`` words on both sides: what common 5-grams cover is the repeat, and pieces with
few words between them are one repeat if its 5-grams reach a Jaccard similarity of 0.75.

The first document may hold less of a passage than the others share. Buckets with paragraphs that their star leaves
without a repeat of 50 words are therefore settled by an exact join on the words of 50-word passages around them.
Components of the confirmed links keep their first paragraph; in all other documents repeats of at least ``min_words``
words are cut out.

The words of a hub are compared in slices of ``SLICE`` words, so that neither a long text nor one that many others
repeat is ever handed over whole.

Results for odd input: a null text stays null, and texts of fewer than 50 words stay as they are; repeats within one
document stay; a text that is wholly repeated becomes empty; rows with equal ids are one document to each other, and
spans found in one are cut where the other has as many words; rows without an id stay as they are; no documents
give no rows; extra columns are not read. With ``min_words`` below 50 shorter repeats are cut where they are met, but
not all are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, components, released, renamed, staged
from .shingles import Words, least_of, mixed, sliced, windows

WORDS, WIDTH, GAP, MIN_WORDS, SIMILARITY = 5, 10, 13, 50, 0.75
#: Diagonals beside a run's that count as its own, and words between two pieces of one repeat.
SHIFT, JOIN = 6, 10
#: Words beyond a run's ends in which the repeat may go on, behind a change as well: a whole paragraph there would have been met.
MARGIN = 2 * (GAP + WIDTH)
#: Linked paragraphs with at most so many words from start to start are one run.
CHAIN = 70
#: Words of a hub that are compared at a time.
SLICE = 256
#: What a passage of MIN_WORDS that holds a paragraph has more than it on one side at least.
HALF = (MIN_WORDS - WIDTH) // 2
#: Tables of more rows are joined by shuffle, so that the plan is the same for a small corpus and for a large one.
FEW = 10_000
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SPANS = "array<struct<start:bigint,end:bigint>>"
#: The end of a span that is a whole text.
WHOLE = 1 << 40


def minima(grams: np.ndarray, at: np.ndarray, gap: int = GAP, width: int = WIDTH) -> np.ndarray:
    """Places of the (first) least of every ``gap`` neighbouring shingles; ``at`` has the words where texts begin and end.

    Where a text says a few words over and over, its least shingle comes back at every turn, and would meet another
    such text on as many diagonals; of equal ones that are at most half of ``gap`` apart only one in each ``gap`` counts.
    """
    low = np.uint64((1 << max(1, len(grams).bit_length())) - 1)
    least = least_of((grams & ~low) | np.arange(len(grams), dtype=np.uint64), gap)
    ends = np.maximum(at[:-1], at[1:] - (gap + width - 2))  # after the last place where a paragraph begins
    inside = np.zeros(len(grams) + 1, np.int32)
    np.add.at(inside, np.minimum(at[:-1], len(grams)), 1)
    np.add.at(inside, np.minimum(ends, len(grams)), -1)
    chosen = (least[np.cumsum(inside)[: len(least)] > 0] & low).astype(np.int64)
    chosen = chosen[np.flatnonzero(np.diff(chosen, prepend=-1))]
    if not len(chosen):
        return chosen
    new = np.append(True, (grams[chosen[1:]] != grams[chosen[:-1]]) | (np.diff(chosen) > gap // 2))
    turn = (chosen - chosen[np.flatnonzero(new)[np.cumsum(new) - 1]]) // gap
    return chosen[new | np.append(True, turn[1:] != turn[:-1])]


def _paragraphs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        words = Words(batch.column("text"))
        if len(words.hashes) < MIN_WORDS:
            continue
        grams = windows(words.hashes, WIDTH)
        at = minima(grams, words.at)
        text = np.searchsorted(words.at, at, "right") - 1
        long = np.diff(words.at)[text] >= MIN_WORDS
        at, text = at[long], text[long]
        doc = batch.column("id").to_numpy()[text]
        yield pa.RecordBatch.from_arrays([pa.array(grams[at].view(np.int64)), pa.array(doc), pa.array((at - words.at[text]).astype(np.int32))], names=["bucket", "doc", "pos"])


def _lists(parts: list[np.ndarray]) -> pa.Array:
    """Arrays of hashes as lists of their low 32 bits: five in a row still tell 5-grams apart."""
    flat = np.concatenate(parts).astype(np.uint32).view(np.int32) if parts else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)]), pa.int32()), pa.array(flat))


PIECES = "hub long, k long, doc long, start long, end long, diagonal long, run long, low long, words array<int>"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of a document's own runs, cut as its hubs' slices are, and the slices that are asked of it as a hub (doc is null)."""
    names = [c.split()[0] for c in PIECES.split(", ")]
    for batch in sliced(batches):
        words = Words(batch.column("text"))
        rows: list[tuple] = []
        parts: list[np.ndarray] = []
        for n, (doc, runs, asked) in enumerate(zip(batch.column("id").to_pylist(), batch.column("runs").to_pylist(), batch.column("asked").to_pylist(), strict=True)):
            own = words.of(n)
            for r in runs or []:
                hub_start, hub_end = r["start"] - r["diagonal"], r["end"] - r["diagonal"]
                for k in range(hub_start // SLICE, (hub_end - 1) // SLICE + 1):
                    start, end = r["diagonal"] + max(hub_start, k * SLICE), r["diagonal"] + min(hub_end, (k + 1) * SLICE)
                    low = max(0, start - MARGIN)
                    rows.append((r["hub"], k, doc, start, end, r["diagonal"], r["start"], low))
                    parts.append(own[low : end + MARGIN])
            for k in asked or []:
                low = max(0, k * SLICE - MARGIN - SHIFT)
                rows.append((doc, k, None, None, None, None, None, low))
                parts.append(own[low : (k + 1) * SLICE + MARGIN + SHIFT])
        cols = list(zip(*rows, strict=True)) or [()] * 8
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols), _lists(parts)], names=names)


def repeats_of(own: np.ndarray, own_at: np.ndarray, hub: np.ndarray, hub_at: np.ndarray, ahead: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, from, to): repeats in the words of many pairs at once, where they touch a pair's run from ``start`` to ``end``.

    ``own_at`` and ``hub_at`` say where the words of each pair begin and end; word i of its own part stands beside word
    i + ``ahead`` of its hub's. Words count as repeated in common 5-grams on diagonals up to ``SHIFT`` from that. Pieces
    with at most ``JOIN`` other words between them are one repeat if its similarity suffices, else they stay apart.
    """
    size = np.diff(own_at)
    pair = np.repeat(np.arange(len(size)), size)
    local = np.arange(len(own)) - own_at[:-1][pair]
    beside, first, last = local + (hub_at[:-1] + ahead)[pair], hub_at[:-1][pair], hub_at[1:][pair]
    whole = local <= size[pair] - WORDS
    shift = np.full(len(own), SHIFT + 1, np.int64)
    for s in sorted(range(-SHIFT, SHIFT + 1), key=lambda s: -abs(s)):  # nearer diagonals last, so that they count first
        at = beside + s
        equal = np.append((hub.take(at, mode="clip") == own) & (at >= first) & (at < last), np.zeros(WORDS, bool))
        gram = equal[: len(own)]
        for k in range(1, WORDS):
            gram = gram & equal[k : len(own) + k]
        shift[gram & whole] = s
    shared = np.concatenate([[0], shift <= SHIFT, [0]]).astype(np.int64)
    edge = np.diff(shared)
    low, high = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + WORDS - 1
    if not len(low):
        return low, low, low
    of = pair[low]
    new = np.append(True, (of[1:] != of[:-1]) | (low[1:] - high[:-1] > JOIN))
    group = np.cumsum(new) - 1
    a, b = low[new], high[np.append(np.flatnonzero(new)[1:] - 1, len(low) - 1)]
    ours = b - a - WORDS + 1
    both = np.add.reduceat(high - low - WORDS + 1, np.flatnonzero(new))
    theirs = ours + shift[b - WORDS] - shift[a]
    near = both >= SIMILARITY * (ours + theirs - both)
    begin = own_at[of[new]]
    touches = (b > begin + start[of[new]]) & (a < begin + end[of[new]])
    one, many = np.flatnonzero(touches & near), (touches & ~near)[group]
    pairs, froms, tos = np.concatenate([of[new][one], of[many]]), np.concatenate([a[one], low[many]]), np.concatenate([b[one], high[many]])
    return pairs, froms - own_at[pairs], tos - own_at[pairs]


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where runs (``words`` from ``low`` on) repeat their hub (``near`` from ``hub_low`` on)."""
    for batch in sliced(batches):
        (own, own_at), (hub, hub_at) = ((c.flatten().to_numpy(), c.offsets.to_numpy().astype(np.int64)) for c in (batch.column("words"), batch.column("near")))
        doc, start, end, hub_doc, diagonal, run, low, hub_low = (batch.column(c).to_numpy() for c in ("doc", "start", "end", "hub", "diagonal", "run", "low", "hub_low"))
        pair, a, b = repeats_of(own, own_at - own_at[0], hub, hub_at - hub_at[0], low - diagonal - hub_low, start - low, end - low)
        cols = [doc[pair], run[pair], hub_doc[pair], (run - diagonal)[pair], low[pair] + a, low[pair] + b]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], names=["doc", "pos", "hub", "hub_pos", "start", "end"])


FOUND = "doc long, pos long, hub long, hub_pos long, start long, end long"


def _extents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of paragraphs with ``HALF`` words more on the left (side 0) and on the right (side 1)."""
    for batch in sliced(batches):
        words = Words(batch.column("text"))
        listed = batch.column("places")
        flat, sizes = listed.flatten(), np.diff(listed.offsets.to_numpy())
        text = np.repeat(np.arange(len(words)), sizes)
        pos, settled = flat.field(0).to_numpy().astype(np.int64), flat.field(1).to_numpy(zero_copy_only=False).astype(np.int64)
        ids = batch.column("id").to_numpy()
        cols: list[tuple] = []
        if len(words.hashes) >= WIDTH + HALF:
            keys = windows(words.hashes, WIDTH + HALF)
            for side, first in enumerate((pos - HALF, pos)):
                fits = (first >= 0) & (first + WIDTH + HALF <= np.diff(words.at)[text])
                where = (words.at[text] + first)[fits]
                cols.append((mixed(keys[where] + np.uint64(side)).view(np.int64), ids[text[fits]], pos[fits], np.full(fits.sum(), side), settled[fits]))
        if cols:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*cols, strict=True)], names=["key", "doc", "pos", "side", "settled"])


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of all ``MIN_WORDS`` words that hold one of the paragraphs and ``HALF`` words more on its side."""
    for batch in sliced(batches):
        words = Words(batch.column("text"))
        keys, docs, starts = [], [], []
        for n, (doc, places) in enumerate(zip(batch.column("id").to_pylist(), batch.column("places").to_pylist(), strict=True)):
            own = words.of(n)
            if len(own) < MIN_WORDS:
                continue
            key = windows(own, MIN_WORDS)
            first = np.array([p["pos"] - (0 if p["side"] else HALF) for p in places], np.int64) - (MIN_WORDS - WIDTH - HALF)
            start = np.unique(first[:, None] + np.arange(MIN_WORDS - WIDTH - HALF + 1))
            start = start[(start >= 0) & (start < len(key))]
            keys.append(key[start])
            docs.append(np.full(len(start), doc, np.int64))
            starts.append(start)
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(docs)), pa.array(np.concatenate(starts))], names=["key", "doc", "start"])


def _cut(keep: list[str], min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts, removed, spans_of = [], [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("removed").to_pylist(), strict=True):
                at = [m.span() for m in WORD.finditer(text)]
                if spans[0]["end"] == WHOLE:
                    spans = [{"start": 0, "end": len(at)}] if len(at) >= min_words else []
                parts, last, gone = [], 0, 0
                for s in sorted(spans, key=lambda s: s["start"]):
                    if s["end"] <= len(at):
                        parts.append(text[last : at[s["start"]][0]])
                        last = at[s["end"]][0] if s["end"] < len(at) else len(text)
                        gone += s["end"] - s["start"]
                texts.append(b"".join([*parts, text[last:]]).decode("utf-8", "replace"))
                removed.append(gone)
                spans_of.append(spans)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string()), pa.array(removed, pa.int64()), pa.array(spans_of, batch.column("removed").type), *map(batch.column, keep)], names=["id", "text", "removed_words", "removed", *keep])

    return run


def with_listed(some: DataFrame, listed: DataFrame) -> DataFrame:
    """Texts of ``some`` joined with the rows of ``listed`` (id, ...): one shuffle of the texts, at any size, and no sort of them."""
    return some.join(listed.hint("shuffle_hash"), "id")


def islands(spans: DataFrame, *by: str) -> DataFrame:
    """Spans (doc, start, end, ...) with ``island``, the number of the stretch of touching spans of a document, and of the same ``by``, that each is in; a document's spans are no more than its words.

    Spans that an earlier or longer one among these holds are gone: what they cover is covered.
    """
    by_start = Window.partitionBy("doc", *by).orderBy("start", F.desc("end"))
    before = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("start") <= F.col("before"), 0).otherwise(1)).over(by_start)
    return spans.withColumn("before", before).where("before IS NULL OR end > before").withColumn("island", island).drop("before")


def long_repeats(found: DataFrame, least: int) -> DataFrame:
    """The rows of ``found`` that are part of ``least`` words or more which one document holds on one diagonal; short pieces from here and there are no repeat together."""
    f = islands(found.withColumn("diagonal", F.col("pos") - F.col("hub_pos")), "hub", "diagonal")
    whole = Window.partitionBy("doc", "hub", "diagonal", "island")
    return f.withColumn("long", F.max("end").over(whole) - F.min("start").over(whole)).where(F.col("long") >= least).drop("diagonal", "island", "long")


def merged(spans: DataFrame) -> DataFrame:
    """(id, spans): spans (doc, start, end) of every document, joined where they touch."""
    s = islands(spans.select("doc", "start", "end").distinct()).groupBy("doc", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return s.groupBy(F.col("doc").alias("id")).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))


def copies(docs: DataFrame) -> DataFrame:
    """(id): documents whose text an earlier one has word for word and byte for byte; an id with several texts is none of them."""
    t = docs.select("id", F.md5("text").alias("digest")).distinct()
    t = staged(t, "digests")
    again = staged(t.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").select("digest", "first"), "equal")
    later = t.join(broadcast_if_small(again, FEW), "digest").where("id > first")
    several = staged(t.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id"), "several")
    out = staged(later.join(broadcast_if_small(several, FEW), "id", "left_anti").select("id"), "copies")
    released(t, again, several)
    return out


def met_paragraphs(some: DataFrame, copied: DataFrame) -> DataFrame:
    """(bucket, doc, pos, hub): paragraphs in buckets of several documents, copies aside; the hub is the least of these."""
    rows = some.mapInArrow(_paragraphs, "bucket long, doc long, pos int").join(broadcast_if_small(copied, FEW).withColumnRenamed("id", "doc"), "doc", "left_anti")
    rows = staged(rows, "paragraphs")
    shared = rows.groupBy("bucket").agg(F.min("doc").alias("hub"), F.max("doc").alias("last")).where("hub < last").select("bucket", "hub")
    shared = staged(shared, "shared")
    met = staged(rows.join(broadcast_if_small(shared, FEW), "bucket"), "met")
    released(rows, shared)
    return met


def chained(links: DataFrame, at: str, step: int, width: int) -> DataFrame:
    """(doc, hub, diagonal, start, end): places ``at`` of the same document, hub and diagonal with at most ``step`` words from one to the next as one run."""
    links = links.repartition("doc").distinct()  # the window and the groups need no other shuffle
    by_pos = Window.partitionBy("doc", "hub", "diagonal").orderBy(at)
    new = F.when(F.col(at) - F.lag(at).over(by_pos) <= step, 0).otherwise(1)
    runs = links.withColumn("new", new).withColumn("run", F.sum("new").over(by_pos)).groupBy("doc", "hub", "diagonal", "run")
    return runs.agg(F.min(at).alias("start"), (F.max(at) + width).alias("end")).drop("run")


def star_repeats(some: DataFrame, met: DataFrame) -> DataFrame:
    """Repeats, in words, of runs of paragraphs linked to their buckets' hubs; the columns of ``FOUND``."""
    hubs = staged(met.where("doc = hub").groupBy("bucket").agg(F.min("pos").alias("hub_pos")), "hubs")
    links = met.where("doc <> hub").join(broadcast_if_small(hubs, FEW), "bucket").select("doc", "hub", F.col("pos").cast("long").alias("pos"), (F.col("pos") - F.col("hub_pos")).cast("long").alias("diagonal"))
    runs = staged(chained(links, "pos", CHAIN, WIDTH), "runs")
    own = runs.groupBy(F.col("doc").alias("id")).agg(F.collect_list(F.struct("start", "end", "hub", "diagonal")).alias("runs"))  # no longer than its document
    hub_slice = lambda place: F.floor((F.col(place) - F.col("diagonal")) / SLICE)
    ks = F.sequence(hub_slice("start"), F.floor((F.col("end") - F.col("diagonal") - 1) / SLICE))
    asked = runs.select(F.col("hub").alias("id"), F.explode(ks).alias("k")).distinct().groupBy("id").agg(F.collect_list("k").alias("asked"))
    listed = staged(own.join(asked, "id", "full_outer"), "listed")
    pieces = staged(with_listed(some, listed).select("id", "text", "runs", "asked").mapInArrow(_pieces, PIECES), "pieces")
    near_low = F.greatest(F.col("start") - F.col("diagonal") - MARGIN - SHIFT, F.col("hub_from"))
    size = (F.col("end") - F.col("diagonal") + MARGIN + SHIFT - F.col("hub_low")).cast("int")
    slices = pieces.where("doc IS NULL").select("hub", "k", F.col("low").alias("hub_from"), F.col("words").alias("slice"))
    pairs = pieces.where("doc IS NOT NULL").join(slices, ["hub", "k"]).withColumn("hub_low", near_low)
    near = F.slice("slice", (F.col("hub_low") - F.col("hub_from") + 1).cast("int"), size)
    pairs = pairs.select("doc", "start", "end", "hub", "diagonal", "run", "low", "hub_low", "words", near.alias("near"))
    found = staged(pairs.mapInArrow(_confirm, FOUND), "confirmed")
    released(hubs, runs, listed, pieces)
    return found


def followed_up(some: DataFrame, met: DataFrame, found: DataFrame) -> DataFrame:
    """Exact repeats of ``MIN_WORDS`` words between members of buckets in which a link to the hub left a paragraph unsettled; the columns of ``FOUND``.

    A passage of ``MIN_WORDS`` words around a paragraph has ``HALF`` more on one side at least: only paragraphs that
    share that much with another document have all their passages compared.
    """
    spans = staged(merged(long_repeats(found, MIN_WORDS)), "settled")
    inside = F.exists("spans", lambda s: (s["start"] <= F.col("pos")) & (F.col("pos") + WIDTH <= s["end"]))
    of = met.join(spans.withColumnRenamed("id", "doc"), "doc", "left").select("bucket", "doc", "pos", "hub", F.coalesce(inside, F.lit(False)).alias("settled"))
    of = staged(of, "paragraphs")
    open_buckets = staged(of.where("NOT settled AND doc <> hub").select("bucket").distinct(), "open")
    places = of.join(broadcast_if_small(open_buckets, FEW), "bucket").groupBy("doc", "pos").agg(F.bool_and("settled").alias("settled"))
    listed = staged(places.groupBy(F.col("doc").alias("id")).agg(F.collect_list(F.struct("pos", "settled")).alias("places")), "places")  # no longer than its document
    keys = staged(with_listed(some, listed).select("id", "text", "places").mapInArrow(_extents, "key long, doc long, pos long, side long, settled long"), "extents")
    again = staged(keys.groupBy("key").agg(F.min("doc").alias("a"), F.max("doc").alias("b"), F.min("settled").alias("s")).where("a < b AND s = 0").select("key"), "again")
    chosen = keys.join(broadcast_if_small(again, FEW), "key").select("doc", "pos", "side").distinct()
    chosen = staged(chosen.groupBy(F.col("doc").alias("id")).agg(F.collect_list(F.struct("pos", "side")).alias("places")), "chosen")
    released(of, open_buckets, listed, keys, again)
    passages = staged(with_listed(some, chosen).select("id", "text", "places").mapInArrow(_passages, "key long, doc long, start long").distinct(), "passages")
    first = passages.groupBy("key").agg(F.min("doc").alias("hub"), F.max("doc").alias("last")).where("hub < last").select("key", "hub")
    met = staged(passages.join(broadcast_if_small(staged(first, "first"), FEW), "key"), "repeated")
    hubs = staged(met.where("doc = hub").groupBy("key").agg(F.min("start").alias("hub_pos")), "hubs")
    equal = met.where("doc > hub").join(broadcast_if_small(hubs, FEW), "key").join(spans.withColumnRenamed("id", "doc"), "doc", "left")
    found_before = F.exists("spans", lambda s: (s["start"] <= F.col("start")) & (F.col("start") + MIN_WORDS <= s["end"]))
    equal = equal.where(~F.coalesce(found_before, F.lit(False))).select("doc", "hub", (F.col("start") - F.col("hub_pos")).alias("diagonal"), "start")
    out = staged(chained(equal, "start", MIN_WORDS, MIN_WORDS).select("doc", F.col("start").alias("pos"), "hub", (F.col("start") - F.col("diagonal")).alias("hub_pos"), "start", "end"), "followed")
    released(spans, chosen, passages, met, hubs)
    return out


def clusters(found: DataFrame) -> DataFrame:
    """(id, component): the components of the links of ``found``. Most paragraphs are no other's hub and have one themselves: theirs is its component, and only the rest is searched."""
    node = lambda doc, pos: F.struct(F.col(doc).alias("doc"), F.col(pos).alias("pos"))
    links = found.select(node("doc", "pos").alias("a"), node("hub", "hub_pos").alias("b")).distinct()
    links = staged(links, "links")
    several = links.groupBy("a").agg(F.min("b").alias("x"), F.max("b").alias("y")).where("x <> y").select(F.col("a").alias("h"))
    hubs = staged(several.union(links.select("b")).distinct(), "hub-nodes")
    inner = links.join(broadcast_if_small(hubs, FEW), F.col("a") == F.col("h"), "left_semi")
    of = components(inner, rows=FEW)
    out = links.join(broadcast_if_small(renamed(of, b="id", component="component"), FEW), "b", "left").groupBy(F.col("a").alias("id")).agg(F.min(F.coalesce("component", "b")).alias("component"))
    out = staged(out, "clusters")
    released(links, hubs)
    return out


def repeats(docs: DataFrame, copied: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, start, end, component) of repeats, in words, that another document's first paragraph of the same component holds; ``docs`` has id and text (binary)."""
    some = docs.where("id IS NOT NULL AND text IS NOT NULL")
    met = met_paragraphs(some, copied)
    star = star_repeats(some, met)
    more = followed_up(some, met, star)
    found = star.unionByName(more)
    found = staged(islands(long_repeats(found, min_words)).drop("island"), "found")  # what is part of no repeat of min_words links nothing
    released(met, star, more)
    of = clusters(found)
    out = found.withColumn("id", F.struct("doc", "pos")).join(broadcast_if_small(of, FEW), "id").where(F.col("component.doc") < F.col("doc")).select("doc", "start", "end", "component")
    out = staged(out, "repeats")
    released(found, of)
    return out


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, text, removed_words, removed) for every row: the text without its repeats, and their places in words; ``keep`` names further columns to keep."""
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"), *keep)
    some = d.where("id IS NOT NULL AND text IS NOT NULL").select("id", "text")
    copied = copies(some)
    found = repeats(some, copied, min_words)
    whole_text = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.lit(WHOLE).cast("long").alias("end")))
    spans = merged(found).unionByName(copied.select("id", whole_text.alias("spans")))  # a copy has no paragraphs, so no other spans
    spans = staged(spans.withColumnRenamed("spans", "removed"), "spans")
    released(found, copied)
    few = broadcast_if_small(spans, FEW)
    schema = f"id long, text string, removed_words long, removed {SPANS}" + "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    cut = d.where("text IS NOT NULL").join(few, "id").select("id", "text", "removed", *keep).mapInArrow(_cut(list(keep), min_words), schema)
    whole = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), *keep).join(few.select(F.col("id").alias("_id")), F.col("id").eqNullSafe(F.col("_id")) & F.col("text").isNotNull(), "left_anti")
    return cut.unionByName(whole.select("id", "text", F.lit(0).cast("long").alias("removed_words"), F.array().cast(SPANS).alias("removed"), *keep))


def op9_paragraph_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet")).withColumnRenamed("id", "doc_id")
