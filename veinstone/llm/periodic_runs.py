"""Periodic runs of words: divide and conquer with Z-functions (Main and Lorentz) on interned word ids.

A run is a stretch of words with smallest period q, of at least ``least`` words and ``times`` periods, that neither
neighbouring word extends. Each text is worked on alone, in one pass without a shuffle. Its words become numbers by a
dictionary, so that nothing rests on hashes. A run repeats its first third, so it is covered by windows of
``least - least // times`` words that occur twice: only stretches that such windows cover are searched.

A stretch is halved again and again. At each midpoint two Z-functions, of the left half read backwards and of the
right half, say for every period how far it goes on to both sides of the midpoint, so each run that crosses it is
found; what the stretch cuts off goes on outside it and is found whole at a midpoint above. Of one interval the
smallest period counts.

Results for odd input: a null, empty or blank text has no words and no runs, and collapses to the empty text; equal
rows get equal results; long texts are searched whole, in n log n steps; a null id is kept; no documents give no rows;
extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE
from .shingles import sliced, windows

LEAST, TIMES = 24, 3
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def z_function(w: list[int], stop: int) -> np.ndarray:
    """For each place before ``stop``: how many words from there on are those at the start of ``w``; 0 for the start itself."""
    n, z = len(w), [0] * stop
    left = right = 0
    for i in range(1, stop):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and w[k] == w[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return np.array(z, np.int64)


def crossing(left: list[int], right: list[int], least: int, times: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words before the middle, words behind it, period) of all repetitions across the middle of ``left`` + ``right`` that are long enough for their period."""
    a, b = len(left), len(right)
    most = (a + b) // times
    back = z_function([*left[::-1], -1, *right[::-1], *left[::-1]], a + 1 + b)
    ahead = z_function([*right, -1, *left, *right], b + 1 + a)
    found = []
    q = np.arange(1, min(b, most) + 1)  # a whole period behind the middle
    goes_on = np.where(q < b, ahead[np.minimum(q, b)], 0)
    found.append((back[a + 1 + b - q], q + goes_on, q))
    q = np.arange(1, min(a, most) + 1)  # a whole period before it
    came = np.where(q < a, back[np.minimum(q, a)], 0)
    found.append((q + came, ahead[b + 1 + a - q], q))
    before, behind, period = (np.concatenate(x) for x in zip(*found, strict=True))
    length = before + behind
    long = (length >= least) & (length >= times * period)
    return before[long], behind[long], period[long]


def runs_of(w: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Rows (start, length, period) of all runs of a sequence of numbers from 0 up, by start and then period."""
    none = np.empty((0, 3), np.int64)
    n = len(w)
    size = least - least // times
    if n < least:
        return none
    grams = windows(w.astype(np.uint64), size)
    order = np.argsort(grams, kind="stable")
    same = grams[order][1:] == grams[order][:-1]
    again = np.zeros(len(grams), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, np.flatnonzero(again), 1)
    np.add.at(edges, np.flatnonzero(again) + size, -1)
    covered = np.diff(np.concatenate([[0], np.cumsum(edges[:n]) > 0, [0]]).astype(np.int8))
    todo = [(lo, hi) for lo, hi in zip(np.flatnonzero(covered == 1).tolist(), np.flatnonzero(covered == -1).tolist(), strict=True)]
    starts, ends, periods = [], [], []
    while todo:
        lo, hi = todo.pop()
        if hi - lo < least:
            continue
        mid = (lo + hi) // 2
        before, behind, period = crossing(w[lo:mid].tolist(), w[mid:hi].tolist(), least, times)
        start, end = mid - before, mid + behind
        whole = ((start == 0) | (w[start - 1] != w[start - 1 + period])) & ((end == n) | (w[np.minimum(end, n - 1)] != w[end - period]))
        starts.append(start[whole])
        ends.append(end[whole])
        periods.append(period[whole])
        todo += [(lo, mid), (mid, hi)]
    if not starts:
        return none
    start, end, period = map(np.concatenate, (starts, ends, periods))
    by = np.lexsort((period, end, start))
    start, end, period = start[by], end[by], period[by]
    first = np.append(True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])) if len(start) else np.empty(0, bool)
    start, end, period = start[first], end[first], period[first]
    out = np.stack([start, end - start, period], 1)
    return out[np.lexsort((period, start))]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words, joined by single spaces, without those that a run holds behind its first period."""
    if not len(runs):
        return b" ".join(words)
    gone = np.zeros(len(words) + 1, np.int64)
    np.add.at(gone, runs[:, 0] + runs[:, 2], 1)
    np.add.at(gone, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()])


def _runs(least: int, times: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            sizes, found, texts = [], [], []
            for text in batch.column("text"):
                words = (text.as_py() or b"").split()  # at ASCII white space
                sizes.append(len(words))
                runs = np.empty((0, 3), np.int64)
                if len(words) >= least:
                    ids: dict[bytes, int] = {}
                    runs = runs_of(np.array([ids.setdefault(w, len(ids)) for w in words], np.int64), least, times)
                found.append([{"start": s, "length": n, "period": q} for s, n, q in runs.tolist()])
                texts.append(collapsed(words, runs).decode("utf-8", "replace"))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes, pa.int64()), pa.array(found, kind), pa.array(texts, pa.string())], names=["id", "n_words", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, runs, collapsed) for every row: its runs by start and period, and the text that is left when each run keeps its first period only."""
    text = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return text.mapInArrow(_runs(least, times), f"id long, n_words long, runs {RUNS}, collapsed string")


def with_repeated_tails(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents of the query: in every tenth or so, by a hash of the id, the words from some place on repeat a stretch of that place."""
    words = F.filter(F.split(F.col(text_col), SPACE), lambda w: w != "")
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), h.alias("h"))
    d = d.withColumn("w", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("w"))
    g = F.floor(F.col("h") / 10)
    d = d.withColumn("a", (g % F.nullif("n", F.lit(0))).cast("int")).withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + g % 8))).cast("int"))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    again = F.array_join(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get("w", place(i))), " ")
    return d.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), again).otherwise(F.col("text")).alias("text"))


def greater(x: Column, y: Column) -> Column:
    """Whether run ``x`` has a greater exponent than run ``y``, exactly; ties go to the smaller start, then period."""
    ours, theirs = x["length"] * y["period"], y["length"] * x["period"]
    return (ours > theirs) | (ours == theirs) & ((x["start"] < y["start"]) | (x["start"] == y["start"]) & (x["period"] < y["period"]))


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    d = periodic_runs(with_repeated_tails(spark.read.parquet(f"{sf_dir}/documents.parquet"))).withColumnRenamed("id", "doc_id")
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda best, r: F.when(greater(r, best), r).otherwise(best))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    d = d.withColumn("best", best)
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return d.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        sha(lines).alias("runs_sha256"), sha(F.col("collapsed")).alias("collapsed_sha256"),
    )
